"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import release, stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the component's smallest node.

    Alternating large-star and small-star steps: every step is a group-by with
    map-side minima and a join, and no node's neighbours are ever gathered.  A
    component of n nodes takes O(log n) rounds.
    """
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"),
                         F.least(a, b).cast("long").alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, "edges")
    before = None
    while True:
        # large star: neighbours above a node move to its smallest neighbour
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("at"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("at"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: neighbours below a node, and the node, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least.withColumnRenamed("u", "at"), F.col("u") == F.col("at"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        older, pairs = pairs, stored(small, "edges")
        release(older)
        after = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                          ).first()
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
