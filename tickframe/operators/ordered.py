"""Two-phase ordered window operators.

A plain ``Window.partitionBy(key).orderBy(frame)`` sends every row of a key to
one task; one hot replay/unit/team can hold a third of all rows.  These
operators instead partition by ``(keys, bucket)`` where
``bucket = floor(order_col / width)`` is a contiguous range of the ordering
column:

1. phase 1 (data-sized, parallel): the window runs inside each bucket;
2. phase 2 (tiny): what crosses a bucket boundary comes from one or two rows
   per (keys, bucket): the bucket's edge rows for ``lag`` and ``lead``, its
   totals for running sums.  A window over those, ``range / width`` rows per
   key, finishes the edge rows or supplies the carry-in;
3. totals are joined back on (keys, bucket) by key columns without nulls, the
   very columns the data is partitioned on, so the data moves once.

All results equal the single-window form (tests check this on fixtures).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_BUCKET_FRAMES

BUCKET = "__bkt"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


SKEW_CONF = "spark.tickframe.skewRows"


DEFAULT_SKEW_ROWS = 4_000_000  # ~ what one task sorts comfortably


def skew_rows(spark, keys: Sequence[str]) -> int | None:
    """Rows per (key, bucket) above which a bucket is split further.

    ``spark.tickframe.skewRows`` decides when set (``0`` turns refinement
    off).  Unset, refinement is on for replay-level operators (a single key
    column: the per-bucket count table is replays x buckets, tiny) and off for
    finer keys, whose frame buckets already spread a hot unit over time."""
    v = spark.conf.get(SKEW_CONF, None)
    if v is not None and v != "":
        return int(v) if int(v) > 0 else None
    return DEFAULT_SKEW_ROWS if len(keys) == 1 else None


def with_bucket(df: DataFrame, order_col: str, width: int,
                keys: Sequence[str] | None = None) -> DataFrame:
    """``__bkt``: a contiguous range of ``order_col`` per key.

    The coarse bucket is ``floor(order / width)``.  With a skew threshold set,
    a (key, coarse bucket) holding more rows than the threshold is cut into
    ``k = ceil(rows / threshold)`` equal sub-ranges of its observed span; the
    refinement table has at most total_rows / threshold entries (AQE
    broadcasts it on its measured size).  ``coarse * (width + 1) + sub`` stays
    monotone in the order column, so every operator works unchanged.  One
    frame value is never split (rows of one key at one frame stay together).
    """
    coarse = F.floor(F.col(order_col) / F.lit(width)).cast("long")
    limit = skew_rows(df.sparkSession, keys) if keys is not None else None
    if limit is None:
        return df.withColumn(BUCKET, coarse)
    d = df.withColumn("__coarse", coarse)
    hot = (d.groupBy(*keys, "__coarse")
           .agg(F.count(F.lit(1)).alias("__n"), F.min(order_col).alias("__lo"),
                F.max(order_col).alias("__hi"))
           .filter(F.col("__n") > limit)
           .select(*keys, "__coarse", "__lo",
                   F.greatest(F.lit(1).cast("long"), F.ceil(
                       (F.col("__hi") - F.col("__lo") + 1) / F.ceil(F.col("__n") / F.lit(limit)))
                   ).alias("__fw")))
    d, plain = with_plain_keys(d, keys)
    hot, _ = with_plain_keys(hot, keys)
    # at most total rows / limit entries, so small beside the data at any size
    d = join_on_keys(d, F.broadcast(hot.drop(*keys)), [*plain, "__coarse"]).drop(*plain)
    sub = F.coalesce(F.floor((F.col(order_col) - F.col("__lo")) / F.col("__fw")), F.lit(0))
    return d.withColumn(BUCKET, (F.col("__coarse") * F.lit(width + 1) + sub).cast("long")).drop(
        "__coarse", "__lo", "__fw")


def with_plain_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Columns that partition and join like ``keys`` but hold no nulls.

    A null-safe join condition is planned on rewritten keys, which no window's
    partitioning matches; with these columns a window and a later equi-join on
    them share one exchange of the data.
    """
    kinds = dict(df.dtypes)
    plain: list[str] = []
    for n, k in enumerate(keys):
        empty = F.lit("") if kinds[k] == "string" else F.lit(0)
        df = (df.withColumn(f"__k{n}", F.coalesce(F.col(k), empty.cast(kinds[k])))
              .withColumn(f"__z{n}", F.col(k).isNull()))
        plain += [f"__k{n}", f"__z{n}"]
    return df, plain


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "left") -> DataFrame:
    """Equi-join on key columns without nulls; right-side key copies are dropped."""
    ren = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k] == r[ren[k]]
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ren.values())


def prev_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                cols: Sequence[str], prefix: str = "prev_",
                width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Add ``prev_<c>``: the value of ``c`` on the previous row in ``order``
    within ``keys`` (null on the first row) -- ``lag`` without a hot task."""
    return _neighbours(df, keys, order, cols, prefix, width, F.lag)


def next_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                cols: Sequence[str], prefix: str = "next_",
                width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Add ``next_<c>``: the value on the following row (``lead``)."""
    return _neighbours(df, keys, order, cols, prefix, width, F.lead)


def _neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                prefix: str, width: int, step) -> DataFrame:
    """``step`` (lag or lead) of ``cols``.

    Rows inside a bucket are done after the first window.  The first and last
    row of each bucket go through a second window over those edge rows alone:
    there the neighbour of an edge row is the facing edge of the next bucket.
    Both branches read the same exchange, and no rows are joined.
    """
    d = with_bucket(df, order[0], width, keys)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*_cols(order))
    d = (d.withColumn("__first", F.lag(F.lit(1)).over(w).isNull())
         .withColumn("__last", F.lead(F.lit(1)).over(w).isNull()))
    for c in cols:
        d = d.withColumn(prefix + c, step(c).over(w))
    edge = F.col("__first") | F.col("__last")
    outer = F.col("__first" if step is F.lag else "__last")
    ws = Window.partitionBy(*keys).orderBy(BUCKET, *_cols(order))
    edges = d.where(edge)
    for c in cols:
        edges = edges.withColumn("__near", step(c).over(ws)).withColumn(
            prefix + c, F.when(outer, F.col("__near")).otherwise(F.col(prefix + c))).drop("__near")
    return d.where(~edge).unionByName(edges).drop("__first", "__last", BUCKET)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: Column | str, out: str,
                width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """``out`` = inclusive running sum of ``value`` over ``order`` within ``keys``."""
    val = F.col(value) if isinstance(value, str) else value
    d, plain = with_plain_keys(with_bucket(df, order[0], width, keys).withColumn("__v", val), keys)
    at = [*plain, BUCKET]
    w = (Window.partitionBy(*at).orderBy(*_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ws = (Window.partitionBy(*plain).orderBy(BUCKET)
          .rowsBetween(Window.unboundedPreceding, -1))
    summ = d.groupBy(*at).agg(F.sum("__v").alias("__tot"))
    summ = summ.select(*at, F.sum("__tot").over(ws).alias("__off"))
    res = join_on_keys(d.withColumn("__local", F.sum("__v").over(w)), summ, at)
    total = F.col("__local") + F.coalesce(F.col("__off"), F.lit(0).cast(d.schema["__v"].dataType))
    return res.withColumn(out, total).drop("__v", "__local", "__off", BUCKET, *plain)


def row_number0(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """0-based row number over a total ``order`` within ``keys``."""
    res = running_sum(df, keys, order, F.lit(1).cast("long"), out, width)
    return res.withColumn(out, F.col(out) - 1)
