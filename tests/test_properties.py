"""Property tests: bucketed operators equal the one-window definition for
random data, limits and bucket widths (few examples: each runs Spark)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import make
from tickframe.operators import gap_sessionize, next_values
from tickframe.operators.sessionize import time_gap_rule

rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3000)), min_size=1, max_size=80)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, limit=st.integers(0, 400), width=st.integers(1, 5000))
def test_sessions_property(spark, rows, limit, width):
    df = make(spark, [(k, f, i) for i, (k, f) in enumerate(rows)], "k long, frame long, row_ord long")
    w = Window.partitionBy("k").orderBy("frame", "row_ord")
    flag = F.when(F.lag("frame").over(w).isNull(), 1).when(
        F.col("frame") - F.lag("frame").over(w) > limit, 1).otherwise(0)
    ref = df.withColumn("f", flag).withColumn(
        "sid", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = gap_sessionize(df, ["k"], ["frame", "row_ord"], ["frame"], time_gap_rule("frame", limit),
                         out="sid", width=width)
    nxt = next_values(df, ["k"], ["frame", "row_ord"], ["frame"], width=width)
    lead = df.select("row_ord", F.lead("frame").over(w).alias("n"))
    assert sorted((r.row_ord, r.sid) for r in got.collect()) == sorted(
        (r.row_ord, r.sid) for r in ref.collect())
    assert sorted((r.row_ord, r.next_frame) for r in nxt.collect()) == sorted(
        (r.row_ord, r.n) for r in lead.collect())
