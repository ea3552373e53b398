"""Rows are told apart by a bounded bit table, without moving them."""

import pytest
from pyspark.sql import functions as F

from tickframe.llm.common import key_bits, split_by_keys


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [[], [3, 5, 999], list(range(0, 5000, 3)), [None, 7]])
def test_no_row_is_lost_and_none_is_moved(spark, keys):
    rows = spark.range(5000).selectExpr("IF(id % 100 = 99, NULL, id) AS id", "'clash' AS __text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some, rest = split_by_keys(rows, F.col("id"), spark.createDataFrame(
            [(k,) for k in keys], "key long"), "test")
        assert "SortMergeJoin" not in plan(rest) and "Exchange hashpartitioning(__word" not in plan(
            rest).split("BroadcastExchange")[0]
        hit, missed = [[r["id"] for r in df.collect()] for df in (some, rest)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert some.columns == rest.columns == rows.columns
    assert sorted(map(repr, hit + missed)) == sorted(repr(r["id"]) for r in rows.collect())
    wanted = {k for k in keys if k is not None and k % 100 != 99}
    assert wanted <= set(hit) and not wanted & set(missed)
    assert len(hit) <= len(wanted) + 5000 * 0.2
    # what is joined later is a file scan
    assert "Join" not in plan(some)


def test_the_table_is_bounded(spark):
    bits, many = key_bits(spark.range(200).toDF("key"), 1 << 60)
    assert many == 1 << 26 and bits.count() <= 200
    assert key_bits(spark.range(10).toDF("key"), 10)[1] == 1 << 16
