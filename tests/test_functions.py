from tests.conftest import make
from tickframe.functions import (
    bin_start, code_to_name, force_int_column, minute_of, name_to_code, null_counts, quantize,
    union_diagonal,
)
from pyspark.sql import functions as F


def test_frame_helpers(spark):
    df = make(spark, [(0,), (1799,), (1800,), (599,)], "frame long")
    got = df.select(minute_of("frame").alias("m"), bin_start("frame", 300).alias("b")).collect()
    assert [(r.m, r.b) for r in got] == [(0, 0), (0, 1500), (1, 1800), (0, 300)]


def test_enum_and_quantize(spark):
    df = make(spark, [(8, "MOVE", 12.34), (99, "NOPE", 0.05)], "c long, n string, v double")
    got = df.select(code_to_name("c", "CommandsEnum").alias("n"),
                    name_to_code("n", "CommandsEnum").alias("c"),
                    quantize("v", 0.1).alias("q")).collect()
    assert [(r.n, r.c, r.q) for r in got] == [("MOVE", 8, 123.0), (None, None, 0.0)]


def test_force_int_union_diagonal_null_counts(spark):
    s = make(spark, [((3.7,), 1)], "frame struct<frame: double>, k long")
    out = force_int_column(s, "frame")
    assert out.collect()[0].frame == 3 and dict(out.dtypes)["frame"] == "bigint"
    a = make(spark, [(1, "x")], "a long, b string")
    b = make(spark, [(2, 5.0)], "a long, c double")
    u = union_diagonal(a, b)
    assert sorted(u.columns) == ["a", "b", "c"] and u.count() == 2
    n = null_counts(u).collect()[0]
    assert (n.a, n.b, n.c) == (0, 1, 1)
