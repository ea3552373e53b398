"""Byte ranges of MessagePack streams: boundaries, chain check, index, decoding."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickframe.sources import mpk_split as M
from tickframe.sources import scan
from tickframe.sources.msgpack_lite import iter_records, pack

VALUE = st.recursive(
    st.none() | st.booleans() | st.integers(-2**63, 2**64 - 1) | st.floats(allow_nan=False)
    | st.text(max_size=40) | st.binary(max_size=300),
    lambda inner: st.lists(inner, max_size=20) | st.dictionaries(st.text(max_size=5), inner,
                                                                 max_size=4), max_leaves=30)


@given(st.lists(VALUE, max_size=6))
@settings(max_examples=200, deadline=None)
def test_skip_finds_the_same_ends_as_decoding(values):
    data = b"".join(pack(v) for v in values)
    at, ends = 0, []
    while at < len(data):
        at = M.skip(data, at)
        ends.append(at)
    lengths = [len(pack(v)) for v in values]
    assert ends == [sum(lengths[:i + 1]) for i in range(len(values))]


@pytest.mark.parametrize("head", [b"\xcc\x01", b"\xcd\x01\x02", b"\xce" + b"\x01" * 4,
                                  b"\xd0\x01", b"\xd1\x01\x01", b"\xd2" + b"\1" * 4,
                                  b"\xca" + b"\1" * 4, b"\xd9\x03abc", b"\xda\x00\x03abc",
                                  b"\xc4\x02ab", b"\xc5\x00\x02ab", b"\xdc\x00\x02\x01\x02",
                                  b"\xde\x00\x01\x01\x02", b"\xa3abc", b"\x92\x01\xc0",
                                  b"\x81\x01\xc3", b"\xe0", b"\x7f"])
def test_skip_knows_every_form(head):
    assert M.skip(head + b"\x01", 0) == len(head)
    with pytest.raises(M._More):
        M.skip(head[:-1], 0)


def records(seed, n):
    draw = random.Random(seed)
    return [[i, draw.randrange(2**40), draw.random(), "s" * draw.randrange(12), None, bool(i % 2),
             [i, 2], draw.choice([b"", b"\x93\x01\x02\x03" * draw.randrange(9)])]
            for i in range(n)]


def disguised(n):
    """Records whose binary values are whole streams of look-alike records."""
    inner = b"".join(pack([1, 2, 3]) for _ in range(120))
    return [[i, inner, "x"] for i in range(n)]


def one_long(n):
    return [[0, "a" * 5000], *[[i, "b"] for i in range(n)], [n, "c" * 9000], [n + 1, "d"]]


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(data)


def raw_rows(df):
    return sorted((r["replay_id"], r["row_ord"], tuple(r["vals"] or ()), r["decode_error"])
                  for r in df.collect())


def whole(spark, root):
    return raw_rows(scan.decode_files(scan.discover(spark, [root])))


CASES = {
    "plain": b"".join(map(pack, records(1, 400))),
    "disguised": b"".join(map(pack, disguised(40))),
    "long records": b"".join(map(pack, one_long(300))),
    "empty": b"",
    "one record": pack([1, 2]),
    "no arrays": b"".join(pack(i) for i in range(500)),
    "mixed arities": b"".join(pack([1] * (i % 5)) for i in range(600)),
    "cut tail": b"".join(map(pack, records(2, 300)))[:-3],
    "broken middle": b"".join(map(pack, records(3, 150))) + b"\xc1" + b"".join(
        map(pack, records(4, 150))),
}


@pytest.mark.parametrize("split", [400, 3000])
def test_ranges_equal_whole_files(spark, tmp_path, split):
    for i, data in enumerate(CASES.values()):
        write(str(tmp_path / f"r{i}" / "things.mpk"), data)
    files = scan.discover(spark, [str(tmp_path)], with_content=False)
    got, want = raw_rows(scan.decode_split(files, split)), whole(spark, str(tmp_path))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    # errors stand at the same rows, the place counted from the file's start
    assert [(r[0], r[1]) for r in got if r[3]] == [(r[0], r[1]) for r in want if r[3]]
    assert [r[3] for r in got] == [r[3] for r in want]


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    write(str(tmp_path / "r" / "things.mpk"), b"".join(map(pack, records(5, 3000))))
    files = scan.discover(spark, [str(tmp_path)], with_content=False)
    ranges = M.index(files, 4096)
    length = os.path.getsize(tmp_path / "r" / "things.mpk")
    spans = sorted((r["first"], r["stop"]) for r in ranges.collect())
    assert len(spans) > 20 and spans[0][0] == 0 and spans[-1][1] == length
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    raw = scan.decode_split(files, 4096)
    tasks = raw.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4


def test_false_guesses_are_corrected(tmp_path):
    data = b"".join(map(pack, disguised(20)))
    path = str(tmp_path / "f")
    write(path, data)
    inside = data.index(b"\xc6") + 60           # in the middle of a binary value
    with open(path, "rb") as file:
        first, *_ = M.probe(file, len(data), inside, inside + 100, None)
        assert first is not None and first < inside + 100       # the guess is fooled
        stop = M.skip(data, 0)
        again = M.probe(file, len(data), inside, inside + 100, stop)
    assert again == (stop, stop, 0, None)       # and put right by the chain


def test_index_is_kept_and_follows_changes(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "index")
    write(str(root / "a" / "things.mpk"), b"".join(map(pack, records(6, 300))))
    write(str(root / "b" / "things.mpk"), b"".join(map(pack, records(7, 10))))

    def read():
        return raw_rows(scan.decode_split(
            scan.discover(spark, [str(root)], with_content=False), 700, store))

    assert read() == whole(spark, str(root))
    entries = spark.read.parquet(store).count()
    assert read() == whole(spark, str(root)) and spark.read.parquet(store).count() == entries
    write(str(root / "a" / "things.mpk"), b"".join(map(pack, records(8, 250))))
    write(str(root / "c" / "things.mpk"), b"".join(map(pack, records(9, 120))))
    assert read() == whole(spark, str(root))


def test_range_size():
    assert M.split_size(100, 8) == M.MIN_SPLIT
    assert M.split_size(1 << 50, 8) == M.MAX_SPLIT
    assert M.split_size(80 << 20, 8) == 10 << 20


def test_writer_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("p", 1, 1.5, "x", True), ("q", 2, None, None, None)],
                               "replay_id string, a long, b double, c string, d boolean")
    M.write(df.repartition(2), ["a", "b", "c", "d"], "things", str(tmp_path))
    got = scan.read_raw(spark, [str(tmp_path)], ["things"])
    assert sorted((r["replay_id"], tuple(r["vals"])) for r in got.collect()) == [
        ("p", ("i:1", "f:1.5", "s:x", "b:true")), ("q", ("i:2", None, None, None))]
    assert not [f for _, _, fs in os.walk(tmp_path) for f in fs if f.startswith(".things")]
    assert list(iter_records(b"")) == []


def test_writer_keeps_all_batches(spark, tmp_path):
    rows = spark.range(25_000).selectExpr("CAST(id % 3 AS string) AS replay_id", "id AS a",
                                          "CAST(1 + id % 2 AS int) AS n", "'x' AS b").coalesce(1)
    M.write(rows, ["a", "b"], "things", str(tmp_path), "n")
    got = scan.read_raw(spark, [str(tmp_path)], ["things"], split=9000)
    assert got.count() == 25_000
    assert sorted(r[0] for r in got.selectExpr("vals[0]").collect()) == sorted(
        f"i:{i}" for i in range(25_000))
    assert got.where("size(vals) = 2 AND vals[1] = 's:x'").count() == 12_500


def test_a_file_a_replay_however_many_tasks_write(spark, tmp_path):
    df = spark.range(4000).selectExpr("id % 40 AS replay_id", "id AS a", "id * 2 AS b")
    M.write(df.repartition(6), ["a", "b"], "things", str(tmp_path))
    files = scan.discover(spark, [str(tmp_path)], with_content=False).collect()
    assert len(files) == 40 == len({r["replay_id"] for r in files})
    rows = raw_rows(scan.read_raw(spark, [str(tmp_path)], ["things"]))
    assert len(rows) == 4000


def test_tasks_list_what_spark_lists(spark, tmp_path):
    for at in ("a/things.mpk", "b/c/things.mpk", "b/c/d/e/things.mpk", "b/c/notes.txt",
               ".hidden/things.mpk", "_kept/things.mpk", "b/_things.mpk", "b/.things.mpk",
               "top.mpk", "x=1/_y=2/things.mpk", "sp ace/t%20h.mpk"):
        write(str(tmp_path / at), b"".join(map(pack, records(len(at), 20))))
    columns = ["path", "length", "modified", "replay_id", "aspect"]
    by_task = scan.discover(spark, [str(tmp_path)], with_content=False).select(*columns).collect()
    by_spark = scan.discover(spark, [str(tmp_path)]).select(*columns).collect()
    assert sorted(by_task) == sorted(by_spark) and len(by_task) == 6
    files = scan.discover(spark, [str(tmp_path)], with_content=False)
    assert not [f for f in files.inputFiles() if f.endswith(".mpk")]
