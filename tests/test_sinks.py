"""Output contracts and sinks: casts, quantize, enums, null encoding, binary
layouts (round-tripped through numpy / zstd)."""

import json
import re

import numpy as np
import pytest
import zstandard

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import make
from tickframe.sinks import bundle as B
from tickframe.sinks import contracts as C
from tickframe.sinks import writers as W


def test_quantize_cast_enum_and_metadata(spark):
    df = make(spark, [("r", 1, 12.34, "DESTROYED"), ("r", 2, 0.25, "NOPE")],
              "replay_id string, frame long, v double, event_type string")
    c = C.Contract({"frame": C.cast("UInt32"), "v": C.quantize(0.1, "UInt32"),
                    "event_type": C.enum_to_int("UnitEventsEnum", "Int32")}, layout="columnar")
    out = C.apply_contract(df, c)
    rows = out.orderBy("frame").collect()
    assert [r.v for r in rows] == [123, 2]  # 2.5 -> 2 (half-even)
    assert [r.event_type for r in rows] == [3, None]
    meta = out.schema["v"].metadata["contract"]
    assert meta["transform"] == "static_quantize" and meta["scale"] == 0.1
    assert out.schema["frame"].metadata["contract"]["original_dtype"] == "bigint"


def test_unsigned_range_and_contract_errors(spark):
    df = make(spark, [("r", -1)], "replay_id string, x long")
    with pytest.raises(Exception, match="out of UInt16 range"):
        C.apply_contract(df, C.Contract({"x": C.cast("UInt16")})).collect()
    with pytest.raises(C.ContractError, match="to_type"):
        C.apply_contract(df, C.Contract({"x": C.Rule("cast", None)}))
    with pytest.raises(C.ContractError, match="does not fit"):
        C.apply_contract(df, C.Contract({"x": C.cast("UInt16", -1)}))
    with pytest.raises(C.ContractError, match="unknown enum"):
        C.apply_contract(df, C.Contract({"x": C.enum_to_int("Nope", "Int32")}))


def test_null_encoding_rules(spark):
    df = make(spark, [("r", None, None), ("r", 5, 1.5)], "replay_id string, a long, f double")
    rm = C.encode_nulls(df, C.Contract(layout="row-major-mixed", null_encoding=0))
    assert sorted((r.a, r.f) for r in rm.collect()) == [(0, 0.0), (5, 1.5)]
    col = C.encode_nulls(df, C.Contract({"a": C.cast("Int64", -1)}, layout="columnar"))
    assert sorted([(r.a, r.f) for r in col.collect()], key=str) == sorted([(-1, None), (5, 1.5)], key=str)
    with pytest.raises(Exception, match="has nulls"):
        C.encode_nulls(df, C.Contract(layout="row-major-mixed")).collect()


def _concat(chunks, key):
    rows = sorted((r.replay_id, r.part, r.seq, r.blob) for r in chunks.filter(
        chunks.data_key == key).collect())
    out = {}
    for rid, _, _, blob in rows:
        out.setdefault(rid, b"")
        out[rid] += zstandard.ZstdDecompressor().decompressobj().decompress(blob)
    return out


def _offsets(chunks, key):
    """The offsets of a column, its chunks simply joined."""
    return np.frombuffer(_concat(chunks, key)["r"], "<u4").tolist()


def test_row_major_bundle_roundtrip(spark):
    rows = [(str(r), f, t, float(v)) for r in range(3) for f, t, v in
            [(0, 1, 10.0), (450, 1, 20.5), (450, 2, 0.0)]]
    df = make(spark, rows, "replay_id string, frame long, team_id long, army_value double")
    chunks, schema = W.row_major_bundle({"army_value_timeline": df},
                                        {"army_value_timeline": ["frame", "team_id"]})
    data = _concat(chunks, "army_value_timeline.rows")
    dt = np.dtype([("frame", "<u4"), ("team_id", "<u4"), ("army_value", "<u4")])
    got = np.frombuffer(data["1"], dtype=dt)
    assert got.tolist() == [(0, 1, 100), (450, 1, 205), (450, 2, 0)]
    doc = json.loads({r.replay_id: r.schema_json for r in schema.collect()}["1"])
    s = doc["streams"]["army_value_timeline"]
    assert s["num_rows"] == 3 and s["row_byte_stride"] == 12 and doc["schema_version"].startswith("7.0")


def test_columnar_encodings(spark):
    df = make(spark, [("r", 0, "ab", [1, 2]), ("r", 1, "", []), ("r", 2, "é", [3])],
              "replay_id string, frame long, name string, ids array<long>")
    chunks, schema = W.columnar_bundle({"things": df})
    nulls = make(spark, [("r", 0, None)], "replay_id string, frame long, name string")
    with pytest.raises(Exception, match="has nulls"):
        W.columnar_bundle({"things": nulls})[0].collect()
    get = lambda k: _concat(chunks, k)["r"]
    assert np.frombuffer(get("things.frame"), "<i8").tolist() == [0, 1, 2]
    assert _offsets(chunks, "things.name_offs") == [0, 2, 2, 4]
    assert get("things.name_data").decode() == "abé"
    assert _offsets(chunks, "things.ids_offs") == [0, 2, 2, 3]
    assert np.frombuffer(get("things.ids_vals"), "<i8").tolist() == [1, 2, 3]
    assert json.loads(schema.collect()[0].schema_json)["streams"]["things"]["num_rows"] == 3


def test_list_of_struct_encoding():
    import pyarrow as pa
    arr = pa.array([[{"a": 1, "b": 2}], [], [{"a": 3, "b": 4}, {"a": 5, "b": 6}]])
    enc = W.encode_array(arr, "s")
    assert np.frombuffer(enc["s_list_offs"], "<u4").tolist() == [0, 1, 1, 3]
    assert np.frombuffer(enc["s.a"], "<i8").tolist() == [1, 3, 5]


def test_parquet_and_jsonl_skip_empty(spark, tmp_path):
    df = make(spark, [("r", 1)], "replay_id string, x long")
    empty = df.filter("x > 5")
    assert W.write_parquet({"a": df, "b": empty}, str(tmp_path / "pq")) == ["a"]
    assert W.write_jsonl_gz({"a": df, "b": empty}, str(tmp_path / "js")) == ["a"]
    assert spark.read.parquet(str(tmp_path / "pq" / "a")).count() == 1
    assert spark.read.json(str(tmp_path / "js" / "a")).count() == 1


def test_damage_contract_marks_missing_attackers(spark):
    df = make(spark, [("r", 1, None), ("r", 2, 7)],
              "replay_id string, frame long, attacker_unit_id long")
    got = W.prepare(df, "damage_log").collect()
    assert sorted(r["attacker_unit_id"] for r in got) == [7, 65535]


def test_lookup_rows(spark):
    defs = make(spark, [(1, "a", "A"), (2, "b", "B")],
                "unit_def_id long, unit_name string, translated_human_name string")
    assert sorted((r.key, tuple(r["values"])) for r in C.lookup_rows(defs).collect()) == [
        (1, ("a", "A")), (2, ("b", "B"))]


NESTED = ("replay_id string, frame long, name string, ids array<long>, tags array<string>, "
          "stats array<struct<unit_def_id: long, label: string, marks: array<int>>>, on boolean, "
          "value double")


def nested_rows(n, replay="r"):
    return [(replay, i, "é" * (i % 4), list(range(i % 3)), [f"t{k}" for k in range(i % 4)],
             [(k, f"l{k}", list(range(k))) for k in range(i % 5)], i % 2 == 0, i / 4)
            for i in range(n)]


NESTED_COLUMNS = ("frame", "name", "ids", "tags", "stats", "on", "value")


def _types(df):
    return [(f.name, W._logical(f) if not isinstance(f.dataType, (T.ArrayType, T.StringType))
             else None, f.dataType) for f in df.schema if f.name != "replay_id"]


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    yield
    spark.conf.set(key, before)


def test_nested_columns_over_many_chunks(spark, small_batches):
    rows = nested_rows(100) + nested_rows(40, "s") + nested_rows(1, "t")
    df = make(spark, rows, NESTED)
    chunks, _ = W.columnar_bundle({"things": df}, {"things": ["frame"]})
    chunks.cache()
    assert chunks.where("data_key = 'things.frame' AND replay_id = 'r'").count() > 10
    # the chunks joined are one valid file: offsets go up to the length of what they span
    for key in ("name", "tags", "ids"):
        offs, data = _offsets(chunks, f"things.{key}_offs"), {
            "name": "name_data", "tags": "tags_vals_offs", "ids": "ids_vals"}[key]
        assert len(offs) == 101 and offs == sorted(offs) and offs[0] == 0
        size = len(_concat(chunks, f"things.{data}")["r"])
        assert offs[-1] == {"name": size, "tags": size // 4 - 1, "ids": size // 8}[key]
    names = _concat(chunks, "things.name_data")["r"]
    offs = _offsets(chunks, "things.name_offs")
    assert [names[a:b].decode() for a, b in zip(offs, offs[1:], strict=False)] == [
        r[2] for r in rows[:100]]
    assert len(_offsets(chunks, "things.stats_list_offs")) == 101
    got = W.read_columnar(chunks, "things", _types(df)).orderBy("replay_id", "part", "seq", "row")
    assert [tuple(r) for r in got.select("replay_id", *NESTED_COLUMNS).collect()] == [
        tuple(r) for r in df.orderBy("replay_id", "frame").collect()]


def test_offsets_follow_hot_replays_and_empty_lists(spark, small_batches):
    rows = [("r", i, "", [], [], [], False, 0.0) for i in range(50)] + [
        ("r", 50 + i, "x" * 10, [1], ["a"], [(1, "b", [2])], True, 1.0) for i in range(50)]
    df = make(spark, rows, NESTED)
    chunks, _ = W.columnar_bundle({"things": df}, {"things": ["frame"]})
    offs = _offsets(chunks, "things.name_offs")
    assert offs == [0] * 51 + [10 * k for k in range(1, 51)]
    got = W.read_columnar(chunks, "things", _types(df))
    assert sorted(map(repr, got.select("replay_id", *NESTED_COLUMNS).collect())) == sorted(
        map(repr, df.collect()))


def test_files_follow_bytes_and_replays_are_found(spark, tmp_path):
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id % 100) END AS replay_id",
        "id AS frame", "sha2(CAST(id AS string), 256) AS x")
    W.write_parquet({"things": df}, str(tmp_path), orders={"things": ["frame"]},
                    file_bytes=200_000)
    files = [f for f in (tmp_path / "things").iterdir() if f.suffix == ".parquet"]
    assert 3 <= len(files) <= 20
    back = spark.read.parquet(str(tmp_path / "things"))
    assert sorted(back.columns) == sorted(df.columns) and back.count() == 30_000
    one = W.read_replays(spark, str(tmp_path), "things", ["r7"], df.schema)
    assert sorted(map(tuple, one.collect())) == sorted(
        map(tuple, df.where("replay_id = 'r7'").collect()))
    assert 0 < len(one.inputFiles()) < len(files)
    hot = W.read_replays(spark, str(tmp_path), "things", ["hot"], df.schema)
    assert hot.count() == 10_000 and len(hot.inputFiles()) > 1        # a hot replay is split
    assert W.read_replays(spark, str(tmp_path), "things", ["none"], df.schema).count() == 0
    W.write_jsonl_gz({"things": df}, str(tmp_path / "j"), orders={"things": ["frame"]},
                     file_bytes=400_000)
    again = W.read_replays(spark, str(tmp_path / "j"), "things", ["r7", "hot"], df.schema, "json")
    assert again.count() == one.count() + 10_000


def test_hybrid_bundle_with_assets(spark, tmp_path):
    army = make(spark, [("r", 0, 1, 10.0), ("r", 450, 1, 20.0)],
                "replay_id string, frame long, team_id long, army_value double")
    binned = make(spark, [("r", 1, 2, 0, 1, 10.0, 0, 1.0, 0.0, 0.0, 0.0)],
                  "replay_id string, team_id long, unit_def_id long, time_bin_start_frame long, "
                  "units_alive_in_bin long, total_unit_seconds_in_bin double, "
                  "total_units_produced_in_bin long, total_metal_produced_in_bin double, "
                  "total_metal_consumed_in_bin double, total_energy_produced_in_bin double, "
                  "total_energy_consumed_in_bin double")
    defs = make(spark, [(1, "a", "A")], "unit_def_id long, unit_name string, translated_human_name string")
    meta = make(spark, [("p", bytearray(b'{"id": "g"}'))], "path string, content binary")
    things = make(spark, nested_rows(30), NESTED)
    streams = {"army_value_timeline": army, "unit_economic_contribution_binned": binned,
               "things": things}
    bundle = B.hybrid_bundle(streams, defs=defs, game_meta=meta,
                             orders={"army_value_timeline": ["frame", "team_id"],
                                     "unit_economic_contribution_binned": ["time_bin_start_frame"]})
    out, header = bundle
    keys = {r.data_key for r in out.select("data_key").distinct().collect()}
    assert {"army_value_timeline.rows", "defs_map.lookup", "game_meta.json",
            "unit_economic_contribution_binned.units_alive_in_bin"} <= keys
    lookup = _concat(out, "defs_map.lookup")["*"].decode()
    assert json.loads(lookup) == {"key": 1, "values": ["a", "A"]}
    path = str(tmp_path / "bundle")
    B.write_bundle(bundle, path)
    doc = json.loads(header.where("replay_id = 'r'").first()["schema_json"])
    assert doc["schema_version"] == B.VERSION and doc["replay_id"] == "r"
    assert doc["static_assets"] == ["game_meta", "defs_map"] and set(doc["streams"]) == set(streams)
    rows = doc["streams"]["army_value_timeline"]
    assert rows["num_rows"] == 2 and rows["byte_size"] == 24 == 2 * rows["row_byte_stride"]
    stats = {c["name"]: c for c in doc["streams"]["things"]["columns"]}["stats"]
    assert "things.stats.marks_vals" in stats["data_keys"]
    # one stream or column is opened by the header alone
    got = B.read_stream(spark, path, "things")
    assert sorted(map(repr, got.select("replay_id", *NESTED_COLUMNS).collect())) == sorted(
        map(repr, things.collect()))
    one = B.read_stream(spark, path, "things", ["name"])
    assert [r["name"] for r in one.orderBy("part", "seq", "row").collect()] == [
        r[2] for r in nested_rows(30)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: (.*)", plan)[1]
    assert "stream#" in filters and "data_key#" in filters
    army_back = B.read_stream(spark, path, "army_value_timeline").orderBy("part", "row").collect()
    assert [(r["frame"], r["team_id"], r["army_value"]) for r in army_back] == [
        (0, 1, 100), (450, 1, 200)]
    with pytest.raises(KeyError, match="no stream"):
        B.read_stream(spark, path, "nothing")
    with pytest.raises(KeyError, match="no column"):
        B.read_stream(spark, path, "things", ["nope"])
    assert B.read_asset(spark, path, "game_meta").first()["blob"] == bytearray(b'{"id": "g"}')


def test_directory_places_add_up(spark, small_batches):
    out, _ = B.hybrid_bundle({"things": make(spark, nested_rows(60), NESTED)},
                             orders={"things": ["frame"]})
    for key in ("things.frame", "things.name_offs", "things.name_data"):
        at = 0
        for r in out.where(out.data_key == key).orderBy("part", "seq").collect():
            assert r["byte_start"] == at
            at += r["raw_bytes"]
        assert at == len(_concat(out, key)["r"])


def test_bundle_header_quotes_names(spark):
    odd = 'r"1\\x'
    df = make(spark, [(odd, 1, "a")], "replay_id string, frame long, name string")
    _, header = B.hybrid_bundle({"things": df})
    assert json.loads(header.first()["schema_json"])["replay_id"] == odd


def test_unit_ids_past_sixteen_bits(spark):
    df = spark.range(65_530, 65_545).selectExpr("1L AS replay_id", "id AS frame", "id AS unit_id",
                                                *(f"0L AS {c}" for c in (
                                                    "unit_def_id", "team_id", "x", "y", "z")),
                                                *(f"0.0D AS {c}" for c in ("vx", "vy", "vz")))
    out = W.prepare(df, "unit_positions")
    assert out.schema["unit_id"].dataType.simpleString() == "int"
    assert sorted(r.unit_id for r in out.collect()) == list(range(65_530, 65_545))


def test_files_follow_rows_that_compress_well(spark, tmp_path, monkeypatch):
    """A file of few bytes may hold more rows than a task can sort."""
    monkeypatch.setattr(W, "FILE_ROWS", 1000)
    df = spark.range(10_000).selectExpr("id % 50 AS replay_id", "1L AS frame")
    W.write_parquet({"s": df}, str(tmp_path), orders={"s": ["frame"]})
    files = spark.read.parquet(f"{tmp_path}/s").selectExpr("_metadata.file_name AS f").groupBy(
        "f").count().collect()
    assert len(files) > 5 and max(r["count"] for r in files) < 3000
    index = spark.read.parquet(f"{tmp_path}/s/{W.INDEX}")
    assert {(r.replay_id, r.n) for r in index.groupBy("replay_id").agg(
        F.sum("rows").alias("n")).collect()} == {(i, 200) for i in range(50)}


def test_chunks_of_many_replays_come_in_few_batches(spark):
    df = spark.range(5000).selectExpr("id AS replay_id", "id AS frame", "2L AS team_id",
                                      "id * 0.5 AS army_value")
    prepared = W.prepare(df, "army_value_timeline")
    chunks = W.pack_row_major(prepared, "army_value_timeline", ["frame"], partitions=3)
    keys = chunks.select("part", "seq").distinct().count()
    assert chunks.count() == keys == 5000
    rows = W.read_row_major(chunks, "army_value_timeline", W.row_major_dtype(prepared),
                            prepared.schema)
    assert sorted((int(r.replay_id), r.row, r.frame, r.team_id) for r in rows.collect()) == [
        (i, 0, i, 2) for i in range(5000)]
