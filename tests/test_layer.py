"""One decode for clean and rejected rows; a layer that decodes only what is new."""

import os

import pytest

from tickframe.plans import pipeline
from tickframe.sources import qualified, scan
from tickframe.sources.msgpack_lite import pack
from tickframe.sources.qualified import Layer


def write(root, replay, aspect, records, tail=b""):
    folder = os.path.join(root, replay)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{aspect}.mpk"), "wb") as file:
        file.write(b"".join(map(pack, records)) + tail)


def rows(df):
    return sorted(map(repr, df.collect()))


BAD = [[10, 1, 2, 3, 8, 0, None, 1, 2, 3],          # MOVE
       [11, 1, 2, 3, 99, 0, None, 1, 2, 3],         # enum
       [12, 1, 2, 3],                               # required values missing
       [13, 1, 2, 3, 8, 0, None, 1, 2, 3, 4],       # too long
       [14, "x", 2, 3, 99, 0, None, 1, 2, 3],       # type, and enum
       "no list", [15, 1, 2, 3, None, 0, 7, 1, 2, 3]]


@pytest.fixture
def files(tmp_path):
    root = str(tmp_path / "in")
    write(root, "r1", "commands_log", BAD, b"\x92\x01")
    write(root, "r2", "commands_log", BAD[:1] * 5)
    write(root, "r1", "map_envir_econ", [[0, 5, 1], [30, 6, 2]])
    return root


def test_split_once_equals_bind(spark, files, tmp_path):
    raw = scan.read_raw(spark, [files], ["commands_log"])
    want = scan.bind(raw, "commands_log")
    got = scan.split_once(raw, "commands_log", str(tmp_path / "out"))
    assert rows(got[0]) == rows(want[0]) and got[0].columns == want[0].columns
    assert rows(got[1]) == rows(want[1]) and got[1].columns == want[1].columns
    kinds = {d.split("=")[1] for d in os.listdir(tmp_path / "out") if d.startswith("reject=")}
    assert kinds == {"ok", "enum", "required", "length", "type", "decode"}


def test_split_reads_its_own_partitions(spark, files, tmp_path):
    clean, bad = scan.split_once(scan.read_raw(spark, [files], ["commands_log"]), "commands_log",
                                 str(tmp_path / "out"))
    for df, wanted in ((clean, "reject=ok"), (bad, "reject=")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(reject" in plan or "reject#" in plan
        assert "MapInArrow" not in plan        # nothing is decoded again
        assert any(wanted in f for f in df.inputFiles())


def test_second_update_decodes_only_new_replays(spark, files, tmp_path, monkeypatch):
    decoded = []
    real = scan.decode_split

    def counted(new, *args, **kw):
        decoded.append(sorted((r["replay_id"], r["aspect"]) for r in new.collect()))
        return real(new, *args, **kw)

    monkeypatch.setattr(scan, "decode_split", counted)
    layer, names = Layer(spark, str(tmp_path / "layer")), ["commands_log", "map_envir_econ"]
    assert layer.update([files], names)
    assert sorted(sum(decoded, [])) == [("r1", "commands_log"), ("r1", "map_envir_econ"),
                                        ("r2", "commands_log")]
    decoded.clear()
    assert layer.update([files], names) is None and decoded == []
    write(files, "r3", "commands_log", BAD[:1] * 2)
    assert layer.update([files], names)
    assert decoded == [[("r3", "commands_log")]]
    same_as_scan(spark, layer, [files], names)


def same_as_scan(spark, layer, roots, names):
    tables, bad = layer.read(roots, names)
    want, want_bad = scan.scan(spark, roots, names)
    for name in names:
        assert rows(tables[name]) == rows(want[name]), name
    assert rows(bad) == rows(want_bad)


def test_changed_removed_and_overridden_files(spark, files, tmp_path):
    layer, names = Layer(spark, str(tmp_path / "layer")), ["commands_log", "map_envir_econ"]
    layer.update([files], names)
    write(files, "r1", "commands_log", BAD[:1] * 3)                 # changed
    layer.update([files], names)
    same_as_scan(spark, layer, [files], names)
    os.remove(os.path.join(files, "r2", "commands_log.mpk"))        # gone
    assert layer.update([files], names) is None
    same_as_scan(spark, layer, [files], names)
    later = str(tmp_path / "later")
    write(later, "r1", "map_envir_econ", [[0, 9, 9]])               # a later root wins
    layer.update([files, later], names)
    same_as_scan(spark, layer, [files, later], names)
    same_as_scan(spark, layer, [files, str(tmp_path / "missing")], names[:1])


def test_an_unfinished_batch_is_not_read(spark, files, tmp_path, monkeypatch):
    layer, names = Layer(spark, str(tmp_path / "layer")), ["commands_log"]
    with monkeypatch.context() as m:
        m.setattr(qualified, "_rename", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            layer.update([files], names)
    assert layer.manifest().count() == 0
    assert layer.read([files], names)[0]["commands_log"].count() == 0
    assert layer.update([files], names)
    same_as_scan(spark, layer, [files], names)


def test_another_version_starts_afresh(spark, files, tmp_path):
    Layer(spark, str(tmp_path / "layer"), "a").update([files], ["commands_log"])
    other = Layer(spark, str(tmp_path / "layer"), "b")
    assert other.manifest().count() == 0 and other.update([files], ["commands_log"])


def test_run_over_files_uses_the_layer(spark, files, tmp_path):
    out, layer = str(tmp_path / "out"), str(tmp_path / "layer")
    status = pipeline.run_files(spark, [files], layer, out, stats=["calculate_player_apm_and_focus"],
                                streams=["commands_log"])
    assert status == {"calculate_player_apm_and_focus": "written", "commands_log": "written",
                      "quarantine": "written"}
    assert spark.read.parquet(f"{out}/quarantine").count() == 6
    batches = Layer(spark, layer).manifest().select("batch").distinct().count()
    pipeline.run_files(spark, [files], layer, out, stats=[], streams=["commands_log"])
    assert Layer(spark, layer).manifest().select("batch").distinct().count() == batches


def test_frames_that_decrease_are_counted_within_and_between_ranges(spark):
    import random

    from tickframe.operators import ordered
    from tickframe.plans import checks
    draw = random.Random(5)
    data = [(draw.choice([None, 1, 2, 3]), draw.choice([None, -1, 0, 5, 9, 20]),
             draw.choice([None, *range(40)]), draw.choice([None, 1]), 1) for _ in range(600)]
    data += [(4, 7, 100, 1, 1), (4, 6, 900, 1, 1), (4, 8, 2000, 1, 1)]      # ranges far apart
    df = spark.createDataFrame(data, "replay_id long, frame long, row_ord long, "
                                     "wind_strength long, tidal_strength long")

    def low(v):
        return (v is not None, v or 0)

    want = {}
    for replay in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == replay), key=lambda r: (low(r[2]), low(r[1])))
        frames = [r[1] for r in mine]
        want[replay] = {
            "required_null": sum(None in (r[1], r[3]) for r in mine),
            "frame_negative": sum(f is not None and f < 0 for f in frames),
            "frame_decreasing": sum(None not in (a, b) and b < a
                                    for a, b in zip(frames, frames[1:], strict=False))}
    for width in (1, 7, checks.ORDERED_ROWS):
        got = {}
        for r in checks.aspect_checks({"map_envir_econ": df}, "map_envir_econ", width).collect():
            got.setdefault(r["replay_id"], {})[r["check"]] = r["violations"]
        assert got == want, width
    plan = checks.aspect_checks({"map_envir_econ": df}, "map_envir_econ")._jdf.queryExecution()
    # rows are read once and sorted once: no count of ranges, no pass over their edges
    plan = plan.optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Union" not in plan and ordered.BUCKET in plan
