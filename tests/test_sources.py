"""Ingest: MessagePack scan, positional bind, quarantine, dims, qualified layer."""

import os

import pytest

from tickframe.sources import dims, qualified, scan
from tickframe.sources.msgpack_lite import iter_records, pack


def _write(root, replay, aspect, records, tail=b""):
    d = os.path.join(root, replay)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{aspect}.mpk"), "wb") as fh:
        fh.write(b"".join(pack(r) for r in records) + tail)


def test_msgpack_roundtrip():
    recs = [[1, -5, 2**40, 1.5, "hé", None, True, False, [1, 2], {"a": 1}, b"\x00"]]
    assert [r for r, _ in iter_records(b"".join(pack(r) for r in recs))] == recs
    out = list(iter_records(pack([1, 2]) + b"\x92\x01"))
    assert out[0] == ([1, 2], None) and out[1][0] is None and "truncated" in out[1][1]


# map_envir_econ: frame, wind_strength, tidal_strength (all required)
# commands_log: frame, teamId, unitId, cmd_id, cmd_name?, cmd_tag, target_unit_id?, x, y, z
def test_scan_bind_and_quarantine(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    _write(a, "r1", "map_envir_econ", [[0, 5, 1], [30, 6, 2]])
    _write(b, "r1", "map_envir_econ", [[0, 7, 3]])           # later root overrides r1
    _write(a, "r2", "map_envir_econ", [[0, 1, 1], [30, 1], [60, 1, 1, 9], [90, "x", 1]])
    _write(a, "r2", "commands_log", [[10, 1, 2, 3, 8, 0, None, 1, 2, 3],      # MOVE
                                     [11, 1, 2, 3, 99, 0, None, 1, 2, 3],     # bad enum code
                                     [12, 1, 2, 3]])                          # short: required missing
    tables, q = scan.scan(spark, [a, b, str(tmp_path / "missing")],
                          aspects=["map_envir_econ", "commands_log"])
    env = {(r.replay_id, r.frame): r for r in tables["map_envir_econ"].collect()}
    assert env[("r1", 0)].wind_strength == 7 and ("r1", 30) not in env
    assert set(env) == {("r1", 0), ("r2", 0)}
    reasons = {(r.aspect, r.row_ord): r.reason for r in q.collect()}
    assert "required value missing" in reasons[("map_envir_econ", 1)]
    assert "3 fields, got 4" in reasons[("map_envir_econ", 2)]
    assert "expected integer" in reasons[("map_envir_econ", 3)]
    assert "unknown CommandsEnum code 99" in reasons[("commands_log", 1)]
    assert ("commands_log", 2) in reasons
    (cmd,) = tables["commands_log"].collect()
    assert cmd.cmd_name == "MOVE" and cmd.target_unit_id is None


def test_bad_enum_null_policy_and_dequantize(spark, tmp_path):
    root = str(tmp_path)
    # unit_economy: frame, unit_id, unit_def_id, team_id, event_type, metal_make/10 ...
    _write(root, "r", "unit_economy", [[1, 2, 3, 4, 2, 15, 0, 10, 5], [2, 2, 3, 4, 77, 1, 1, 1, 1]])
    tables, q = scan.scan(spark, [root], aspects=["unit_economy"], on_bad_enum="null")
    rows = sorted(tables["unit_economy"].collect(), key=lambda r: r.frame)
    assert rows[0].event_type == "SNAPSHOT" and rows[0].metal_make == 1.5
    assert rows[1].event_type is None and q.count() == 0


def test_fail_policy_raises(spark, tmp_path):
    _write(str(tmp_path), "r", "map_envir_econ", [[0, 1, 1], [1, 2, 3, 4]])
    tables, _ = scan.scan(spark, [str(tmp_path)], aspects=["map_envir_econ"], on_error="fail")
    with pytest.raises(Exception, match="bad map_envir_econ record"):
        tables["map_envir_econ"].collect()


def test_manifest_and_json_lines(spark, tmp_path):
    _write(str(tmp_path), "r9", "start_pos", [[1, "ann", "cmd", 5, 1, 2, 3]])
    m = scan.manifest(spark, [str(tmp_path)]).collect()
    assert [(r.replay_id, r.aspect) for r in m] == [("r9", "start_pos")] and m[0].size_kb > 0
    jl = tmp_path / "j" / "r5"
    jl.mkdir(parents=True)
    (jl / "map_envir_econ.jsonl").write_text("[0, 1, 2]\n[30, 2]\n")
    raw = scan.positional_json(spark, str(jl / "map_envir_econ.jsonl"))
    clean, q = scan.bind(raw, "map_envir_econ")
    assert [(r.replay_id, r.frame) for r in clean.collect()] == [("r5", 0)] and q.count() == 1


def test_dims(spark, tmp_path):
    d1, d2 = tmp_path / "d1", tmp_path / "d2"
    d1.mkdir()
    d2.mkdir()
    (d2 / "defs.csv").write_text(
        'id,name,translatedTooltip,translatedHumanName\n1,armaak,"Multi\nline, tip",Archangel\n'
        "2,armaap,x,Plant\n")
    defs = dims.read_defs_csv(spark, [str(d1), str(d2)])
    assert [(r.unit_def_id, r.unit_name, r.translated_human_name) for r in defs.collect()] == [
        (1, "armaak", "Archangel"), (2, "armaap", "Plant")]
    assert dims.read_defs_csv(spark, [str(d1)]).count() == 0
    (d1 / "units.json").write_text('{"tank": {"metalcost": 100, "health": 5, "extra": 1}, "bot": {}}')
    u = {r.unit_name: r for r in dims.read_unit_defs_json(spark, str(d1 / "units.json")).collect()}
    assert u["tank"].metalcost == 100.0 and u["tank"].buildtime == 0.0 and u["bot"].health == 0.0
    (d1 / "game_meta.json").write_text('{"id": "g1", "durationMs": 5, "hostSettings": {"mapname": "M"}}')
    (g,) = dims.read_game_meta(spark, [str(d1), str(d2)]).collect()
    assert (g.game_id, g.duration_ms, g.map_name) == ("g1", 5, "M") and len(g.content) > 10
    assert dims.empty_aspect(spark, "damage_log").count() == 0


def test_qualified_roundtrip(spark, tmp_path):
    _write(str(tmp_path / "in"), "r1", "map_envir_econ", [[0, 1, 2]])
    tables, _ = scan.scan(spark, [str(tmp_path / "in")], aspects=["map_envir_econ"])
    root = str(tmp_path / "q")
    assert qualified.read_qualified(spark, root, ["map_envir_econ"]) is None
    v = qualified.write_qualified(tables, root)
    back = qualified.read_qualified(spark, root, ["map_envir_econ"], version=v)
    (r,) = back["map_envir_econ"].collect()
    assert (r.replay_id, r.frame, r.wind_strength) == ("r1", 0, 1)
    assert qualified.read_qualified(spark, root, ["map_envir_econ"], version="other") is None


def test_short_row_with_optional_tail_is_padded(spark, tmp_path):
    # unit_events: the last four fields are optional; a row without them is padded
    _write(str(tmp_path), "r", "unit_events",
           [[5, 7, 1, 2, 10, 20, 0, None, None, None, 1],
            [6, 7, 1, 2, 10, 20, 0, None, None, None, 3, 1, 2, 3, 4]])
    tables, q = scan.scan(spark, [str(tmp_path)], aspects=["unit_events"])
    rows = {r.frame: r for r in tables["unit_events"].collect()}
    assert q.count() == 0
    assert rows[5].event_type == "CREATED" and rows[5].factory_queue_len is None
    assert rows[6].event_type == "DESTROYED" and rows[6].factory_queue_len == 4
