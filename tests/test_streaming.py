"""Streaming jobs equal their batch counterparts, in whatever order replays arrive."""

import random

from tests.conftest import make
from tickframe.plans import stats as S
from tickframe.streaming import jobs

CMD = "replay_id long, frame long, teamId long, cmd_name string, row_ord long"
DMG = ("replay_id long, frame long, attacker_unit_id long, attacker_team_id long, damage double, "
       "victim_pos_x long, victim_pos_y long, row_ord long")


def _run(spark, frames, job, tmp_path):
    """One availableNow run for each frame of new files, on one checkpoint."""
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    for df in frames:
        df.write.mode("append").parquet(src)
        q = jobs.start(job, jobs.read_aspect_stream(spark, src, df.schema), out,
                       available_now=True, checkpoint=ckpt)
        q.awaitTermination(120)
    return jobs.result(job, spark, out)


def test_minute_activity_matches_batch(spark, tmp_path):
    rows = [(0, f, t, n, i) for i, (f, t, n) in enumerate(
        [(10, 1, "ATTACK"), (20, 1, "BUILD"), (1799, 1, "MOVE"), (1800, 1, None), (40, 2, "FIGHT")])]
    df = make(spark, rows, CMD)
    got = _run(spark, [df], jobs.MINUTE_ACTIVITY, tmp_path)
    batch = S.calculate_player_apm_and_focus({"commands_log": df})
    key = ["replay_id", "player_id", "minute", "actions_per_minute", "combat_focus_pct",
           "economy_focus_pct"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == sorted(
        tuple(r) for r in batch.select(*key).collect())


def test_no_replay_is_late(spark, tmp_path):
    # three replays on the same clock in three runs, the last one split over two
    minutes = range(30)
    frames = [make(spark, [(r, m * 1800, 1, "MOVE", m) for m in part], CMD)
              for r, part in ((0, minutes), (1, minutes), (2, minutes[:10]), (2, minutes[5:]))]
    got = _run(spark, frames, jobs.MINUTE_ACTIVITY, tmp_path).collect()
    assert len(got) == 90
    assert sum(r.actions_per_minute for r in got) == 95


def test_unit_sessions_gap_rule(spark, tmp_path):
    # lull 10 s = 300 frames: 0,100,400 (gap exactly 300 stays) | 701; one hit arrives last
    early = make(spark, [(0, f, 7, 1, 1.0, 0, 0, i) for i, f in enumerate([0, 400, 701])], DMG)
    late = make(spark, [(0, 100, 7, 1, 1.0, 0, 0, 3), (1, 5, 7, 1, 2.0, 0, 0, 4)], DMG)
    got = _run(spark, [early, late], jobs.unit_engagements(10.0), tmp_path).collect()
    assert sorted((r.replay_id, r.start_frame, r.end_frame, r.hits) for r in got) == [
        (0, 0, 400, 3), (0, 701, 701, 1), (1, 5, 5, 1)]


def test_binned_production(spark, tmp_path):
    ue = make(spark, [(0, 0, 1, 5, 2, "CREATED", 0), (0, 299, 2, 5, 2, "CREATED", 1),
                      (0, 300, 3, 5, 2, "CREATED", 2), (0, 310, 3, 5, 2, "FINISHED", 3)],
              "replay_id long, frame long, unit_id long, unit_def_id long, unit_team_id long, "
              "event_type string, row_ord long")
    got = _run(spark, [ue], jobs.binned_production(), tmp_path)
    assert sorted((r.time_bin_start_frame, r.units_produced_in_bin) for r in got.collect()) == [
        (0, 2), (300, 1)]


def _engagements(spark, job, out):
    return sorted(map(repr, jobs.result(job, spark, out).select(
        "replay_id", "attacker_unit_id", "start_frame", "end_frame", "total_damage",
        "hits").collect()))


def _batch_engagements(spark, job, df):
    return sorted(map(repr, job.final(job.partial(df)).select(
        "replay_id", "attacker_unit_id", "start_frame", "end_frame", "total_damage",
        "hits").collect()))


def _hits(spark, seed, n, replays=(0, 1, 2)):
    draw = random.Random(seed)
    return make(spark, [(draw.choice(replays), draw.randrange(20_000), draw.randrange(3), 1, 1.0,
                         0, 0, i) for i in range(n)], DMG)


def test_many_batches_are_merged_into_few_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "FAN_IN", 3)
    job, out = jobs.unit_engagements(10.0), str(tmp_path / "out")
    frames = [_hits(spark, i, 40) for i in range(13)]
    _run(spark, frames, job, tmp_path)
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    assert _engagements(spark, job, out) == _batch_engagements(spark, job, whole)
    state = jobs._load(spark, out)
    # 13 batches: one run of 9, one of 3, one of 1
    assert sorted(level for level, _ in state.runs) == [0, 1, 2]
    merged = spark.read.parquet(f"{out}/{state.runs[0][1]}")
    assert merged.count() == merged.select(*job.keys).distinct().count()
    assert len(list((tmp_path / "out" / "state").glob("*.json"))) == 2      # older states go
    assert len(list((tmp_path / "out" / "runs").iterdir())) < 13


def test_ended_replays_are_summed_once(spark, tmp_path):
    job, out = jobs.unit_engagements(10.0), str(tmp_path / "out")
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    frames = [_hits(spark, 1, 60, (0, 1)), _hits(spark, 2, 60, (1, 2)), _hits(spark, 3, 60, (2,))]
    over = [[], [(0,)], [(0,), (1,)]]
    for df, ended in zip(frames, over, strict=True):
        df.write.mode("append").parquet(src)
        q = jobs.start(job, jobs.read_aspect_stream(spark, src, df.schema), out,
                       available_now=True, checkpoint=ckpt,
                       ended=lambda s, e=ended: s.createDataFrame(e, "replay_id long"))
        q.awaitTermination(120)
        assert q.exception() is None
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert _engagements(spark, job, out) == _batch_engagements(spark, job, whole)
    state = jobs._load(spark, out)
    assert len(state.finals) == 2
    finals = spark.read.parquet(*[f"{out}/{f}" for f in state.finals])
    assert {r[0] for r in finals.select("replay_id").distinct().collect()} == {0, 1}
    # reading does not sum the ended replays again
    open_rows = jobs._open_rows(spark, out, state, [f for _, f in state.runs])
    assert {r[0] for r in open_rows.select("replay_id").distinct().collect()} == {2}
    jobs.close_replays(job, spark, out, spark.createDataFrame([(2,), (0,)], "replay_id long"))
    assert _engagements(spark, job, out) == _batch_engagements(spark, job, whole)
    # rows after the end are kept apart
    _hits(spark, 4, 5, (0,)).write.mode("append").parquet(src)
    q = jobs.start(job, jobs.read_aspect_stream(spark, src, frames[0].schema), out,
                   available_now=True, checkpoint=ckpt)
    q.awaitTermination(120)
    assert _engagements(spark, job, out) == _batch_engagements(spark, job, whole)
    assert jobs.late_rows(spark, out).agg({"hits": "sum"}).first()[0] == 5


def test_a_batch_that_runs_again_counts_once(spark, tmp_path, monkeypatch):
    job, out = jobs.MINUTE_ACTIVITY, str(tmp_path / "out")
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    df = make(spark, [(0, 10, 1, "MOVE", 0), (0, 20, 1, "ATTACK", 1)], CMD)
    df.write.parquet(src)
    real = jobs._commit

    def killed(*a):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs, "_commit", killed)
    q = jobs.start(job, jobs.read_aspect_stream(spark, src, df.schema), out, available_now=True,
                   checkpoint=ckpt)
    try:
        q.awaitTermination(120)
    except Exception:  # noqa: BLE001
        pass
    monkeypatch.setattr(jobs, "_commit", real)
    q = jobs.start(job, jobs.read_aspect_stream(spark, src, df.schema), out, available_now=True,
                   checkpoint=ckpt)
    q.awaitTermination(120)
    assert [r["actions_per_minute"] for r in jobs.result(job, spark, out).collect()] == [2]
