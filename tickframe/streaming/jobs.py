"""Streaming jobs over aspect tables arriving as files.

Replays arrive in any order and all start at frame 0, so no clock is shared by
two of them and no watermark fits: it would call every replay but the furthest
late.  Each job therefore sums what a micro-batch holds into additive partial
rows.  Nothing is ever late while its replay is open, and no state grows in
memory.

The partial rows are kept like this, so that reading a result does not sum the
whole history again:

* every micro-batch writes a run of partial rows; ``FAN_IN`` runs of one level are
  merged into one of the next, so there are few runs, and rows with equal keys
  are summed along the way;
* when a replay has ended (``ended``, or ``close_replays``), its rows are summed
  into the final result once, and merges drop them from then on;
* a result is the final rows, read as they are, and the runs of open replays.

What a batch wrote counts from the moment its state file is there; a batch that
is run again overwrites its own folders and starts from the state before it.
Rows that arrive for an ended replay are kept apart (``late_rows``).

* SS-1 ``MINUTE_ACTIVITY``: actions and combat/economy share per player and
  minute (the streaming form of the APM stat).
* SS-2 ``unit_engagements(lull_seconds)``: gap sessions per attacker unit.
  Partial rows are hits and damage per frame; sessions are numbered on reading,
  with the batch rule "split when gap > lull", and the last one is closed too.
* SS-3 ``binned_production(bin_seconds)``: unit creations per bin, team and
  unit definition.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FRAME_RATE
from ..enums import COMBAT_COMMANDS, ECONOMY_COMMANDS
from ..functions.frames import bin_start, minute_of
from ..operators import gap_sessionize
from ..scratch import drop, names, read_text, write_text
from ..session import ensure_checkpoint_dir

#: Runs of one level that are merged into one.
FAN_IN = 8


@dataclass(frozen=True)
class StreamJob:
    """``partial`` sums one micro-batch; ``final`` makes the result of partial rows.

    Partial rows add up: equal ``keys``, sums of all other columns.
    """

    name: str
    partial: Callable[[DataFrame], DataFrame]
    final: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]

    def merge(self, partials: DataFrame) -> DataFrame:
        sums = [c for c in partials.columns if c not in self.keys]
        return partials.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in sums])


def _activity(batch: DataFrame) -> DataFrame:
    return batch.groupBy("replay_id", F.col("teamId").alias("player_id"),
                         minute_of("frame").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("cmd_name").isin(COMBAT_COMMANDS)).alias("combat"),
        F.count_if(F.col("cmd_name").isin(ECONOMY_COMMANDS)).alias("economy"))


def _activity_total(partial: DataFrame) -> DataFrame:
    n = F.sum("n")
    return partial.groupBy("replay_id", "player_id", "minute").agg(
        n.alias("actions_per_minute"),
        (F.sum("combat") / n * 100).alias("combat_focus_pct"),
        (F.sum("economy") / n * 100).alias("economy_focus_pct"))


MINUTE_ACTIVITY = StreamJob("minute_activity", _activity, _activity_total,
                            ("replay_id", "player_id", "minute"))


def unit_engagements(lull_seconds: float = 15.0) -> StreamJob:
    key = ["replay_id", "attacker_unit_id"]
    lull = lull_seconds * FRAME_RATE

    def partial(batch: DataFrame) -> DataFrame:
        hits = batch.filter(F.col("attacker_unit_id").isNotNull())
        return hits.groupBy(*key, "frame").agg(F.sum("damage").alias("damage"),
                                               F.count(F.lit(1)).alias("hits"))

    def final(partials: DataFrame) -> DataFrame:
        frames = partials.groupBy(*key, "frame").agg(F.sum("damage").alias("damage"),
                                                     F.sum("hits").alias("hits"))
        d = gap_sessionize(frames, key, ["frame"], ["frame"],
                           lambda prev, cur: cur["frame"] - prev["frame"] > lull)
        return d.groupBy(*key, "session_id").agg(
            F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"),
            F.sum("damage").alias("total_damage"), F.sum("hits").alias("hits")).select(
            *key, "start_frame", "end_frame", "total_damage", "hits",
            ((F.col("end_frame") - F.col("start_frame")) / F.lit(float(FRAME_RATE)))
            .alias("duration_seconds"))

    return StreamJob("unit_engagements", partial, final, (*key, "frame"))


def binned_production(bin_seconds: int = 10) -> StreamJob:
    key = ["replay_id", "team_id", "unit_def_id", "time_bin_start_frame"]

    def partial(batch: DataFrame) -> DataFrame:
        made = batch.filter(F.col("event_type") == "CREATED").withColumnRenamed(
            "unit_team_id", "team_id")
        return made.withColumn("time_bin_start_frame", bin_start(
            "frame", bin_seconds * FRAME_RATE)).groupBy(*key).agg(
            F.count(F.lit(1)).alias("units_produced_in_bin"))

    def final(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*key).agg(
            F.sum("units_produced_in_bin").alias("units_produced_in_bin"))

    return StreamJob("binned_production", partial, final, tuple(key))


def read_aspect_stream(spark: SparkSession, path: str, schema,
                       max_files: int | None = None) -> DataFrame:
    """Aspect rows arriving as Parquet files under ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


# --------------------------------------------------------------------------- state
@dataclass
class _State:
    """The tables that count after a batch: runs of partial rows by level, and results."""

    batch: int = -1
    runs: list[tuple[int, str]] = field(default_factory=list)       # (level, folder)
    finals: list[str] = field(default_factory=list)
    ended: list[str] = field(default_factory=list)
    late: list[str] = field(default_factory=list)

    @property
    def folders(self) -> set[str]:
        return {f for _, f in self.runs} | set(self.finals) | set(self.ended) | set(self.late)


def _states(spark: SparkSession, sink: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names(spark, f"{sink}/state")
                  if n.endswith(".json"))


def _load(spark: SparkSession, sink: str, before: int | None = None) -> _State:
    """The newest state, or the newest one of a batch before ``before``."""
    known = [b for b in _states(spark, sink) if before is None or b < before]
    if not known:
        return _State()
    doc = json.loads(read_text(spark, f"{sink}/state/{known[-1]}.json"))
    return _State(doc["batch"], [tuple(r) for r in doc["runs"]], doc["finals"], doc["ended"],
                  doc["late"])


def _commit(spark: SparkSession, sink: str, state: _State) -> None:
    """Make ``state`` the one that counts; folders that only older states than its
    predecessor name are removed."""
    write_text(spark, f"{sink}/state/{state.batch}.json", json.dumps(state.__dict__))
    old = _states(spark, sink)[:-2]
    if not old:
        return
    keep = _load(spark, sink).folders | _load(spark, sink, before=state.batch).folders
    for batch in old:
        for folder in _load(spark, sink, before=batch + 1).folders - keep:
            drop(spark, f"{sink}/{folder}")
        drop(spark, f"{sink}/state/{batch}.json")


def _read(spark: SparkSession, sink: str, folders: list[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{sink}/{f}" for f in folders]) if folders else None


def _open_rows(spark: SparkSession, sink: str, state: _State, folders: list[str]) -> DataFrame:
    """Partial rows of replays that have not ended."""
    rows, ended = _read(spark, sink, folders), _read(spark, sink, state.ended)
    return rows if ended is None else rows.join(ended, "replay_id", "left_anti")


def _absorb(job: StreamJob, partial: DataFrame, sink: str, state: _State, batch: int) -> None:
    """Add a batch's partial rows to ``state``."""
    spark = partial.sparkSession
    ended = _read(spark, sink, state.ended)
    if ended is not None:
        late = partial.join(ended, "replay_id", "left_semi")
        late.write.mode("overwrite").parquet(f"{sink}/late/{batch}")
        if not spark.read.parquet(f"{sink}/late/{batch}").isEmpty():
            state.late.append(f"late/{batch}")
        partial = partial.join(ended, "replay_id", "left_anti")
    run = f"runs/{batch}-0"
    partial.write.mode("overwrite").parquet(f"{sink}/{run}")
    state.runs.append((0, run))
    level = 0
    while len(full := [f for n, f in state.runs if n == level]) >= FAN_IN:
        run = f"runs/{batch}-{level + 1}"
        job.merge(_open_rows(spark, sink, state, full)).write.mode("overwrite").parquet(
            f"{sink}/{run}")
        state.runs = [r for r in state.runs if r[0] != level] + [(level + 1, run)]
        level += 1


def _close(job: StreamJob, spark: SparkSession, sink: str, state: _State, replays: DataFrame,
           name: str) -> None:
    """Sum up the replays that have ended and were not summed up before."""
    new = replays.select("replay_id").where("replay_id IS NOT NULL").distinct()
    before = _read(spark, sink, state.ended)
    if before is not None:
        new = new.join(before, "replay_id", "left_anti")
    new.write.mode("overwrite").parquet(f"{sink}/ended/{name}")
    new = spark.read.parquet(f"{sink}/ended/{name}")
    rows = _read(spark, sink, [f for _, f in state.runs])
    if rows is None or new.isEmpty():
        return
    job.final(job.merge(rows.join(new, "replay_id", "left_semi"))).write.mode(
        "overwrite").parquet(f"{sink}/final/{name}")
    state.finals.append(f"final/{name}")
    state.ended.append(f"ended/{name}")


def start(job: StreamJob, source: DataFrame, sink_path: str, name: str | None = None,
          available_now: bool = False, checkpoint: str | None = None,
          ended: Callable[[SparkSession], DataFrame] | None = None):
    """Start ``job`` on a streaming ``source``; its tables go to ``sink_path``.

    ``ended`` returns the replays (replay_id) that get no more rows; it is asked
    in every micro-batch.  The checkpoint goes to
    ``<spark.checkpoint.dir>/streams/<name>`` unless given.
    """
    name, sink = name or job.name, sink_path.rstrip("/")
    root = checkpoint or (f"{ensure_checkpoint_dir(source.sparkSession).rstrip('/')}"
                          f"/streams/{name}")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # every batch has an even place of its own; what is closed between batches an odd one
        place = 2 * batch_id
        state = _load(spark, sink, before=place)
        _absorb(job, job.partial(batch), sink, state, place)
        if ended is not None:
            _close(job, spark, sink, state, ended(spark), str(place))
        state.batch = place
        _commit(spark, sink, state)

    w = (source.writeStream.queryName(name).option("checkpointLocation", root)
         .foreachBatch(write_batch))
    return (w.trigger(availableNow=True) if available_now else w).start()


def close_replays(job: StreamJob, spark: SparkSession, sink_path: str, replays: DataFrame) -> None:
    """Sum up replays (replay_id) that have ended, while the stream is not running."""
    sink = sink_path.rstrip("/")
    state = _load(spark, sink)
    place = state.batch + 1 if state.batch % 2 == 0 else state.batch
    _close(job, spark, sink, state, replays, f"{place}-{len(state.ended)}")
    state.batch = place
    _commit(spark, sink, state)


def result(job: StreamJob, spark: SparkSession, sink_path: str) -> DataFrame:
    """What a job has counted so far: finished replays as they are, open ones summed."""
    sink = sink_path.rstrip("/")
    state = _load(spark, sink)
    final = _read(spark, sink, state.finals)
    if not state.runs:
        return final
    still = job.final(job.merge(_open_rows(spark, sink, state, [f for _, f in state.runs])))
    return still if final is None else final.unionByName(still)


def late_rows(spark: SparkSession, sink_path: str) -> DataFrame | None:
    """Partial rows that came after their replay had ended; ``None`` if there are none."""
    sink = sink_path.rstrip("/")
    return _read(spark, sink, _load(spark, sink).late)
