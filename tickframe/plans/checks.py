"""Data-quality checks (documented guarantees) as one violations report.

Every check is an aggregate per (replay, aspect); the report holds one row
per replay, aspect and check with the number of violating rows, so a clean
corpus yields zeros and a broken replay is easy to find.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import BUCKET, with_bucket
from ..schemas import ASPECTS

R = "replay_id"
#: Rows of a file that are put in order at a time.  ``row_ord`` counts a file's rows, so a
#: range of it is bounded and needs no count of its rows beforehand.
ORDERED_ROWS = 1 << 18


def _report(df: DataFrame, aspect: str, check: str, violations) -> DataFrame:
    return df.groupBy(R).agg(violations.cast("long").alias("violations")).select(
        R, F.lit(aspect).alias("aspect"), F.lit(check).alias("check"), "violations")


def duplicate_start_positions(tables) -> DataFrame:  # DQ-2
    per_player = tables["start_pos"].groupBy(R, "player_id").agg(F.count(F.lit(1)).alias("n"))
    return _report(per_player, "start_pos", "player_not_unique", F.count_if(F.col("n") > 1))


def _null_in_required(df: DataFrame, aspect: str):
    cols = [f.name for f in ASPECTS[aspect] if not f.nullable and f.name in df.columns]
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def aspect_checks(tables, aspect: str, width: int = ORDERED_ROWS) -> DataFrame:
    """DQ-3 and DQ-4 (and DQ-1 for the damage log) from one pass over the aspect.

    Negative frames, frames that decrease in file (row_ord) order, and rows
    without a required value.  Ranges of ``row_ord`` are counted on their own;
    the step from a range to the next compares their facing rows.
    """
    df = tables[aspect]
    marks = {"required_null": _null_in_required(df, aspect), "frame_negative": F.col("frame") < 0}
    if aspect == "damage_log":
        marks["damage_negative"] = F.col("damage") < 0
    d = df.select(R, "frame", "row_ord", *[m.alias(f"__{c}") for c, m in marks.items()])
    d = with_bucket(d, "row_ord", width)
    before = F.lag("frame").over(Window.partitionBy(R, BUCKET).orderBy("row_ord", "frame"))
    d = d.withColumn("__frame_decreasing", F.col("frame") < before)
    checks = [*marks, "frame_decreasing"]
    row = F.struct("row_ord", "frame")
    ranges = d.groupBy(R, BUCKET).agg(
        *[F.count_if(F.col(f"__{c}")).alias(f"__{c}") for c in checks],
        F.min(row).alias("__low"), F.max(row).alias("__high"))
    before = F.lag("__high").over(Window.partitionBy(R).orderBy(BUCKET))
    ranges = ranges.withColumn("__step", (F.col("__low.frame") < before["frame"]).cast("long"))
    found = [(c, F.sum(f"__{c}")) for c in marks]
    found.append(("frame_decreasing",
                  F.sum(F.col("__frame_decreasing") + F.coalesce("__step", F.lit(0)))))
    counts = ranges.groupBy(R).agg(F.array(*[
        F.struct(F.lit(c).alias("check"), n.alias("violations")) for c, n in found]).alias("all"))
    return counts.select(R, F.lit(aspect).alias("aspect"), F.explode("all").alias("one")).select(
        R, "aspect", "one.check", "one.violations")


FRAMED = ("damage_log", "commands_log", "unit_positions", "unit_events", "unit_economy",
          "team_stats", "map_envir_econ", "unit_state_snapshots", "construction_log")


def quality_report(tables, aspects=FRAMED) -> DataFrame:
    parts = [aspect_checks(tables, a) for a in aspects if a in tables]
    if "start_pos" in tables:
        parts.append(duplicate_start_positions(tables))
    return reduce(DataFrame.unionByName, parts)
