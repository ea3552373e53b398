"""Documented analysis recipes as DataFrame plans.

Joins that would pair duplicate rows on both sides (several positions of a
unit in one frame, several snapshots of a team in one frame) first reduce
the right side to one row per key, so every join here is n:1 -- a hot key
cannot multiply into all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_BUCKET_FRAMES
from ..functions import code_to_name
from ..operators import asof_join

R = "replay_id"


# RC-1
def units_lost_per_player(tables) -> DataFrame:
    return tables["unit_events"].filter(F.col("event_type") == "DESTROYED").groupBy(
        R, F.col("unit_team_id").alias("player_id")).agg(F.count(F.lit(1)).alias("units_lost"))


# RC-2
def unified_event_log(tables) -> DataFrame:
    """Unit creations and commands in one schema (missing columns null);
    ordered by (frame, row_ord) at the sink."""
    parts = []
    ue = tables.get("unit_events")
    if ue is not None:
        parts.append(ue.filter(F.col("event_type") == "CREATED").select(
            R, "frame", "unit_id", F.col("unit_team_id").alias("team_id"),
            F.lit("UnitCreated").alias("event_type"),
            F.col("unit_def_id").cast("string").alias("details"), "row_ord"))
    cl = tables.get("commands_log")
    if cl is not None:
        parts.append(cl.select(
            R, "frame", F.col("unitId").alias("unit_id"), F.col("teamId").alias("team_id"),
            F.lit("UnitCommand").alias("event_type"), F.col("cmd_name").alias("details"),
            "row_ord", F.col("cmd_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# RC-3
def unit_lifetime(tables) -> DataFrame:
    """A unit's positional span next to its lifecycle events.  Both sides are
    reduced to one row per unit, then full-outer joined so a unit known from
    only one source is still reported."""
    pos = tables["unit_positions"].groupBy(R, "unit_id").agg(
        F.min("frame").alias("first_seen_frame"), F.max("frame").alias("last_seen_frame"),
        F.count(F.lit(1)).alias("positions"))
    ev = tables["unit_events"].groupBy(R, "unit_id").agg(
        F.min(F.when(F.col("event_type") == "CREATED", F.col("frame"))).alias("created_frame"),
        F.min(F.when(F.col("event_type") == "DESTROYED", F.col("frame"))).alias("destroyed_frame"))
    return pos.join(ev, [R, "unit_id"], "full").na.fill({"positions": 0})


# RC-4
def damage_location(tables) -> DataFrame:
    """Each damage event with the victim's position at that frame (the last
    position record of the unit in the frame)."""
    pos = tables["unit_positions"].groupBy(R, F.col("unit_id").alias("victim_unit_id"), "frame").agg(
        F.max_by(F.struct("x", "y", "z"), "row_ord").alias("p"))
    d = tables["damage_log"].select(R, "frame", "victim_unit_id", "damage", "row_ord")
    return d.join(pos, [R, "victim_unit_id", "frame"], "left").select(
        R, "frame", "victim_unit_id", "damage", "row_ord",
        F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.z").alias("z"))


# RC-5
def commands_with_team_state(tables) -> DataFrame:
    """Commands next to the issuing team's snapshot at the same frame."""
    ts = tables["team_stats"].groupBy(R, F.col("team_id").alias("teamId"), "frame").agg(
        F.max_by(F.struct("metal_current", "energy_current", "metal_income", "energy_income"),
                 "row_ord").alias("s"))
    c = tables["commands_log"].select(R, "frame", "teamId", "unitId", "cmd_name", "row_ord")
    return c.join(ts, [R, "teamId", "frame"], "left").select(
        R, "frame", "teamId", "unitId", "cmd_name", "row_ord",
        *[F.col(f"s.{k}").alias(k) for k in
          ("metal_current", "energy_current", "metal_income", "energy_income")])


# RC-6
def damage_with_attacker_type(tables) -> DataFrame:
    """Damage rows with the attacking unit's definition (left join: damage
    from non-unit sources keeps a null type)."""
    types = tables["unit_events"].groupBy(R, F.col("unit_id").alias("attacker_unit_id")).agg(
        F.min_by("unit_def_id", "row_ord").alias("attacker_type_def_id"))
    d = tables["damage_log"].select(R, "frame", "row_ord", "attacker_unit_id", "damage")
    return d.join(types, [R, "attacker_unit_id"], "left")


# RC-7
def commands_named(tables, name: str = "MOVE") -> DataFrame:
    return tables["commands_log"].filter(F.col("cmd_name") == name)


# RC-8
def resources_at_death(tables, width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Last known team resources when each unit died (backward as-of on the
    team's snapshots, inclusive)."""
    deaths = tables["unit_events"].filter(F.col("event_type") == "DESTROYED").select(
        R, "unit_id", F.col("unit_team_id").alias("team_id"), F.col("frame").alias("death_frame"))
    ts = tables["team_stats"].select(
        R, "team_id", F.col("frame").alias("snapshot_frame"), "row_ord",
        "metal_current", "energy_current")
    return asof_join(deaths, ts, [R, "team_id"], "death_frame", "snapshot_frame",
                     ["snapshot_frame", "metal_current", "energy_current"],
                     direction="backward", right_order="row_ord", width=width)


# RC-9
def command_codes_with_unknown(tables, code_col: str = "cmd_id") -> DataFrame:
    """Decode raw command codes, grouping codes outside the enum into "unknown"."""
    c = tables["commands_log"]
    name = F.coalesce(code_to_name(F.col(code_col), "CommandsEnum"), F.lit("unknown"))
    return c.groupBy(R, name.alias("command")).agg(F.count(F.lit(1)).alias("commands"))
