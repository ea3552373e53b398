"""Adapters: the driver's TPC-H-ish tables projected into aspect shapes.

These are pure projections (plus one per-order aggregate for unit deaths), so
Catalyst prunes columns and pushes filters into the parquet scans.  Every
aspect gets ``replay_id`` and a file-order ``row_ord`` tie-breaker.

Clocks:
* event clock  ``frame = (micros(ts) - micros(2024-01-01)) div 2e6``
* day clock    ``frame = 30 * days(date - 1995-01-01)``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

USERS_PER_REPLAY = 15
EVENT_EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
DAY_EPOCH = "1995-01-01"

# Command names per driver event type (fixed adapter rule).
EVENT_COMMANDS = {
    "click": "MOVE",
    "view": "GUARD",
    "purchase": "BUILD",
    "signup": "REPAIR",
    "error": "ATTACK",
}

# team_stats resource columns derived from o_totalprice: column -> divisor.
TEAM_PRICE_DIVISORS = {
    "metal_used": 200.0, "metal_produced": 100.0, "metal_excess": 1000.0,
    "energy_used": 20.0, "energy_produced": 10.0, "energy_excess": 500.0,
    "damage_dealt": 50.0, "damage_received": 70.0,
    "metal_current": 300.0, "metal_storage": 150.0, "metal_pull": 400.0,
    "metal_income": 250.0, "metal_expense": 350.0, "metal_share": 1000.0,
    "metal_Rsent": 900.0, "metal_Rreceived": 800.0, "metal_Rexcess": 700.0,
    "energy_current": 30.0, "energy_storage": 15.0, "energy_pull": 40.0,
    "energy_income": 25.0, "energy_expense": 35.0, "energy_share": 100.0,
    "energy_Rsent": 90.0, "energy_Rreceived": 80.0, "energy_Rexcess": 70.0,
}
# team_stats columns derived from o_orderkey: column -> (modulus, factor).
TEAM_KEY_RULES = {
    "metal_received": (7, 10.0), "metal_sent": (5, 10.0),
    "energy_received": (11, 25.0), "energy_sent": (13, 25.0),
    "units_killed": (3, 1), "units_died": (4, 1), "units_captured": (2, 0),
    "units_out_captured": (2, 0), "units_received": (2, 0), "units_sent": (2, 0),
    "current_unit_count": (50, 1),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_frame(ts: str = "ts") -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EVENT_EPOCH}, {ts}) div 2000000")


def day_frame(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.datediff(F.to_date(c), F.lit(DAY_EPOCH).cast("date")) * 30).cast("long")


#: Unit ids of orders start here, above those of commanders.
ORDER_UNITS = 10_000_000


def _replay_of(key: str) -> Column:
    return F.expr(f"{key} div {USERS_PER_REPLAY}")


def _pos_x() -> Column:
    return (F.col("event_id") * 37) % 2000


def _pos_y() -> Column:
    return (F.col("event_id") * 91) % 2000


def damage_log(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    no_attacker = (F.col("event_id") % 10) == 0

    def attacker(expr: Column) -> Column:
        return F.when(no_attacker, F.lit(None).cast("long")).otherwise(expr)

    return e.select(
        _replay_of("user_id").alias("replay_id"),
        event_frame().alias("frame"),
        (F.col("user_id") % 16).alias("victim_team_id"),
        attacker(F.col("user_id") % 5).alias("attacker_team_id"),
        F.col("user_id").alias("victim_unit_id"),
        (F.col("user_id") % 40).alias("victim_def_id"),
        attacker(_replay_of("user_id") * USERS_PER_REPLAY
                 + (F.col("user_id") * 7 + 3) % USERS_PER_REPLAY).alias("attacker_unit_id"),
        attacker(F.col("user_id") % 25).alias("attacker_def_id"),
        (F.col("event_id") % 11).alias("weapon_def_id"),
        F.col("event_id").alias("projectile_id"),
        F.col("value").alias("damage"),
        (F.col("event_type") == "error").alias("is_paralyzer"),
        _pos_x().alias("victim_pos_x"),
        _pos_y().alias("victim_pos_y"),
        F.lit(0).cast("long").alias("victim_pos_z"),
        F.col("event_id").alias("row_ord"),
    )


def commands_log(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    name = F.lit(None).cast("string")
    for ev, cmd in EVENT_COMMANDS.items():
        name = F.when(F.col("event_type") == ev, F.lit(cmd)).otherwise(name)
    return e.select(
        _replay_of("user_id").alias("replay_id"),
        event_frame().alias("frame"),
        (F.col("user_id") % 16).alias("teamId"),
        F.col("user_id").alias("unitId"),
        (F.col("event_id") % 1000).alias("cmd_id"),
        name.alias("cmd_name"),
        F.lit(0).cast("long").alias("cmd_tag"),
        F.lit(None).cast("long").alias("target_unit_id"),
        _pos_x().alias("x"),
        _pos_y().alias("y"),
        F.lit(0).cast("long").alias("z"),
        F.col("event_id").alias("row_ord"),
    )


def unit_positions(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        _replay_of("user_id").alias("replay_id"),
        event_frame().alias("frame"),
        F.col("user_id").alias("unit_id"),
        (F.col("user_id") % 25).alias("unit_def_id"),
        (F.col("user_id") % 16).alias("team_id"),
        _pos_x().alias("x"),
        _pos_y().alias("y"),
        F.lit(0).cast("long").alias("z"),
        F.lit(0.0).alias("vx"),
        F.lit(0.0).alias("vy"),
        F.lit(0.0).alias("vz"),
        F.lit(0).cast("long").alias("heading"),
        F.col("event_id").alias("row_ord"),
    )


def unit_events(spark, sf_dir) -> DataFrame:
    """Units of orders and of customers.

    Orders: CREATED and FINISHED at the order date; DESTROYED for finished
    orders with lines, at greatest(last ship date, order date + 1 day).

    Customers are the commanders that the event tables' units are: three in four
    have lifecycle rows.  They are built at frame 0, every fifth is FINISHED
    twice, and of those with events every third is DESTROYED 300 frames after
    its last one."""
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    last_ship = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    born = day_frame("o_orderdate")
    base = o.select(
        _replay_of("o_custkey").alias("replay_id"),
        (F.col("o_orderkey") + ORDER_UNITS).alias("unit_id"),
        (F.col("o_custkey") % 200).alias("unit_def_id"),
        (F.col("o_custkey") % 16).alias("unit_team_id"),
        born.alias("born"),
        F.col("o_orderstatus"),
    )
    commanders = _table(spark, sf_dir, "customer").where("c_custkey % 4 <> 3").select(
        _replay_of("c_custkey").alias("replay_id"),
        F.col("c_custkey").alias("unit_id"),
        (F.col("c_custkey") % 200).alias("unit_def_id"),
        (F.col("c_custkey") % 16).alias("unit_team_id"),
        F.lit(0).cast("long").alias("born"),
        F.lit("C").alias("o_orderstatus"),
    )
    last_event = (_table(spark, sf_dir, "events").groupBy("user_id")
                  .agg(F.max(event_frame()).alias("last_frame")))
    base = base.unionByName(commanders)
    created = base.select("*", F.lit("CREATED").alias("event_type"),
                          F.col("born").alias("frame"), F.lit(1).alias("code"))
    finished = base.select("*", F.lit("FINISHED").alias("event_type"),
                           F.col("born").alias("frame"), F.lit(2).alias("code"))
    dead = (
        base.filter(F.col("o_orderstatus") == "F")
        .join(last_ship, base.unit_id == last_ship.l_orderkey + ORDER_UNITS, "inner")
        .select(
            *[base[c] for c in base.columns],
            F.lit("DESTROYED").alias("event_type"),
            F.greatest(day_frame("last_ship"), F.col("born") + 30).alias("frame"),
            F.lit(3).alias("code"),
        )
    )
    fallen = (
        commanders.where("unit_id % 3 = 0")
        .join(last_event, F.col("unit_id") == F.col("user_id"))
        .select(*commanders.columns, F.lit("DESTROYED").alias("event_type"),
                (F.col("last_frame") + 300).alias("frame"), F.lit(3).alias("code"))
    )
    again = commanders.where("unit_id % 5 = 0").select(
        "*", F.lit("FINISHED").alias("event_type"), F.lit(600).cast("long").alias("frame"),
        F.lit(4).alias("code"))
    nul = F.lit(None).cast("long")
    return created.unionByName(finished).unionByName(dead).unionByName(fallen).unionByName(
        again).select(
        "replay_id",
        F.col("frame").cast("long").alias("frame"),
        "unit_id", "unit_def_id", "unit_team_id",
        F.lit(0).cast("long").alias("x"),
        F.lit(0).cast("long").alias("y"),
        F.lit(0).cast("long").alias("z"),
        nul.alias("attacker_unit_id"), nul.alias("attacker_unit_def_id"),
        nul.alias("attacker_team_id"),
        "event_type",
        nul.alias("old_team_id"), nul.alias("new_team_id"),
        nul.alias("builder_id"), nul.alias("factory_queue_len"),
        (F.col("unit_id") * 4 + F.col("code")).alias("row_ord"),
    )


def unit_economy(spark, sf_dir) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        _replay_of("l_suppkey").alias("replay_id"),
        day_frame("l_shipdate").alias("frame"),
        F.col("l_partkey").alias("unit_id"),
        (F.col("l_partkey") % 25).alias("unit_def_id"),
        (F.col("l_suppkey") % 16).alias("team_id"),
        F.lit("SNAPSHOT").alias("event_type"),
        F.col("l_quantity").alias("metal_make"),
        (F.col("l_quantity") * F.col("l_discount")).alias("metal_use"),
        (F.col("l_tax") * 100).alias("energy_make"),
        (F.col("l_discount") * 100).alias("energy_use"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_ord"),
    )


def team_stats(spark, sf_dir) -> DataFrame:
    from ..schemas import ASPECTS

    o = _table(spark, sf_dir, "orders")
    cols = {}
    for f in ASPECTS["team_stats"][2:]:
        if f.name in TEAM_PRICE_DIVISORS:
            cols[f.name] = F.col("o_totalprice") / TEAM_PRICE_DIVISORS[f.name]
        else:
            mod, factor = TEAM_KEY_RULES[f.name]
            c = (F.col("o_orderkey") % mod) * factor
            cols[f.name] = c.cast("double") if f.divisor else c.cast("long")
    return o.select(
        _replay_of("o_custkey").alias("replay_id"),
        day_frame("o_orderdate").alias("frame"),
        (F.col("o_custkey") % 16).alias("team_id"),
        *[c.alias(n) for n, c in cols.items()],
        F.col("o_orderkey").alias("row_ord"),
    )


def start_pos(spark, sf_dir) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    return c.select(
        _replay_of("c_custkey").alias("replay_id"),
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("player_name"),
        F.concat(F.lit("cmd"), (F.col("c_custkey") % 3).cast("string")).alias("commander_def_name"),
        (F.col("c_custkey") % 200).alias("unit_def_id"),
        ((F.col("c_custkey") * 37) % 2000).alias("x"),
        ((F.col("c_custkey") * 91) % 2000).alias("y"),
        F.lit(0).cast("long").alias("z"),
        F.col("c_custkey").alias("row_ord"),
    )


def defs_map(spark, sf_dir) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("unit_def_id"),
        F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("unit_name"),
        F.col("p_name").alias("translated_human_name"),
    )


def unit_defs(spark, sf_dir) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("unit_name"),
        F.col("p_retailprice").alias("metalcost"),
        (F.col("p_retailprice") * 10).alias("energycost"),
        (F.col("p_size") * 100).cast("double").alias("health"),
        (F.col("p_size") * 30).cast("double").alias("buildtime"),
    )


def map_envir_econ(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        _replay_of("user_id").alias("replay_id"),
        event_frame().alias("frame"),
        (F.col("user_id") % 20).alias("wind_strength"),
        (F.col("event_id") % 7).alias("tidal_strength"),
        F.col("event_id").alias("row_ord"),
    )


def unit_state_snapshots(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        _replay_of("user_id").alias("replay_id"),
        event_frame().alias("frame"),
        F.col("user_id").alias("unit_id"),
        (F.col("user_id") % 16).alias("team_id"),
        (F.col("event_id") % 1000).alias("currentHealth"),
        F.lit(1000).cast("long").alias("currentMaxHealth"),
        (F.col("value") / 100).alias("experience"),
        (F.col("event_type") == "signup").alias("is_being_built"),
        (F.col("event_type") == "error").alias("is_stunned"),
        F.lit(False).alias("is_cloaked"),
        F.lit(0).cast("long").alias("is_transporting_count"),
        F.lit(500).cast("long").alias("current_max_range"),
        (F.col("event_type") == "purchase").alias("is_firing"),
        F.col("event_id").alias("row_ord"),
    )


def construction_log(spark, sf_dir) -> DataFrame:
    from ..functions import code_to_name

    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        _replay_of("l_suppkey").alias("replay_id"),
        day_frame("l_shipdate").alias("frame"),
        code_to_name((F.col("l_linenumber") % 6) + 1, "ConstructionActionsEnum").alias("event"),
        F.col("l_orderkey").alias("builder_unit_id"),
        (F.col("l_partkey") % 25).alias("builder_unit_def_id"),
        (F.col("l_suppkey") % 16).alias("builder_player_id"),
        F.col("l_partkey").alias("target_unit_id"),
        (F.col("l_partkey") % 200).alias("target_unit_def_id"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("long"))
        .otherwise(F.col("l_suppkey") % 16).alias("target_player_id"),
        (F.col("l_quantity") / 100).alias("buildpower"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_ord"),
    )


ADAPTERS = {
    "damage_log": damage_log,
    "commands_log": commands_log,
    "unit_positions": unit_positions,
    "unit_events": unit_events,
    "unit_economy": unit_economy,
    "team_stats": team_stats,
    "start_pos": start_pos,
    "defs_map": defs_map,
    "unit_defs": unit_defs,
    "map_envir_econ": map_envir_econ,
    "unit_state_snapshots": unit_state_snapshots,
    "construction_log": construction_log,
}


def load(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Lazily build the named aspect tables (all adapters when none named)."""
    names = names or tuple(ADAPTERS)
    return {n: ADAPTERS[n](spark, sf_dir) for n in names}
