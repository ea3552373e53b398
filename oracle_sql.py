"""DuckDB oracle SQL for the registered queries.

Each query re-derives the aspect tables from the driver views with the same
adapter rules as ``tickframe.sources.adapters`` and then computes the operator
with a *different* formulation from the Spark plan: single unbucketed
windows, ``ASOF JOIN``, cross join + overlap filter, full outer joins.
Float outputs are rounded the same way on both sides (``round(x * 10^d) /
10^d``); arrays are rendered as sorted comma-joined strings.
"""

from __future__ import annotations

DBL = "CAST({} AS DOUBLE)"
FPS = "CAST(30 AS DOUBLE)"

ADAPTERS = {
    "damage_log": """
  SELECT user_id // 15 AS replay_id,
         (epoch_us(ts) - 1704067200000000) // 2000000 AS frame,
         user_id % 16 AS victim_team_id,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id % 5 END AS attacker_team_id,
         user_id AS victim_unit_id,
         user_id % 40 AS victim_def_id,
         CASE WHEN event_id % 10 = 0 THEN NULL
              ELSE user_id // 15 * 15 + (user_id * 7 + 3) % 15 END AS attacker_unit_id,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id % 25 END AS attacker_def_id,
         event_id % 11 AS weapon_def_id,
         event_id AS projectile_id,
         value AS damage,
         event_type = 'error' AS is_paralyzer,
         event_id * 37 % 2000 AS victim_pos_x,
         event_id * 91 % 2000 AS victim_pos_y,
         CAST(0 AS BIGINT) AS victim_pos_z,
         event_id AS row_ord
  FROM events""",
    "commands_log": """
  SELECT user_id // 15 AS replay_id,
         (epoch_us(ts) - 1704067200000000) // 2000000 AS frame,
         user_id % 16 AS teamId,
         user_id AS unitId,
         event_id % 1000 AS cmd_id,
         CASE event_type WHEN 'click' THEN 'MOVE' WHEN 'view' THEN 'GUARD'
              WHEN 'purchase' THEN 'BUILD' WHEN 'signup' THEN 'REPAIR'
              WHEN 'error' THEN 'ATTACK' END AS cmd_name,
         CAST(0 AS BIGINT) AS cmd_tag,
         CAST(NULL AS BIGINT) AS target_unit_id,
         event_id * 37 % 2000 AS x,
         event_id * 91 % 2000 AS y,
         CAST(0 AS BIGINT) AS z,
         event_id AS row_ord
  FROM events""",
    "unit_positions": """
  SELECT user_id // 15 AS replay_id,
         (epoch_us(ts) - 1704067200000000) // 2000000 AS frame,
         user_id AS unit_id,
         user_id % 25 AS unit_def_id,
         user_id % 16 AS team_id,
         event_id * 37 % 2000 AS x,
         event_id * 91 % 2000 AS y,
         CAST(0 AS BIGINT) AS z,
         CAST(0 AS DOUBLE) AS vx, CAST(0 AS DOUBLE) AS vy, CAST(0 AS DOUBLE) AS vz,
         CAST(0 AS BIGINT) AS heading,
         event_id AS row_ord
  FROM events""",
    "unit_events": """
  WITH o AS (
    SELECT o_custkey // 15 AS replay_id, o_orderkey + 10000000 AS unit_id,
           o_custkey % 200 AS unit_def_id, o_custkey % 16 AS unit_team_id,
           30 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS born,
           o_orderstatus
    FROM orders
    UNION ALL
    SELECT c_custkey // 15, c_custkey, c_custkey % 200, c_custkey % 16, 0, 'C'
    FROM customer WHERE c_custkey % 4 <> 3),
  le AS (SELECT user_id, max((epoch_us(ts) - 1704067200000000) // 2000000) AS last_frame
         FROM events GROUP BY user_id),
  ls AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
  ev AS (
    SELECT replay_id, unit_id, unit_def_id, unit_team_id, born AS frame, 'CREATED' AS event_type, 1 AS code FROM o
    UNION ALL
    SELECT replay_id, unit_id, unit_def_id, unit_team_id, born, 'FINISHED', 2 FROM o
    UNION ALL
    SELECT replay_id, unit_id, unit_def_id, unit_team_id,
           greatest(30 * date_diff('day', DATE '1995-01-01', CAST(ls.last_ship AS DATE)), born + 30),
           'DESTROYED', 3
    FROM o JOIN ls ON ls.l_orderkey + 10000000 = o.unit_id WHERE o.o_orderstatus = 'F'
    UNION ALL
    SELECT replay_id, unit_id, unit_def_id, unit_team_id, last_frame + 300, 'DESTROYED', 3
    FROM o JOIN le ON le.user_id = o.unit_id WHERE o.o_orderstatus = 'C' AND unit_id % 3 = 0
    UNION ALL
    SELECT replay_id, unit_id, unit_def_id, unit_team_id, 600, 'FINISHED', 4
    FROM o WHERE o.o_orderstatus = 'C' AND unit_id % 5 = 0)
  SELECT replay_id, CAST(frame AS BIGINT) AS frame, unit_id, unit_def_id, unit_team_id,
         CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y, CAST(0 AS BIGINT) AS z,
         CAST(NULL AS BIGINT) AS attacker_unit_id, CAST(NULL AS BIGINT) AS attacker_unit_def_id,
         CAST(NULL AS BIGINT) AS attacker_team_id, event_type,
         CAST(NULL AS BIGINT) AS old_team_id, CAST(NULL AS BIGINT) AS new_team_id,
         CAST(NULL AS BIGINT) AS builder_id, CAST(NULL AS BIGINT) AS factory_queue_len,
         unit_id * 4 + code AS row_ord
  FROM ev""",
    "unit_economy": """
  SELECT l_suppkey // 15 AS replay_id,
         CAST(30 * date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS frame,
         l_partkey AS unit_id,
         l_partkey % 25 AS unit_def_id,
         l_suppkey % 16 AS team_id,
         'SNAPSHOT' AS event_type,
         l_quantity AS metal_make,
         l_quantity * l_discount AS metal_use,
         l_tax * 100 AS energy_make,
         l_discount * 100 AS energy_use,
         l_orderkey * 8 + l_linenumber AS row_ord
  FROM lineitem""",
    "start_pos": """
  SELECT c_custkey // 15 AS replay_id, c_custkey AS player_id, c_name AS player_name,
         'cmd' || CAST(c_custkey % 3 AS VARCHAR) AS commander_def_name,
         c_custkey % 200 AS unit_def_id,
         c_custkey * 37 % 2000 AS x, c_custkey * 91 % 2000 AS y, CAST(0 AS BIGINT) AS z,
         c_custkey AS row_ord
  FROM customer""",
    "defs_map": """
  SELECT p_partkey AS unit_def_id, 'u' || CAST(p_partkey AS VARCHAR) AS unit_name,
         p_name AS translated_human_name
  FROM part""",
    "unit_defs": """
  SELECT 'u' || CAST(p_partkey AS VARCHAR) AS unit_name, p_retailprice AS metalcost,
         p_retailprice * 10 AS energycost, CAST(p_size * 100 AS DOUBLE) AS health,
         CAST(p_size * 30 AS DOUBLE) AS buildtime
  FROM part""",
}


ADAPTERS["map_envir_econ"] = """
  SELECT user_id // 15 AS replay_id,
         (epoch_us(ts) - 1704067200000000) // 2000000 AS frame,
         user_id % 20 AS wind_strength, event_id % 7 AS tidal_strength, event_id AS row_ord
  FROM events"""
ADAPTERS["unit_state_snapshots"] = """
  SELECT user_id // 15 AS replay_id,
         (epoch_us(ts) - 1704067200000000) // 2000000 AS frame,
         user_id AS unit_id, user_id % 16 AS team_id, event_id % 1000 AS currentHealth,
         CAST(1000 AS BIGINT) AS currentMaxHealth, value / CAST(100 AS DOUBLE) AS experience,
         event_type = 'signup' AS is_being_built, event_type = 'error' AS is_stunned,
         false AS is_cloaked, CAST(0 AS BIGINT) AS is_transporting_count,
         CAST(500 AS BIGINT) AS current_max_range, event_type = 'purchase' AS is_firing,
         event_id AS row_ord
  FROM events"""


def _construction_sql() -> str:
    from tickframe.enums import ENUMS
    case = "CASE l_linenumber % 6 + 1 " + " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in ENUMS["ConstructionActionsEnum"].items()) + " END"
    return f"""
  SELECT l_suppkey // 15 AS replay_id,
         CAST(30 * date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS frame,
         {case} AS event,
         l_orderkey AS builder_unit_id, l_partkey % 25 AS builder_unit_def_id,
         l_suppkey % 16 AS builder_player_id, l_partkey AS target_unit_id,
         l_partkey % 200 AS target_unit_def_id,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE l_suppkey % 16 END AS target_player_id,
         l_quantity / CAST(100 AS DOUBLE) AS buildpower,
         l_orderkey * 8 + l_linenumber AS row_ord
  FROM lineitem"""


ADAPTERS["construction_log"] = _construction_sql()


def _team_stats_sql() -> str:
    from tickframe.schemas import ASPECTS
    from tickframe.sources.adapters import TEAM_KEY_RULES, TEAM_PRICE_DIVISORS

    cols = []
    for f in ASPECTS["team_stats"][2:]:
        if f.name in TEAM_PRICE_DIVISORS:
            cols.append(f"o_totalprice / {DBL.format(TEAM_PRICE_DIVISORS[f.name])} AS {f.name}")
        else:
            mod, factor = TEAM_KEY_RULES[f.name]
            typ = "DOUBLE" if f.divisor else "BIGINT"
            cols.append(f"CAST((o_orderkey % {mod}) * {factor} AS {typ}) AS {f.name}")
    return (
        "\n  SELECT o_custkey // 15 AS replay_id,\n"
        "         CAST(30 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS frame,\n"
        "         o_custkey % 16 AS team_id,\n         "
        + ",\n         ".join(cols)
        + ",\n         o_orderkey AS row_ord\n  FROM orders"
    )


ADAPTERS["team_stats"] = _team_stats_sql()


def with_aspects(body: str, *aspects: str) -> str:
    ctes = ",\n".join(f"a_{a} AS ({ADAPTERS[a]}\n)" for a in aspects)
    return f"WITH {ctes}\n{body}"


def rnd(expr: str, d: int) -> str:
    scale = DBL.format(f"1e{d}")
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's decimal rounding never
    # produces a negative zero).
    return f"(round(({expr}) * {scale}) / {scale} + 0.0)"


def rounded(sql: str, doubles: dict[str, int]) -> str:
    """Wrap a query so the named double columns are rounded to d decimals."""
    if not doubles:
        return sql
    rep = ", ".join(f"{rnd(c, d)} AS {c}" for c, d in doubles.items())
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


# --------------------------------------------------------------------------- stats
def _engagements(where: str, keys: str, split: str, id_expr: str) -> str:
    return f"""
  d AS (SELECT * FROM a_damage_log {where}),
  f AS (
    SELECT *, CASE WHEN lag(frame) OVER w IS NULL THEN 1
                   WHEN {split} THEN 1 ELSE 0 END AS flag
    FROM d WINDOW w AS (PARTITION BY {keys} ORDER BY frame, row_ord)),
  s AS (
    SELECT *, CAST(sum(flag) OVER (PARTITION BY {keys} ORDER BY frame, row_ord
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n
    FROM f)
SELECT replay_id, {id_expr} AS engagement_id,
       min(frame) AS start_frame, max(frame) AS end_frame,
       avg(victim_pos_x) AS location_x, avg(victim_pos_y) AS location_y,
       coalesce(array_to_string(list_sort(list(DISTINCT attacker_team_id)
                FILTER (WHERE attacker_team_id IS NOT NULL)), ','), '') AS involved_players,
       sum(damage) AS total_damage,
       (max(frame) - min(frame)) / {FPS} AS duration_seconds
FROM s GROUP BY ALL"""


ENG_DOUBLES = {"location_x": 6, "location_y": 6, "total_damage": 4, "duration_seconds": 6}


def engagements_spatiotemporal(lull: float, spatial: float) -> str:
    split = (f"frame - lag(frame) OVER w > {lull} OR sqrt((victim_pos_x - lag(victim_pos_x) OVER w) * "
             f"(victim_pos_x - lag(victim_pos_x) OVER w) + (victim_pos_y - lag(victim_pos_y) OVER w) * "
             f"(victim_pos_y - lag(victim_pos_y) OVER w)) > {spatial}")
    body = "," + _engagements("WHERE attacker_unit_id IS NOT NULL", "replay_id", split, "n")
    return rounded(with_aspects(body, "damage_log"), ENG_DOUBLES)


def engagements_global(lull: float) -> str:
    body = "," + _engagements("", "replay_id", f"frame - lag(frame) OVER w > {lull}", "n")
    return rounded(with_aspects(body, "damage_log"), ENG_DOUBLES)


def engagements_per_unit(lull: float) -> str:
    body = "," + _engagements(
        "WHERE attacker_unit_id IS NOT NULL", "replay_id, attacker_unit_id",
        f"frame - lag(frame) OVER w > {lull}",
        "CAST(attacker_unit_id AS VARCHAR) || '_' || CAST(n AS VARCHAR)")
    return rounded(with_aspects(body, "damage_log"), ENG_DOUBLES)


def crisis(lull: int, window: int = 900) -> str:
    body = f""",
  present AS (
    SELECT DISTINCT replay_id FROM a_damage_log
    WHERE replay_id IN (SELECT replay_id FROM a_commands_log)
      AND replay_id IN (SELECT replay_id FROM a_unit_events)),
  h AS (
    SELECT replay_id, victim_unit_id, victim_team_id, frame,
           lag(frame) OVER (PARTITION BY replay_id, victim_unit_id ORDER BY frame, row_ord) AS pf
    FROM a_damage_log WHERE victim_unit_id IS NOT NULL),
  starts AS (
    SELECT replay_id, victim_team_id AS player_id, victim_unit_id, frame AS crisis_start_frame
    FROM h WHERE (pf IS NULL OR frame - pf > {lull}) AND replay_id IN (SELECT replay_id FROM present)),
  resp AS (
    SELECT DISTINCT replay_id, teamId AS player_id, frame AS response_frame FROM a_commands_log
    WHERE cmd_name IN ('ATTACK', 'FIGHT', 'REPAIR', 'RECLAIM', 'GUARD', 'MOVE')),
  m AS (
    SELECT s.*, r.response_frame FROM starts s
    ASOF LEFT JOIN resp r ON s.replay_id = r.replay_id AND s.player_id = r.player_id
                         AND r.response_frame >= s.crisis_start_frame),
  dead AS (
    SELECT replay_id, unit_id, arg_min(frame, row_ord) AS destruction_frame
    FROM a_unit_events WHERE event_type = 'DESTROYED' GROUP BY ALL)
SELECT m.replay_id, m.player_id,
       row_number() OVER (PARTITION BY m.replay_id
                          ORDER BY crisis_start_frame, m.player_id, victim_unit_id) - 1 AS crisis_id,
       victim_unit_id, crisis_start_frame,
       coalesce(response_frame - crisis_start_frame, -1) AS time_to_response_frames,
       NOT coalesce(destruction_frame <= crisis_start_frame + {window}, false) AS asset_survived
FROM m LEFT JOIN dead ON dead.replay_id = m.replay_id AND dead.unit_id = m.victim_unit_id"""
    return with_aspects(body, "damage_log", "commands_log", "unit_events")


def army(dedupe: bool = False) -> str:
    first = ("QUALIFY row_number() OVER (PARTITION BY replay_id, unit_id ORDER BY row_ord) = 1"
             if dedupe else "")
    return with_aspects(f""",
  mf AS (SELECT replay_id, max(frame) AS max_frame FROM a_unit_events GROUP BY ALL),
  fin AS (SELECT replay_id, unit_id, unit_def_id, unit_team_id, frame AS creation_frame
          FROM a_unit_events WHERE event_type = 'FINISHED' {first}),
  des AS (SELECT replay_id, unit_id, frame AS death_frame
          FROM a_unit_events WHERE event_type = 'DESTROYED' {first}),
  life AS (
    SELECT fin.replay_id, unit_team_id AS team_id, creation_frame,
           coalesce(death_frame, max_frame + 1) AS death_frame, max_frame,
           coalesce(u.metalcost, 0) AS cost
    FROM fin LEFT JOIN des ON des.replay_id = fin.replay_id AND des.unit_id = fin.unit_id
    JOIN mf ON mf.replay_id = fin.replay_id
    LEFT JOIN a_defs_map dm ON dm.unit_def_id = fin.unit_def_id
    LEFT JOIN a_unit_defs u ON u.unit_name = dm.unit_name
    WHERE dm.unit_name IS NOT NULL),
  chg AS (
    SELECT replay_id, team_id, frame, sum(delta) AS net FROM (
      SELECT replay_id, team_id, creation_frame AS frame, cost AS delta FROM life
      UNION ALL
      SELECT replay_id, team_id, death_frame, -cost FROM life WHERE death_frame <= max_frame)
    GROUP BY ALL),
  val AS (
    SELECT replay_id, team_id, frame,
           sum(net) OVER (PARTITION BY replay_id, team_id ORDER BY frame) AS army_value
    FROM chg),
  samples AS (
    SELECT replay_id, unnest(range(0, max_frame, 450)) AS frame FROM mf
    UNION
    SELECT replay_id, max_frame FROM mf),
  grid AS (
    SELECT s.replay_id, s.frame, t.team_id
    FROM samples s JOIN (SELECT DISTINCT replay_id, team_id FROM life) t USING (replay_id))
SELECT g.replay_id, CAST(g.frame AS BIGINT) AS frame, g.team_id,
       greatest(coalesce(v.army_value, 0), 0) AS army_value
FROM grid g ASOF LEFT JOIN val v
  ON v.replay_id = g.replay_id AND v.team_id = g.team_id AND v.frame <= g.frame""",
                        "unit_events", "defs_map", "unit_defs")


ARMY = army()

UEC = with_aspects(""",
  r AS (
    SELECT *, coalesce(metal_make, 0) - coalesce(metal_use, 0) AS nm,
              coalesce(energy_make, 0) - coalesce(energy_use, 0) AS ne,
              lead(frame) OVER (PARTITION BY replay_id, unit_id ORDER BY frame, row_ord) AS nf
    FROM a_unit_economy),
  econ AS (
    SELECT replay_id, team_id, unit_def_id,
           sum(nm * (nf - frame) / CAST(30 AS DOUBLE)) AS total_net_metal_contribution,
           sum(ne * (nf - frame) / CAST(30 AS DOUBLE)) AS total_net_energy_contribution
    FROM r WHERE nf IS NOT NULL AND nf - frame > 0 GROUP BY ALL),
  units AS (
    SELECT replay_id, team_id, unit_def_id, (max(frame) - min(frame)) / CAST(30 AS DOUBLE) AS life
    FROM a_unit_economy GROUP BY replay_id, unit_id, team_id, unit_def_id),
  lt AS (
    SELECT replay_id, team_id, unit_def_id, sum(life) AS total_lifetime_seconds,
           count(*) AS total_units_produced
    FROM units GROUP BY ALL)
SELECT coalesce(econ.replay_id, lt.replay_id) AS replay_id,
       coalesce(econ.team_id, lt.team_id) AS team_id,
       coalesce(econ.unit_def_id, lt.unit_def_id) AS unit_def_id,
       coalesce(total_net_metal_contribution, 0) AS total_net_metal_contribution,
       coalesce(total_net_energy_contribution, 0) AS total_net_energy_contribution,
       coalesce(total_lifetime_seconds, 0) AS total_lifetime_seconds,
       coalesce(total_units_produced, 0) AS total_units_produced
FROM econ FULL OUTER JOIN lt
  ON econ.replay_id = lt.replay_id AND econ.team_id = lt.team_id AND econ.unit_def_id = lt.unit_def_id""",
                  "unit_economy")


def binned(step: int = 300, join: str = "FULL OUTER", bin_end: bool = False) -> str:
    body = f""",
  iv AS (
    SELECT replay_id, unit_id, team_id, unit_def_id, frame AS start_f,
           lead(frame) OVER (PARTITION BY replay_id, unit_id ORDER BY frame, row_ord) AS end_f,
           coalesce(metal_make, 0) AS mp, coalesce(metal_use, 0) AS mc,
           coalesce(energy_make, 0) AS ep, coalesce(energy_use, 0) AS ec
    FROM a_unit_economy),
  ivs AS (SELECT * FROM iv WHERE end_f IS NOT NULL),
  rng AS (
    SELECT replay_id, min(start_f) // {step} * {step} AS lo, max(end_f) // {step} * {step} AS hi
    FROM ivs GROUP BY ALL),
  bins AS (SELECT replay_id, unnest(range(lo, hi + {step}, {step})) AS bin_start FROM rng),
  ov AS (
    SELECT i.*, b.bin_start,
           (least(end_f, b.bin_start + {step}) - greatest(start_f, b.bin_start)) / CAST(30 AS DOUBLE) AS s
    FROM ivs i JOIN bins b ON b.replay_id = i.replay_id
     AND greatest(i.start_f, b.bin_start) < least(i.end_f, b.bin_start + {step})),
  act AS (
    SELECT replay_id, team_id, unit_def_id, bin_start,
           sum(s) AS total_unit_seconds_in_bin, count(DISTINCT unit_id) AS units_alive_in_bin,
           sum(mp * s) AS total_metal_produced_in_bin, sum(mc * s) AS total_metal_consumed_in_bin,
           sum(ep * s) AS total_energy_produced_in_bin, sum(ec * s) AS total_energy_consumed_in_bin
    FROM ov GROUP BY ALL),
  prod AS (
    SELECT replay_id, unit_team_id AS team_id, unit_def_id, frame // {step} * {step} AS bin_start,
           count(DISTINCT unit_id) AS total_units_produced_in_bin
    FROM a_unit_events WHERE event_type = 'CREATED' GROUP BY ALL)
SELECT coalesce(a.replay_id, p.replay_id) AS replay_id,
       coalesce(a.team_id, p.team_id) AS team_id,
       coalesce(a.unit_def_id, p.unit_def_id) AS unit_def_id,
       CAST(coalesce(a.bin_start, p.bin_start) AS BIGINT) AS time_bin_start_frame,{{end_col}}
       coalesce(units_alive_in_bin, 0) AS units_alive_in_bin,
       coalesce(total_unit_seconds_in_bin, 0) AS total_unit_seconds_in_bin,
       coalesce(total_units_produced_in_bin, 0) AS total_units_produced_in_bin,
       coalesce(total_metal_produced_in_bin, 0) AS total_metal_produced_in_bin,
       coalesce(total_metal_consumed_in_bin, 0) AS total_metal_consumed_in_bin,
       coalesce(total_energy_produced_in_bin, 0) AS total_energy_produced_in_bin,
       coalesce(total_energy_consumed_in_bin, 0) AS total_energy_consumed_in_bin
FROM act a {{join}} JOIN prod p
  ON a.replay_id = p.replay_id AND a.team_id = p.team_id AND a.unit_def_id = p.unit_def_id
 AND a.bin_start = p.bin_start"""
    end_col = (f"\n       CAST(coalesce(a.bin_start, p.bin_start) + {step} AS BIGINT) "
               "AS time_bin_end_frame," if bin_end else "")
    return with_aspects(body.replace("{end_col}", end_col).replace("{join}", join),
                        "unit_economy", "unit_events")


BINNED_DOUBLES = {c: 4 for c in (
    "total_unit_seconds_in_bin", "total_metal_produced_in_bin", "total_metal_consumed_in_bin",
    "total_energy_produced_in_bin", "total_energy_consumed_in_bin")}
UEC_DOUBLES = {"total_net_metal_contribution": 3, "total_net_energy_contribution": 3,
               "total_lifetime_seconds": 4}
TEAM_SUM_DOUBLES = {c: 2 for c in ("total_metal_produced", "total_metal_used",
                                   "total_energy_produced", "total_energy_used")}

STATS_SQL = {
    "damage_by_unit_def": rounded(with_aspects("""
SELECT replay_id, attacker_def_id AS unit_def_id, sum(damage) AS total_damage_dealt
FROM a_damage_log WHERE attacker_def_id IS NOT NULL GROUP BY ALL""", "damage_log"),
                                  {"total_damage_dealt": 4}),
    "resources_by_player": rounded(with_aspects("""
SELECT replay_id, team_id, sum(metal_produced) AS total_metal_produced,
       sum(metal_used) AS total_metal_used, sum(energy_produced) AS total_energy_produced,
       sum(energy_used) AS total_energy_used
FROM a_team_stats GROUP BY ALL""", "team_stats"), TEAM_SUM_DOUBLES),
    "player_economic_efficiency": rounded(with_aspects("""
SELECT replay_id, team_id AS player_id, max(metal_used) AS total_metal_spent,
       max(energy_used) AS total_energy_spent, max(damage_dealt) AS total_damage_output,
       max(damage_dealt) / (max(metal_used) + max(energy_used) + CAST(1e-6 AS DOUBLE))
         AS damage_per_resource_unit
FROM a_team_stats GROUP BY ALL""", "team_stats"),
        {"total_metal_spent": 6, "total_energy_spent": 6, "total_damage_output": 6,
         "damage_per_resource_unit": 6}),
    "player_collaboration": rounded(with_aspects("""
SELECT replay_id, team_id AS player_id, max(metal_sent) AS total_metal_sent,
       max(metal_received) AS total_metal_received, max(energy_sent) AS total_energy_sent,
       max(energy_received) AS total_energy_received,
       max(metal_sent) - max(metal_received) AS net_metal_contribution,
       max(energy_sent) - max(energy_received) AS net_energy_contribution
FROM a_team_stats GROUP BY ALL""", "team_stats"),
        {c: 6 for c in ("total_metal_sent", "total_metal_received", "total_energy_sent",
                        "total_energy_received", "net_metal_contribution",
                        "net_energy_contribution")}),
    "aggression_by_unit": rounded(with_aspects(""",
  s AS (
    SELECT *, first_value(frame) OVER w AS f0, first_value(x) OVER w AS x0,
              first_value(y) OVER w AS y0
    FROM a_unit_positions WINDOW w AS (PARTITION BY replay_id, unit_id ORDER BY frame, row_ord))
SELECT replay_id, unit_id,
       sum(sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0))
           / ((frame - f0) / CAST(30 AS DOUBLE) + CAST(0.1 AS DOUBLE))) AS aggression_score
FROM s GROUP BY ALL""", "unit_positions"), {"aggression_score": 6}),
    "calculate_player_apm_and_focus": rounded(with_aspects("""
SELECT replay_id, teamId AS player_id, CAST(floor(frame / CAST(1800 AS DOUBLE)) AS INTEGER) AS minute,
       count(*) AS actions_per_minute,
       count_if(cmd_name IN ('ATTACK', 'FIGHT', 'MANUAL_FIRE')) / count(*) * 100 AS combat_focus_pct,
       count_if(cmd_name IN ('BUILD', 'RECLAIM', 'REPAIR')) / count(*) * 100 AS economy_focus_pct
FROM a_commands_log GROUP BY ALL""", "commands_log"),
        {"combat_focus_pct": 6, "economy_focus_pct": 6}),
    "map_control_timeline": rounded(with_aspects("""
SELECT replay_id, team_id AS player_id, CAST(floor(frame / CAST(1800 AS DOUBLE)) AS INTEGER) AS minute,
       (max(x) - min(x)) * (max(y) - min(y)) AS bounding_box_area,
       stddev_samp(x) AS dispersion_x, stddev_samp(y) AS dispersion_y
FROM a_unit_positions GROUP BY ALL""", "unit_positions"),
        {"dispersion_x": 6, "dispersion_y": 6}),
    "force_composition_timeline": with_aspects(""",
  c AS (
    SELECT replay_id, unit_team_id AS player_id,
           CAST(floor(frame / CAST(1800 AS DOUBLE)) AS INTEGER) AS minute, unit_def_id,
           count(*) AS units_produced
    FROM a_unit_events WHERE event_type = 'CREATED' GROUP BY ALL)
SELECT replay_id, player_id, minute,
       string_agg(CAST(unit_def_id AS VARCHAR) || ':' || CAST(units_produced AS VARCHAR), ','
                  ORDER BY unit_def_id, units_produced) AS unit_stats
FROM c GROUP BY ALL""", "unit_events"),
    "combat_engagement_summary_default": engagements_spatiotemporal(300, 500),
    "combat_engagement_summary_global": engagements_global(300),
    "combat_engagement_summary_per_unit": engagements_per_unit(450),
    "combat_engagement_summary_per_unit_l10000": engagements_per_unit(10000),
    "crisis_response_index": crisis(450),
    "crisis_response_index_l10000": crisis(10000),
    "army_value_timeline": rounded(ARMY, {"army_value": 4}),
    "unit_economic_contribution": rounded(UEC, UEC_DOUBLES),
    "unit_economic_contribution_binned": rounded(binned(300), BINNED_DOUBLES),
    "command_log": with_aspects("SELECT * FROM a_commands_log", "commands_log"),
}

for _a in ("damage_log", "commands_log", "unit_positions", "unit_events", "unit_economy",
           "team_stats", "start_pos", "map_envir_econ", "unit_state_snapshots",
           "construction_log"):
    STATS_SQL[f"stream_{_a}"] = with_aspects(f"SELECT * FROM a_{_a}", _a)


# --------------------------------------------------------------------------- views
def _on_binned(body: str) -> str:
    inner = binned(300).replace("\n", "\n  ")
    return f"WITH b AS (\n  {inner}\n),{body}"


def _net(prefix: str = "") -> str:
    return f"({prefix}total_metal_produced_in_bin - {prefix}total_metal_consumed_in_bin)"


_VIEWS = {
    "vw_net_metal_by_time_team": """
  v AS (SELECT replay_id, time_bin_start_frame, team_id, sum(total_metal_produced_in_bin
               - total_metal_consumed_in_bin) AS net_metal FROM b GROUP BY ALL),
  bins AS (SELECT DISTINCT replay_id, time_bin_start_frame FROM b),
  teams AS (SELECT DISTINCT replay_id, team_id FROM b)
SELECT g.replay_id, g.time_bin_start_frame, t.team_id, coalesce(v.net_metal, 0) AS net_metal
FROM bins g JOIN teams t USING (replay_id)
LEFT JOIN v ON v.replay_id = g.replay_id AND v.time_bin_start_frame = g.time_bin_start_frame
           AND v.team_id = t.team_id""",
    "vw_metal_by_time_def": """
  v AS (SELECT replay_id, team_id, time_bin_start_frame, unit_def_id,
               sum(total_metal_produced_in_bin) AS metal_produced FROM b GROUP BY ALL),
  rows_ AS (SELECT DISTINCT replay_id, team_id, time_bin_start_frame FROM b),
  defs AS (SELECT DISTINCT replay_id, team_id, unit_def_id FROM b)
SELECT r.replay_id, r.team_id, r.time_bin_start_frame, d.unit_def_id,
       coalesce(v.metal_produced, 0) AS metal_produced
FROM rows_ r JOIN defs d ON d.replay_id = r.replay_id AND d.team_id = r.team_id
LEFT JOIN v ON v.replay_id = r.replay_id AND v.team_id = r.team_id
           AND v.time_bin_start_frame = r.time_bin_start_frame AND v.unit_def_id = d.unit_def_id""",
    "vw_small_multiples": """
  v AS (SELECT replay_id, team_id, time_bin_start_frame, unit_def_id,
               sum(total_metal_produced_in_bin) AS metal_produced FROM b GROUP BY ALL),
  bins AS (SELECT DISTINCT replay_id, time_bin_start_frame FROM b),
  defs AS (SELECT DISTINCT replay_id, team_id, unit_def_id FROM b)
SELECT g.replay_id, d.team_id, g.time_bin_start_frame, d.unit_def_id,
       coalesce(v.metal_produced, 0) AS metal_produced
FROM bins g JOIN defs d USING (replay_id)
LEFT JOIN v ON v.replay_id = g.replay_id AND v.team_id = d.team_id
           AND v.time_bin_start_frame = g.time_bin_start_frame AND v.unit_def_id = d.unit_def_id""",
    "vw_build_order_events": """
  x AS (SELECT 1)
SELECT replay_id, team_id, time_bin_start_frame, unit_def_id, total_units_produced_in_bin
FROM b WHERE total_units_produced_in_bin > 0""",
    "vw_net_metal_heatmap": f"""
  bins AS (SELECT replay_id, time_bin_start_frame,
                  dense_rank() OVER (PARTITION BY replay_id ORDER BY time_bin_start_frame) - 1
                    AS time_index
           FROM (SELECT DISTINCT replay_id, time_bin_start_frame FROM b)),
  labels AS (SELECT replay_id, team_id, unit_def_id,
                    dense_rank() OVER (PARTITION BY replay_id, team_id
                                       ORDER BY 'Unit ' || CAST(unit_def_id AS VARCHAR)) - 1
                      AS unit_index
             FROM (SELECT DISTINCT replay_id, team_id, unit_def_id FROM b)),
  cells AS (SELECT replay_id, team_id, time_bin_start_frame, unit_def_id, {_net()} AS net_metal
            FROM b),
  rng AS (SELECT replay_id, team_id, least(min(net_metal), 0) AS min_value,
                 greatest(max(net_metal), 0) AS max_value FROM cells GROUP BY ALL)
SELECT c.replay_id, c.team_id, time_index, unit_index, c.time_bin_start_frame, c.unit_def_id,
       net_metal, min_value, max_value
FROM cells c JOIN bins USING (replay_id, time_bin_start_frame)
JOIN labels USING (replay_id, team_id, unit_def_id)
JOIN rng USING (replay_id, team_id)""",
    "vw_economic_flow_edges": """
  g AS (SELECT replay_id, team_id, unit_def_id,
               sum(total_metal_produced_in_bin) FILTER (WHERE total_metal_produced_in_bin > 0) AS p,
               sum(total_metal_consumed_in_bin) FILTER (WHERE total_metal_consumed_in_bin > 0) AS c
        FROM b GROUP BY ALL)
SELECT replay_id, team_id, unit_def_id, 'produced' AS direction, p AS value FROM g WHERE p IS NOT NULL
UNION ALL
SELECT replay_id, team_id, unit_def_id, 'consumed', c FROM g WHERE c IS NOT NULL""",
    "vw_composition_snapshot": """
  x AS (SELECT 1)
SELECT replay_id, team_id, time_bin_start_frame, unit_def_id,
       sum(total_metal_produced_in_bin) AS metal_produced
FROM b WHERE total_metal_produced_in_bin > 0 GROUP BY ALL""",
    "vw_build_order_transitions": """
  e AS (SELECT replay_id, team_id, unit_def_id,
               lead(unit_def_id) OVER (PARTITION BY replay_id, team_id
                                       ORDER BY time_bin_start_frame, unit_def_id) AS nxt
        FROM b WHERE total_units_produced_in_bin > 0)
SELECT replay_id, team_id, unit_def_id AS source_def_id, nxt AS target_def_id,
       count(*) AS transitions
FROM e WHERE nxt IS NOT NULL GROUP BY ALL""",
    "vw_producer_consumer_hierarchy": """
  g AS (SELECT replay_id, team_id, unit_def_id,
               sum(total_metal_produced_in_bin) FILTER (WHERE total_metal_produced_in_bin > 0) AS p,
               sum(total_metal_consumed_in_bin) FILTER (WHERE total_metal_consumed_in_bin > 0) AS c
        FROM b GROUP BY ALL),
  e AS (SELECT replay_id, team_id, 'Producers' AS role, unit_def_id, p AS value FROM g WHERE p IS NOT NULL
        UNION ALL
        SELECT replay_id, team_id, 'Consumers', unit_def_id, c FROM g WHERE c IS NOT NULL)
SELECT replay_id, team_id, role,
       string_agg(CAST(unit_def_id AS VARCHAR) || ':' ||
                  CAST(CAST(round(value * CAST(100 AS DOUBLE)) AS BIGINT) AS VARCHAR), ','
                  ORDER BY unit_def_id, value) AS children
FROM e GROUP BY ALL""",
    "vw_economic_rhythm": """
  x AS (SELECT 1)
SELECT replay_id, team_id, time_bin_start_frame,
       sum(total_metal_produced_in_bin) AS metal_produced,
       sum(total_energy_produced_in_bin) AS energy_produced,
       CAST(sum(total_units_produced_in_bin) AS BIGINT) AS units_produced
FROM b GROUP BY ALL""",
    "vw_first_appearance_summary": """
  fa AS (SELECT replay_id, team_id, unit_def_id,
                min(time_bin_start_frame) / CAST(30 AS DOUBLE) AS t
         FROM b WHERE units_alive_in_bin > 0 GROUP BY ALL)
SELECT team_id, unit_def_id, count(*) AS replays, min(t) AS t_min,
       quantile_cont(t, 0.25) AS t_q1, quantile_cont(t, 0.5) AS t_median,
       quantile_cont(t, 0.75) AS t_q3, max(t) AS t_max
FROM fa GROUP BY ALL""",
    "vw_lag_correlation": """
  rng AS (SELECT replay_id, min(time_bin_start_frame) AS lo, max(time_bin_start_frame) AS hi
          FROM b GROUP BY ALL),
  grid AS (SELECT replay_id, unnest(range(lo, hi + 300, 300)) AS bin FROM rng),
  sa AS (SELECT replay_id, time_bin_start_frame AS bin, sum(total_units_produced_in_bin) AS v
         FROM b WHERE team_id = 0 GROUP BY ALL),
  sb AS (SELECT replay_id, time_bin_start_frame AS bin, sum(total_units_produced_in_bin) AS v
         FROM b WHERE team_id = 1 GROUP BY ALL),
  a AS (SELECT g.replay_id, g.bin, CAST(coalesce(sa.v, 0) AS DOUBLE) AS a
        FROM grid g LEFT JOIN sa USING (replay_id, bin)),
  bb AS (SELECT g.replay_id, g.bin, CAST(coalesce(sb.v, 0) AS DOUBLE) AS b
         FROM grid g LEFT JOIN sb USING (replay_id, bin)),
  lags AS (SELECT unnest([-3, -2, -1, 0, 1, 2, 3]) AS lag),
  pairs AS (SELECT a.replay_id, lags.lag, a.a, bb.b
            FROM a JOIN bb ON bb.replay_id = a.replay_id, lags
            WHERE bb.bin = a.bin + lags.lag * 300)
SELECT replay_id, lag,
       CASE WHEN stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN corr(a, b) END AS correlation,
       count(*) AS pairs
FROM pairs GROUP BY ALL""",
    "vw_resource_tradeoff": f"""
  x AS (SELECT 1)
SELECT replay_id, time_bin_start_frame, team_id, unit_def_id, {_net()} AS net_metal,
       (total_energy_produced_in_bin - total_energy_consumed_in_bin) AS net_energy,
       units_alive_in_bin AS units_alive
FROM b""",
    "vw_sankey_fold": """
  x AS (SELECT 1)
SELECT replay_id, team_id, unit_def_id,
       sum(total_metal_produced_in_bin) FILTER (WHERE total_metal_produced_in_bin > 0) AS production,
       sum(total_metal_consumed_in_bin) FILTER (WHERE total_metal_consumed_in_bin > 0) AS consumption
FROM b GROUP BY ALL""",
}


def _enum_case(col: str, enum_key: str) -> str:
    from tickframe.enums import ENUMS
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in ENUMS[enum_key].items())
    return f"CASE {col} {whens} END"


_VIEWS["vw_longest_surplus"] = f"""
  g AS (SELECT DISTINCT replay_id, team_id, unit_def_id FROM b),
  s AS (SELECT DISTINCT replay_id, team_id, unit_def_id, time_bin_start_frame AS t FROM b
        WHERE {_net()} > 0),
  r AS (SELECT *, t - 300 * row_number() OVER (PARTITION BY replay_id, team_id, unit_def_id
                                              ORDER BY t) AS island FROM s),
  i AS (SELECT replay_id, team_id, unit_def_id, min(t) AS run_start, count(*) AS run_bins
        FROM r GROUP BY replay_id, team_id, unit_def_id, island
        QUALIFY row_number() OVER (PARTITION BY replay_id, team_id, unit_def_id
                                   ORDER BY count(*) DESC, min(t)) = 1)
SELECT replay_id, team_id, unit_def_id, run_start, coalesce(run_bins, 0) AS run_bins
FROM g LEFT JOIN i USING (replay_id, team_id, unit_def_id)"""


_RECIPES = {
    "rc_units_lost_per_player": with_aspects("""
SELECT replay_id, unit_team_id AS player_id, count(*) AS units_lost
FROM a_unit_events WHERE event_type = 'DESTROYED' GROUP BY ALL""", "unit_events"),
    "rc_unified_event_log": with_aspects("""
SELECT replay_id, frame, unit_id, unit_team_id AS team_id, 'UnitCreated' AS event_type,
       CAST(unit_def_id AS VARCHAR) AS details, row_ord, CAST(NULL AS BIGINT) AS cmd_id
FROM a_unit_events WHERE event_type = 'CREATED'
UNION ALL
SELECT replay_id, frame, unitId, teamId, 'UnitCommand', cmd_name, row_ord, cmd_id
FROM a_commands_log""", "unit_events", "commands_log"),
    "rc_unit_lifetime": with_aspects(""",
  p AS (SELECT replay_id, unit_id, min(frame) AS first_seen_frame, max(frame) AS last_seen_frame,
               count(*) AS positions FROM a_unit_positions GROUP BY ALL),
  e AS (SELECT replay_id, unit_id,
               min(frame) FILTER (WHERE event_type = 'CREATED') AS created_frame,
               min(frame) FILTER (WHERE event_type = 'DESTROYED') AS destroyed_frame
        FROM a_unit_events GROUP BY ALL)
SELECT coalesce(p.replay_id, e.replay_id) AS replay_id, coalesce(p.unit_id, e.unit_id) AS unit_id,
       first_seen_frame, last_seen_frame, coalesce(positions, 0) AS positions,
       created_frame, destroyed_frame
FROM p FULL OUTER JOIN e ON p.replay_id = e.replay_id AND p.unit_id = e.unit_id""",
                                 "unit_positions", "unit_events"),
    "rc_damage_location": with_aspects(""",
  p AS (SELECT replay_id, unit_id, frame, arg_max(x, row_ord) AS x, arg_max(y, row_ord) AS y,
               arg_max(z, row_ord) AS z FROM a_unit_positions GROUP BY ALL)
SELECT d.replay_id, d.frame, d.victim_unit_id, d.damage, d.row_ord, p.x, p.y, p.z
FROM a_damage_log d LEFT JOIN p ON p.replay_id = d.replay_id AND p.unit_id = d.victim_unit_id
 AND p.frame = d.frame""", "unit_positions", "damage_log"),
    "rc_commands_with_team_state": with_aspects(""",
  s AS (SELECT replay_id, team_id, frame,
               arg_max(metal_current, row_ord) AS metal_current,
               arg_max(energy_current, row_ord) AS energy_current,
               arg_max(metal_income, row_ord) AS metal_income,
               arg_max(energy_income, row_ord) AS energy_income
        FROM a_team_stats GROUP BY ALL)
SELECT c.replay_id, c.frame, c.teamId, c.unitId, c.cmd_name, c.row_ord,
       s.metal_current, s.energy_current, s.metal_income, s.energy_income
FROM a_commands_log c LEFT JOIN s ON s.replay_id = c.replay_id AND s.team_id = c.teamId
 AND s.frame = c.frame""", "commands_log", "team_stats"),
    "rc_damage_with_attacker_type": with_aspects(""",
  t AS (SELECT replay_id, unit_id, arg_min(unit_def_id, row_ord) AS attacker_type_def_id
        FROM a_unit_events GROUP BY ALL)
SELECT d.replay_id, d.attacker_unit_id, d.frame, d.row_ord, d.damage, t.attacker_type_def_id
FROM a_damage_log d LEFT JOIN t ON t.replay_id = d.replay_id AND t.unit_id = d.attacker_unit_id""",
                                             "damage_log", "unit_events"),
    "rc_move_commands": with_aspects("SELECT * FROM a_commands_log WHERE cmd_name = 'MOVE'",
                                     "commands_log"),
    "rc_resources_at_death": with_aspects(""",
  d AS (SELECT replay_id, unit_id, unit_team_id AS team_id, frame AS death_frame
        FROM a_unit_events WHERE event_type = 'DESTROYED'),
  s AS (SELECT replay_id, team_id, frame AS snapshot_frame,
               arg_max(metal_current, row_ord) AS metal_current,
               arg_max(energy_current, row_ord) AS energy_current
        FROM a_team_stats GROUP BY ALL)
SELECT d.replay_id, d.unit_id, d.team_id, d.death_frame, s.snapshot_frame, s.metal_current,
       s.energy_current
FROM d ASOF LEFT JOIN s ON s.replay_id = d.replay_id AND s.team_id = d.team_id
 AND s.snapshot_frame <= d.death_frame""", "unit_events", "team_stats"),
    "rc_command_codes_with_unknown": with_aspects(f"""
SELECT replay_id, coalesce({_enum_case('cmd_id', 'CommandsEnum')}, 'unknown') AS command,
       count(*) AS commands
FROM a_commands_log GROUP BY ALL""", "commands_log"),
}


def _dq_sql() -> str:
    from tickframe.schemas import ASPECTS
    parts = ["SELECT replay_id, 'damage_log' AS aspect, 'damage_negative' AS \"check\", "
             "CAST(count_if(damage < 0) AS BIGINT) AS violations FROM a_damage_log GROUP BY ALL",
             "SELECT replay_id, 'start_pos', 'player_not_unique', CAST(count_if(n > 1) AS BIGINT) FROM "
             "(SELECT replay_id, player_id, count(*) AS n FROM a_start_pos GROUP BY ALL) "
             "GROUP BY ALL"]
    from tickframe.plans.checks import FRAMED
    aspects = FRAMED
    for a in aspects:
        parts.append(
            f"SELECT replay_id, '{a}', 'frame_negative', CAST(count_if(frame < 0) AS BIGINT) "
            f"FROM a_{a} GROUP BY ALL")
        parts.append(
            f"SELECT replay_id, '{a}', 'frame_decreasing', CAST(count_if(frame < pf) AS BIGINT) FROM "
            f"(SELECT replay_id, frame, lag(frame) OVER (PARTITION BY replay_id ORDER BY row_ord, frame) "
            f"AS pf FROM a_{a}) GROUP BY ALL")
        cols = [f.name for f in ASPECTS[a] if not f.nullable]
        cond = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(
            f"SELECT replay_id, '{a}', 'required_null', CAST(count_if({cond}) AS BIGINT) "
            f"FROM a_{a} GROUP BY ALL")
    body = "\nUNION ALL\n".join(parts)
    return with_aspects(body, *aspects, "start_pos")


def _extra() -> dict[str, str]:
    from tickframe.plans.catalog import DIGITS
    out = {}
    for name, body in _VIEWS.items():
        out[name] = rounded(_on_binned(body), DIGITS.get(name, {}))
    for name, sql in _RECIPES.items():
        out[name] = rounded(sql, DIGITS.get(name, {}))
    out["dq_report"] = _dq_sql()
    return out


EXTRA_SQL = _extra()


def _contract_sql() -> dict[str, str]:
    from tickframe.enums import ENUMS
    from tickframe.schemas import ASPECTS
    q = "CAST(0.1 AS DOUBLE)"
    ev_case = "CASE event_type " + " ".join(
        f"WHEN '{v}' THEN {k}" for k, v in ENUMS["UnitEventsEnum"].items()) + " END"
    ue_cols = []
    for f in ASPECTS["unit_events"]:
        expr = ev_case if f.name == "event_type" else f"trunc({f.name})"
        ue_cols.append(f"coalesce(CAST({expr} AS INTEGER), 0) AS {f.name}")
    team_cols = ["CAST(frame AS DOUBLE) AS frame", "CAST(team_id AS DOUBLE) AS team_id"]
    from tickframe.sinks.contracts import CONTRACTS
    for name, rule in CONTRACTS["team_stats"].columns.items():
        if name in ("frame", "team_id"):
            continue
        if rule.transform == "quantize":
            team_cols.append(f"round_even(CAST({name} AS DOUBLE) / {q}, 0) AS {name}")
        else:
            team_cols.append(f"CAST({name} AS DOUBLE) AS {name}")
    binned_types = {"team_id": "INTEGER", "unit_def_id": "INTEGER",
                    "time_bin_start_frame": "BIGINT", "units_alive_in_bin": "INTEGER",
                    "total_units_produced_in_bin": "INTEGER"}
    bcols = []
    for name in ("team_id", "unit_def_id", "time_bin_start_frame", "units_alive_in_bin",
                 "total_unit_seconds_in_bin", "total_units_produced_in_bin",
                 "total_metal_produced_in_bin", "total_metal_consumed_in_bin",
                 "total_energy_produced_in_bin", "total_energy_consumed_in_bin"):
        typ = binned_types.get(name, "FLOAT")
        src = name if typ == "FLOAT" else f"trunc({name})"
        bcols.append(f"coalesce(CAST({src} AS {typ}), 0) AS {name}")
    return {
        "out_army_value_timeline": f"""
SELECT replay_id, CAST(frame AS BIGINT) AS frame, CAST(team_id AS BIGINT) AS team_id,
       CAST(round_even(army_value / {q}, 0) AS BIGINT) AS army_value
FROM ({rounded(ARMY, {"army_value": 4})}) t""",
        "out_unit_events": with_aspects(
            f"SELECT replay_id, {', '.join(ue_cols)} FROM a_unit_events", "unit_events"),
        "out_unit_positions": with_aspects("""
SELECT replay_id, CAST(frame AS BIGINT) AS frame, CAST(unit_id AS INTEGER) AS unit_id,
       CAST(unit_def_id AS INTEGER) AS unit_def_id, CAST(team_id AS INTEGER) AS team_id,
       CAST(x AS SMALLINT) AS x, CAST(y AS SMALLINT) AS y, CAST(z AS SMALLINT) AS z,
       CAST(trunc(vx) AS SMALLINT) AS vx, CAST(trunc(vy) AS SMALLINT) AS vy,
       CAST(trunc(vz) AS SMALLINT) AS vz, heading
FROM a_unit_positions""", "unit_positions"),
        "out_team_stats": with_aspects(
            f"SELECT replay_id, {', '.join(team_cols)} FROM a_team_stats", "team_stats"),
        "out_unit_economic_contribution_binned": f"""
SELECT replay_id, {', '.join(bcols)}
FROM ({rounded(binned(300), BINNED_DOUBLES)}) t""",
        "out_defs_lookup": with_aspects(
            "SELECT unit_def_id AS key, concat_ws('|', unit_name, translated_human_name) AS \"values\" "
            "FROM a_defs_map", "defs_map"),
        "resources_by_player_final": rounded(with_aspects("""
SELECT replay_id, team_id, max(metal_produced) AS total_metal_produced,
       max(metal_used) AS total_metal_used, max(energy_produced) AS total_energy_produced,
       max(energy_used) AS total_energy_used
FROM a_team_stats GROUP BY ALL""", "team_stats"), {c: 4 for c in TEAM_SUM_DOUBLES}),
        "unit_economic_contribution_binned_left": rounded(
            binned(300, join="LEFT", bin_end=True), BINNED_DOUBLES),
        "army_value_timeline_dedupe": rounded(army(dedupe=True), {"army_value": 4}),
    }


EXTRA_SQL.update(_contract_sql())


EXTRA_SQL["ss_minute_activity"] = STATS_SQL["calculate_player_apm_and_focus"]
EXTRA_SQL["ss_binned_production"] = with_aspects("""
SELECT replay_id, unit_team_id AS team_id, unit_def_id, frame // 300 * 300 AS time_bin_start_frame,
       count(*) AS units_produced_in_bin
FROM a_unit_events WHERE event_type = 'CREATED' GROUP BY ALL""", "unit_events")


EXTRA_SQL["ss_unit_engagements"] = with_aspects("""
SELECT replay_id, attacker_unit_id, min(frame) AS start_frame, max(frame) AS end_frame,
       round(sum(damage), 4) AS total_damage, CAST(sum(hits) AS BIGINT) AS hits,
       round((max(frame) - min(frame)) / 30.0, 6) AS duration_seconds
FROM (SELECT *, sum(split) OVER (PARTITION BY replay_id, attacker_unit_id ORDER BY frame) AS sid
      FROM (SELECT *, CASE WHEN frame - lag(frame) OVER (
                         PARTITION BY replay_id, attacker_unit_id ORDER BY frame) > 450
                      THEN 1 ELSE 0 END AS split
            FROM (SELECT replay_id, attacker_unit_id, frame, sum(damage) AS damage,
                         count(*) AS hits
                  FROM a_damage_log WHERE attacker_unit_id IS NOT NULL GROUP BY ALL)))
GROUP BY replay_id, attacker_unit_id, sid""", "damage_log")


EXTRA_SQL["ss_unit_engagements_closed"] = EXTRA_SQL["ss_unit_engagements"]


def _ingested(aspect: str) -> str:
    """The aspect as it comes back from quantized positional records."""
    from tickframe.schemas import ASPECTS
    steps = [f"floor({f.name} * CAST({f.divisor} AS DOUBLE)) / CAST({f.divisor} AS DOUBLE) "
             f"AS {f.name}" for f in ASPECTS[aspect] if f.divisor is not None]
    replace = f" REPLACE ({', '.join(steps)})" if steps else ""
    return with_aspects(f"SELECT * EXCLUDE (row_ord){replace} FROM a_{aspect}", aspect)


def _quarantined() -> str:
    """Accepted and rejected command records, by the faults that the query plants."""
    from tickframe.enums import ENUMS
    code = "CASE " + " ".join(f"WHEN cmd_name = '{v}' THEN {k}"
                              for k, v in ENUMS["CommandsEnum"].items()) + " END"

    def tag(kind: str, c: str) -> str:
        return f"coalesce('{kind}:' || CAST({c} AS VARCHAR), 'null')"

    start = ", ".join([tag("i", "frame"), tag("f", "team"), tag("i", "unitId"), tag("i", "cmd_id"),
                       tag("i", "code"), tag("i", "cmd_tag"), tag("i", "target_unit_id"),
                       tag("i", "x")])
    rest = ", ".join([tag("i", "y"), tag("i", "z")])
    return with_aspects(f""",
  r AS (SELECT *, row_ord % 11 AS fault,
               CAST(teamId AS DOUBLE) + CASE WHEN row_ord % 11 IN (3, 5) THEN 0.5 ELSE 0 END AS team,
               CASE WHEN row_ord % 11 IN (4, 5) THEN 99 ELSE {code} END AS code
        FROM a_commands_log)
SELECT replay_id,
       CASE fault WHEN 1 THEN 'y: required value missing; z: required value missing'
                  WHEN 2 THEN 'commands_log: 10 fields, got 11'
                  WHEN 3 THEN 'teamId: expected integer'
                  WHEN 4 THEN 'cmd_name: unknown CommandsEnum code 99'
                  WHEN 5 THEN 'teamId: expected integer; cmd_name: unknown CommandsEnum code 99'
                  ELSE '' END AS reason,
       CASE WHEN fault = 1 THEN concat_ws('|', {start})
            WHEN fault = 2 THEN concat_ws('|', {start}, {rest}, 'i:1')
            WHEN fault IN (3, 4, 5) THEN concat_ws('|', {start}, {rest})
            ELSE concat_ws('|', frame, teamId, unitId, cmd_id, cmd_name, x, y) END AS row
FROM r""", "commands_log")


def _all_ingested() -> dict[str, str]:
    from tickframe.plans.catalog import INGESTED
    return {**{f"ingest_{a}": _ingested(a) for a in INGESTED},
            **{f"ingest_mpk_{a}": _ingested(a) for a in INGESTED},
            "ingest_layer_damage_log": _ingested("damage_log"),
            "ingest_quarantine": _quarantined()}


EXTRA_SQL.update(_all_ingested())
EXTRA_SQL["sink_row_major_army_value_timeline"] = EXTRA_SQL["out_army_value_timeline"]
EXTRA_SQL["sink_columnar_unit_economic_contribution_binned"] = \
    EXTRA_SQL["out_unit_economic_contribution_binned"]
EXTRA_SQL["sink_columnar_force_composition_timeline"] = STATS_SQL["force_composition_timeline"]
EXTRA_SQL["sink_columnar_start_pos"] = with_aspects(
    "SELECT * EXCLUDE (row_ord) FROM a_start_pos", "start_pos")
EXTRA_SQL["sink_parquet_index"] = EXTRA_SQL["sink_jsonl_index"] = with_aspects(
    'SELECT replay_id, count(*) AS "rows" FROM a_damage_log GROUP BY replay_id', "damage_log")
EXTRA_SQL["sink_hybrid"] = f"""
SELECT 'army_value_timeline' AS stream, replay_id,
       concat_ws('|', frame, team_id, army_value) AS row
FROM ({EXTRA_SQL["out_army_value_timeline"]}) a
UNION ALL
SELECT 'start_pos', replay_id, concat_ws('|', player_id, player_name, commander_def_name,
                                         unit_def_id, x, y, z)
FROM ({EXTRA_SQL["sink_columnar_start_pos"]}) s
UNION ALL
SELECT 'force_composition_timeline', replay_id, concat_ws('|', player_id, minute, unit_stats)
FROM ({STATS_SQL["force_composition_timeline"]}) f"""


# --------------------------------------------------------------------------- whole runs
def _run_sql(names: list[str]) -> str:
    """Rows of each output and replay of a run, and the sum of 32 bits of their digests."""
    from tickframe.plans.catalog import run_columns, run_digits
    parts = []
    for name in names:
        sql = STATS_SQL.get(name) or EXTRA_SQL[name]
        digits = run_digits(name)
        texts = [f"coalesce(CAST({_scaled(c, digits[c])} AS VARCHAR), '~')" if c in digits else
                 f"coalesce(CAST({c} AS VARCHAR), '~')" for c in run_columns(name)]
        replay = "CAST(NULL AS BIGINT)" if name == "vw_first_appearance_summary" else "replay_id"
        parts.append(f"SELECT '{name}' AS output, {replay} AS replay_id, "
                     f"concat_ws('|', {', '.join(texts)}) AS row\nFROM ({sql}) t")
    rows = "\nUNION ALL\n".join(parts)
    return f"""
SELECT output, replay_id, count(*) AS "rows",
       CAST(sum(CAST('0x' || substr(md5(row), 1, 8) AS BIGINT)) AS BIGINT) AS digest
FROM ({rows}) GROUP BY ALL"""


def _scaled(column: str, digits: int) -> str:
    return f"CAST(round({column} * CAST({10 ** digits} AS DOUBLE), 0) AS BIGINT)"


def _runs() -> dict[str, str]:
    from tickframe.plans import registry
    return {"run_default_stats": _run_sql(registry.default_stats()),
            "run_views": _run_sql(list(registry.VIEWS))}


EXTRA_SQL.update(_runs())
