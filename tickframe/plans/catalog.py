"""Registered queries for the derived views (VW), recipes (RC) and the
data-quality report (DQ), in the ``(spark, sf_dir) -> DataFrame`` form.

``DIGITS`` lists float columns and the decimals both this side and the
oracle round to; ``RENDER`` lists array columns rendered as strings.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import name_to_code
from ..schemas import ASPECTS
from ..scratch import scratch_path, stored
from ..sinks import bundle
from ..sinks import contracts as C
from ..sinks import writers as W
from ..sources import adapters, mpk_split, qualified, scan
from ..streaming import jobs as streams
from . import checks, recipes, registry, stats, views
from .views import BIN

INGESTED = ("damage_log", "commands_log", "unit_positions", "unit_events", "unit_economy",
            "team_stats", "start_pos", "map_envir_econ", "unit_state_snapshots",
            "construction_log")
ECON = ["unit_economy", "unit_events"]
_BIN_METRICS_PRE = ("total_unit_seconds_in_bin", "total_metal_produced_in_bin",
                    "total_metal_consumed_in_bin", "total_energy_produced_in_bin",
                    "total_energy_consumed_in_bin")


def _binned(spark, sf_dir) -> DataFrame:
    return stats.unit_economic_contribution_binned(adapters.load(spark, sf_dir, *ECON))


def _view(fn, **kw):
    return lambda spark, sf_dir: fn(_binned(spark, sf_dir), **kw)


def _grid(fn, **kw):
    """A view that reads the binned economy several times; it is stored once."""
    return lambda spark, sf_dir: fn(stored(_binned(spark, sf_dir), "binned"), **kw)


def _tables(fn, aspects, **kw):
    return lambda spark, sf_dir: fn(adapters.load(spark, sf_dir, *aspects), **kw)


def _children(c: str):
    return F.array_join(F.transform(F.col(c), lambda s: F.concat(
        s["unit_def_id"].cast("string"), F.lit(":"),
        F.round(s["value"] * F.lit(100.0), 0).cast("long").cast("string"))), ",").alias(c)


def _contracted(stream: str, build, pre_digits: dict[str, int] | None = None):
    """A stream through its output contract and null encoding (OUT-1..8).
    ``pre_digits`` rounds float inputs first so both engines quantize the same
    double."""
    def run(spark, sf_dir):
        df = build(spark, sf_dir)
        if pre_digits:
            df = _rounded(df, pre_digits)
        c = C.CONTRACTS[stream]
        return C.encode_nulls(C.apply_contract(df, c), c).drop("row_ord")
    return run


def _stat(fn, aspects, **kw):
    return lambda spark, sf_dir: fn(adapters.load(spark, sf_dir, *aspects), **kw)


def _streamed(aspect: str, job, closed: bool = False):
    """Run a streaming job over an aspect derived from the driver tables: the
    aspect is written as files under the session's checkpoint dir, read as a file
    stream in three micro-batches (``availableNow``), and the job's result read;
    with ``closed`` all replays have ended before."""
    def run(spark, sf_dir):
        src = adapters.load(spark, sf_dir, aspect)[aspect]
        root = scratch_path(spark, f"stream-{aspect}")
        # the tasks of the scan write, and a micro-batch reads a third of their files
        files = max(3, src.rdd.getNumPartitions())
        (src if files > 3 else src.repartition(3)).write.parquet(f"{root}/in")
        source = streams.read_aspect_stream(spark, f"{root}/in", src.schema,
                                            max_files=-(-files // 3))
        q = streams.start(job, source, f"{root}/out", name=f"q{root.rsplit('-', 1)[1][:12]}",
                          available_now=True, checkpoint=f"{root}/ckpt")
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if closed:
            streams.close_replays(job, spark, f"{root}/out", src.select("replay_id"))
        return streams.result(job, spark, f"{root}/out")
    return run


def _positional(aspect: str) -> list[Column]:
    """An aspect's columns as its raw records have them: quantized integers and enum codes."""
    out = []
    for f in ASPECTS[aspect]:
        c = F.col(f.name)
        if f.divisor is not None:
            c = F.floor(c * F.lit(f.divisor)).cast("long")
        if f.enum is not None:
            c = name_to_code(c, f.enum)
        out.append(c.alias(f.name))
    return out


def _ingest(aspect: str):
    """Round trip through the positional ingest path: the adapted aspect is
    encoded as raw positional records (quantized integers, untagged tokens),
    written as Parquet under the checkpoint dir, then decoded and bound by the
    scan (ING-1..7).  ``row_ord`` is dropped (it restarts in the new files)."""
    def run(spark, sf_dir):
        src = adapters.load(spark, sf_dir, aspect)[aspect]
        root = scratch_path(spark, f"ingest-{aspect}")
        src.select("replay_id", F.array(*[c.cast("string") for c in _positional(aspect)])
                   .alias("vals")).write.parquet(root)
        raw = scan.positional_parquet(spark, root, aspect=aspect, replay_column="replay_id")
        clean, _ = scan.bind(raw, aspect)
        return clean.drop("row_ord").withColumn("replay_id", F.col("replay_id").cast("long"))
    return run


def _ingest_mpk(aspect: str):
    """The adapted aspect as MessagePack files, read back by byte ranges (SRC-2)."""
    def run(spark, sf_dir):
        src = adapters.load(spark, sf_dir, aspect)[aspect]
        root = scratch_path(spark, f"mpk-{aspect}")
        mpk_split.write(src.select("replay_id", *_positional(aspect)),
                        [f.name for f in ASPECTS[aspect]], aspect, root)
        clean, _ = scan.bind(scan.read_raw(spark, [root], [aspect]), aspect)
        return clean.drop("row_ord").withColumn("replay_id", F.col("replay_id").cast("long"))
    return run


def _ingest_quarantine(spark, sf_dir):
    """Command records, some too short, too long, mistyped or with unknown codes,
    through one decode: accepted and rejected rows with kind and reason (ING-3)."""
    aspect = "commands_log"
    fault = F.col("row_ord") % 11
    src = adapters.load(spark, sf_dir, aspect)[aspect]
    rows = src.select(
        "replay_id", *[c for c in _positional(aspect)], "row_ord").withColumn(
        "teamId", F.col("teamId") + F.when(fault.isin(3, 5), 0.5).otherwise(0.0)).withColumn(
        "cmd_name", F.when(fault.isin(4, 5), 99).otherwise(F.col("cmd_name"))).withColumn(
        "more", F.lit(1)).withColumn(
        "size", F.when(fault == 1, 8).when(fault == 2, 11).otherwise(10))
    root = scratch_path(spark, "mpk-faults")
    mpk_split.write(rows, [*(f.name for f in ASPECTS[aspect]), "more"], aspect, root, "size")
    clean, bad = scan.split_once(scan.read_raw(spark, [root], [aspect]), aspect,
                                 scratch_path(spark, "split"))
    shown = F.concat_ws("|", *[F.col(c).cast("string") for c in (
        "frame", "teamId", "unitId", "cmd_id", "cmd_name", "x", "y")])
    return clean.select("replay_id", F.lit("").alias("reason"), shown.alias("row")).unionByName(
        bad.select("replay_id", "reason", F.col("raw").alias("row"))).withColumn(
        "replay_id", F.col("replay_id").cast("long"))


def _ingest_layer(spark, sf_dir):
    """The damage log through the qualified layer: even replays first, then all (ING-9)."""
    aspect = "damage_log"
    src = adapters.load(spark, sf_dir, aspect)[aspect]
    root, layer = scratch_path(spark, "mpk-layer"), scratch_path(spark, "layer")
    kept = qualified.Layer(spark, layer)
    for part in (0, 1):
        mpk_split.write(src.where(F.col("replay_id") % 2 == part).select(
            "replay_id", *_positional(aspect)), [f.name for f in ASPECTS[aspect]], aspect,
            f"{root}/{part}")
        kept.update([root], [aspect])
    tables, _ = kept.read([root], [aspect])
    return tables[aspect].drop("row_ord").withColumn("replay_id", F.col("replay_id").cast("long"))


def _row_major_roundtrip(stream: str, build, pre_digits: dict[str, int] | None = None):
    """Contracted stream -> row-major zstd chunks -> decoded rows (SNK-3)."""
    def run(spark, sf_dir):
        df = build(spark, sf_dir)
        if pre_digits:
            df = _rounded(df, pre_digits)
        prepared = W.prepare(df, stream)
        dtype = W.row_major_dtype(prepared)
        chunks = W.pack_row_major(prepared, stream, ("frame", "team_id"))
        # unsigned columns come back as the wider Spark types the contract uses
        schema = T.StructType([T.StructField(n, T.LongType() if np.dtype(dtype[n]).kind in "iu"
                                             else T.DoubleType()) for n in dtype.names])
        rows = W.read_row_major(chunks, stream, dtype, schema)
        return rows.select(F.col("replay_id").cast("long").alias("replay_id"),
                           *[F.col(n) for n in dtype.names])
    return run


def _columnar_roundtrip(stream: str, build, pre_digits: dict[str, int] | None = None):
    """Contracted stream -> columnar zstd chunks -> decoded rows (SNK-4/5)."""
    def run(spark, sf_dir):
        df = build(spark, sf_dir)
        if pre_digits:
            df = _rounded(df, pre_digits)
        prepared = W.prepare(df, stream)
        cols = [(f.name, W._logical(f)) for f in prepared.schema.fields
                if f.name not in ("replay_id", "row_ord")]
        chunks = W.pack_columnar(prepared, stream, ("time_bin_start_frame", "team_id",
                                                    "unit_def_id"))
        rows = W.read_columnar(chunks, stream, cols)
        return rows.select(F.col("replay_id").cast("long").alias("replay_id"),
                           *[F.col(n) for n, _ in cols])
    return run


def _nested_roundtrip(stream: str, build, order: tuple[str, ...]):
    """Strings and lists of structs through columnar chunks with rebased offsets (SNK-5)."""
    def run(spark, sf_dir):
        df = build(spark, sf_dir)
        chunks = W.rebase(W.pack_columnar(df, stream, order))
        columns = [(f.name, C.logical_type(f.dataType), f.dataType) for f in df.schema.fields
                   if f.name not in C.INTERNAL]
        rows = W.read_columnar(chunks, stream, columns).select(
            F.col("replay_id").cast("long").alias("replay_id"), *[n for n, _, _ in columns])
        return rows.select(*[_unit_stats(c) if c == "unit_stats" else F.col(c)
                             for c in rows.columns])
    return run


def _hybrid_roundtrip(spark, sf_dir):
    """A bundle of a row-major, a columnar and a nested stream with assets, written, and each
    stream opened again by the header alone (SNK-6); rows as text."""
    tables = adapters.load(spark, sf_dir, "unit_events", "defs_map", "unit_defs", "start_pos")
    streams_ = {
        "army_value_timeline": _rounded(stats.army_value_timeline(tables), {"army_value": 4}),
        "start_pos": tables["start_pos"],
        "force_composition_timeline": stats.force_composition_timeline(tables)}
    path = scratch_path(spark, "bundle")
    bundle.write_bundle(bundle.hybrid_bundle(streams_, defs=tables["defs_map"], orders={
        "army_value_timeline": ["frame", "team_id"], "start_pos": ["player_id"],
        "force_composition_timeline": ["minute", "player_id"]}), path)
    out = None
    for name in streams_:
        df = bundle.read_stream(spark, path, name)
        columns = [c["name"] for c in bundle.stream_document(spark, path, name)["columns"]]
        df = df.select(*[_unit_stats(c) if c == "unit_stats" else F.col(c).cast("string")
                         for c in ["replay_id", *columns]])
        part = df.select(F.lit(name).alias("stream"), F.col("replay_id").cast("long"),
                         F.concat_ws("|", *columns).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def _replay_index(form: str):
    """The damage log in files by size, and its index: rows of each replay (SNK-1/2)."""
    def run(spark, sf_dir):
        path = scratch_path(spark, f"files-{form}")
        write = W.write_parquet if form == "parquet" else W.write_jsonl_gz
        write({"damage_log": adapters.load(spark, sf_dir, "damage_log")["damage_log"]}, path,
              orders={"damage_log": ["frame", "row_ord"]})
        return spark.read.parquet(f"{path}/damage_log/{W.INDEX}").groupBy("replay_id").agg(
            F.sum("rows").alias("rows"))
    return run


#: Decimals that rows of a whole run are compared at (besides ``DIGITS``).
RUN_DIGITS: dict[str, dict[str, int]] = {
    "damage_by_unit_def": {"total_damage_dealt": 4},
    "resources_by_player": {c: 2 for c in ("total_metal_produced", "total_metal_used",
                                           "total_energy_produced", "total_energy_used")},
    "player_economic_efficiency": {c: 6 for c in (
        "total_metal_spent", "total_energy_spent", "total_damage_output",
        "damage_per_resource_unit")},
    "player_collaboration": {c: 6 for c in (
        "total_metal_sent", "total_metal_received", "total_energy_sent", "total_energy_received",
        "net_metal_contribution", "net_energy_contribution")},
    "aggression_by_unit": {"aggression_score": 6},
    "calculate_player_apm_and_focus": {"combat_focus_pct": 6, "economy_focus_pct": 6},
    "map_control_timeline": {"dispersion_x": 6, "dispersion_y": 6},
    "combat_engagement_summary_default": {"location_x": 6, "location_y": 6, "total_damage": 4,
                                          "duration_seconds": 6},
    "army_value_timeline": {"army_value": 4},
    "unit_economic_contribution_binned": {c: 4 for c in _BIN_METRICS_PRE},
}
#: Columns of a whole run's outputs, in the order they are written to a row.
RUN_COLUMNS = {
    "vw_net_metal_by_time_team": (BIN, "team_id", "net_metal"),
    "vw_metal_by_time_def": ("team_id", BIN, "unit_def_id", "metal_produced"),
    "vw_build_order_events": ("team_id", BIN, "unit_def_id", "total_units_produced_in_bin"),
    "vw_net_metal_heatmap": ("team_id", "time_index", "unit_index", BIN, "unit_def_id",
                             "net_metal", "min_value", "max_value"),
    "vw_economic_flow_edges": ("team_id", "unit_def_id", "direction", "value"),
    "vw_small_multiples": ("team_id", BIN, "unit_def_id", "metal_produced"),
    "vw_composition_snapshot": ("team_id", BIN, "unit_def_id", "metal_produced"),
    "vw_build_order_transitions": ("team_id", "source_def_id", "target_def_id", "transitions"),
    "vw_producer_consumer_hierarchy": ("team_id", "role", "children"),
    "vw_economic_rhythm": ("team_id", BIN, "metal_produced", "energy_produced", "units_produced"),
    "vw_first_appearance_summary": ("team_id", "unit_def_id", "replays", "t_min", "t_q1",
                                    "t_median", "t_q3", "t_max"),
    "vw_lag_correlation": ("lag", "correlation", "pairs"),
    "vw_resource_tradeoff": (BIN, "team_id", "unit_def_id", "net_metal", "net_energy",
                             "units_alive"),
    "vw_sankey_fold": ("team_id", "unit_def_id", "production", "consumption"),
    "vw_longest_surplus": ("team_id", "unit_def_id", "run_start", "run_bins"),
    "unit_economic_contribution_binned": (
        "team_id", "unit_def_id", BIN, "units_alive_in_bin", "total_units_produced_in_bin",
        *_BIN_METRICS_PRE),
}


def run_columns(name: str) -> tuple[str, ...]:
    """Columns of an output without ``replay_id``."""
    if name in RUN_COLUMNS:
        return RUN_COLUMNS[name]
    ddl = registry.STATS[name].schema
    while "<" in ddl:
        ddl = re.sub(r"<[^<>]*>", "", ddl)
    return tuple(part.split()[0] for part in ddl.split(","))


def run_digits(name: str) -> dict[str, int]:
    return RUN_DIGITS.get(name) or DIGITS.get(name, {})


def _row_text(name: str, df: DataFrame) -> DataFrame:
    """An output as rows (output, replay_id, row); doubles as integers at their decimals."""
    digits, parts = run_digits(name), []
    render = {**RENDER.get(name, {}), "involved_players": _numbers, "unit_stats": _unit_stats}
    df = df.select(*[render[c](c) if c in render else F.col(c) for c in df.columns])
    for c in run_columns(name):
        if c in digits:
            scaled = F.round(F.round(F.col(c) * float(10 ** digits[c]), 0)
                             / float(10 ** digits[c]) * float(10 ** digits[c]), 0)
            parts.append(F.coalesce(scaled.cast("long").cast("string"), F.lit("~")))
        else:
            parts.append(F.coalesce(F.col(c).cast("string"), F.lit("~")))
    replay = F.col("replay_id") if "replay_id" in df.columns else F.lit(None).cast("long")
    return df.select(F.lit(name).alias("output"), replay.alias("replay_id"),
                     F.concat_ws("|", *parts).alias("row"))


def _numbers(c: str):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",").alias(c)


def _unit_stats(c: str):
    return F.array_join(F.transform(F.col(c), lambda s: F.concat(
        s["unit_def_id"].cast("string"), F.lit(":"), s["units_produced"].cast("string"))),
        ",").alias(c)


def _whole_run(stats_of):
    """All outputs of one run with shared inputs: the number of rows of each output and
    replay, and the sum of the first 32 bits of their rows' digests.  An output that
    fails fails the query."""
    def run(spark, sf_dir):
        outputs, _ = registry.run(adapters.load(spark, sf_dir), stats_of(), [])
        outputs.check()
        rows = None
        for name, df in outputs.items():
            part = _row_text(name, df)
            rows = part if rows is None else rows.unionByName(part)
        digest = F.conv(F.substring(F.md5(F.col("row").cast("binary")), 1, 8), 16, 10)
        return rows.groupBy("output", "replay_id").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(digest.cast("long")).alias("digest"))
    return run


def _defs_lookup(spark, sf_dir):
    rows = C.lookup_rows(adapters.defs_map(spark, sf_dir))
    return rows.select("key", F.array_join("values", "|").alias("values"))


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "vw_net_metal_by_time_team": _grid(views.net_metal_by_time_team),
    "vw_metal_by_time_def": _grid(views.metal_by_time_def),
    "vw_build_order_events": _view(views.build_order_events),
    "vw_net_metal_heatmap": _grid(views.net_metal_heatmap),
    "vw_economic_flow_edges": _view(views.economic_flow_edges),
    "vw_small_multiples": _grid(views.small_multiples),
    "vw_composition_snapshot": _view(views.composition_snapshot),
    "vw_build_order_transitions": _view(views.build_order_transitions),
    "vw_producer_consumer_hierarchy": _view(views.producer_consumer_hierarchy),
    "vw_economic_rhythm": _view(views.economic_rhythm),
    "vw_first_appearance_summary": _view(views.first_appearance_summary),
    "vw_lag_correlation": _grid(views.lag_correlation, team_a=0, team_b=1),
    "vw_resource_tradeoff": _view(views.resource_tradeoff),
    "vw_sankey_fold": _view(views.sankey_by_fold),
    "vw_longest_surplus": _view(views.longest_surplus),
    "rc_units_lost_per_player": _tables(recipes.units_lost_per_player, ["unit_events"]),
    "rc_unified_event_log": _tables(recipes.unified_event_log, ["unit_events", "commands_log"]),
    "rc_unit_lifetime": _tables(recipes.unit_lifetime, ["unit_positions", "unit_events"]),
    "rc_damage_location": _tables(recipes.damage_location, ["unit_positions", "damage_log"]),
    "rc_commands_with_team_state": _tables(recipes.commands_with_team_state,
                                           ["commands_log", "team_stats"]),
    "rc_damage_with_attacker_type": _tables(recipes.damage_with_attacker_type,
                                            ["damage_log", "unit_events"]),
    "rc_move_commands": _tables(recipes.commands_named, ["commands_log"], name="MOVE"),
    "rc_resources_at_death": _tables(recipes.resources_at_death, ["unit_events", "team_stats"]),
    "rc_command_codes_with_unknown": _tables(recipes.command_codes_with_unknown, ["commands_log"]),
    "out_army_value_timeline": _contracted(
        "army_value_timeline",
        _stat(stats.army_value_timeline, ["unit_events", "defs_map", "unit_defs"]),
        {"army_value": 4}),
    "out_unit_events": _contracted("unit_events", _stat(stats.passthrough("unit_events"),
                                                        ["unit_events"])),
    "out_unit_positions": _contracted("unit_positions", _stat(stats.passthrough("unit_positions"),
                                                              ["unit_positions"])),
    "out_team_stats": _contracted("team_stats", _stat(stats.passthrough("team_stats"),
                                                      ["team_stats"])),
    "out_unit_economic_contribution_binned": _contracted(
        "unit_economic_contribution_binned",
        _stat(stats.unit_economic_contribution_binned, ECON),
        {c: 4 for c in _BIN_METRICS_PRE}),
    "out_defs_lookup": _defs_lookup,
    "sink_columnar_unit_economic_contribution_binned": _columnar_roundtrip(
        "unit_economic_contribution_binned", _stat(stats.unit_economic_contribution_binned, ECON),
        {c: 4 for c in _BIN_METRICS_PRE}),
    "sink_row_major_army_value_timeline": _row_major_roundtrip(
        "army_value_timeline",
        _stat(stats.army_value_timeline, ["unit_events", "defs_map", "unit_defs"]),
        {"army_value": 4}),
    "sink_columnar_force_composition_timeline": _nested_roundtrip(
        "force_composition_timeline", _stat(stats.force_composition_timeline, ["unit_events"]),
        ("minute", "player_id")),
    "sink_columnar_start_pos": _nested_roundtrip(
        "start_pos", _stat(stats.passthrough("start_pos"), ["start_pos"]), ("player_id",)),
    "sink_hybrid": _hybrid_roundtrip,
    "sink_parquet_index": _replay_index("parquet"),
    "sink_jsonl_index": _replay_index("json"),
    "resources_by_player_final": _stat(stats.resources_by_player, ["team_stats"], final=True),
    "unit_economic_contribution_binned_left": _stat(
        stats.unit_economic_contribution_binned, ECON, production_only_bins=False,
        include_bin_end=True),
    "army_value_timeline_dedupe": _stat(stats.army_value_timeline,
                                        ["unit_events", "defs_map", "unit_defs"], dedupe=True),
    "ss_minute_activity": _streamed("commands_log", streams.MINUTE_ACTIVITY),
    "ss_unit_engagements": _streamed("damage_log", streams.unit_engagements()),
    "ss_binned_production": _streamed("unit_events", streams.binned_production()),
    "ss_unit_engagements_closed": _streamed("damage_log", streams.unit_engagements(), True),
    **{f"ingest_{a}": _ingest(a) for a in INGESTED},
    **{f"ingest_mpk_{a}": _ingest_mpk(a) for a in INGESTED},
    "ingest_quarantine": _ingest_quarantine,
    "ingest_layer_damage_log": _ingest_layer,
    "run_default_stats": _whole_run(registry.default_stats),
    "run_views": _whole_run(lambda: list(registry.VIEWS)),
    "dq_report": _tables(checks.quality_report, [*checks.FRAMED, "start_pos"]),
}

DIGITS: dict[str, dict[str, int]] = {
    "ss_unit_engagements": {"total_damage": 4, "duration_seconds": 6},
    "ss_unit_engagements_closed": {"total_damage": 4, "duration_seconds": 6},
    "ss_minute_activity": {"combat_focus_pct": 6, "economy_focus_pct": 6},
    "resources_by_player_final": {c: 4 for c in ("total_metal_produced", "total_metal_used",
                                                 "total_energy_produced", "total_energy_used")},
    "unit_economic_contribution_binned_left": {c: 4 for c in _BIN_METRICS_PRE},
    "army_value_timeline_dedupe": {"army_value": 4},
    "vw_net_metal_by_time_team": {"net_metal": 4},
    "vw_metal_by_time_def": {"metal_produced": 4},
    "vw_net_metal_heatmap": {"net_metal": 4, "min_value": 4, "max_value": 4},
    "vw_economic_flow_edges": {"value": 4},
    "vw_small_multiples": {"metal_produced": 4},
    "vw_composition_snapshot": {"metal_produced": 4},
    "vw_economic_rhythm": {"metal_produced": 4, "energy_produced": 4},
    "vw_first_appearance_summary": {c: 6 for c in ("t_min", "t_q1", "t_median", "t_q3", "t_max")},
    "vw_lag_correlation": {"correlation": 6},
    "vw_resource_tradeoff": {"net_metal": 4, "net_energy": 4},
    "vw_sankey_fold": {"production": 4, "consumption": 4},
    "rc_damage_with_attacker_type": {"damage": 6},
    "rc_damage_location": {"damage": 6},
    "rc_commands_with_team_state": {c: 6 for c in ("metal_current", "energy_current",
                                                    "metal_income", "energy_income")},
    "rc_resources_at_death": {"metal_current": 6, "energy_current": 6},
}

RENDER = {"vw_producer_consumer_hierarchy": {"children": _children}}


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    def r(c, d):
        scale = float(10 ** d)
        return (F.round(F.col(c) * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)).alias(c)
    return df.select(*[r(c, digits[c]) if c in digits else F.col(c) for c in df.columns])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, build in BUILDERS.items():
        def run(spark, sf_dir, _b=build, _n=name):
            df = _b(spark, sf_dir)
            render = RENDER.get(_n, {})
            if render:
                df = df.select(*[render[c](c) if c in render else F.col(c) for c in df.columns])
            return _rounded(df, DIGITS.get(_n, {}))
        out[name] = run
    return out
