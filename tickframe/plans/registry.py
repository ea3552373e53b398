"""Stats and streams that a run can compute, and the run itself.

A ``Stat`` is a function ``tables -> DataFrame`` with what it needs (tables and
their columns, parameters) and what it returns (``schema``), both checked before
any job starts.  A ``Registry`` holds stats and streams; ``with_stat`` adds one
of your own, ``variant`` one with other parameters, and ``run`` takes any
registry.

``run`` shares work between the requested outputs:

* declared rollups over one aspect and key (``Stat.rollup``) become one group-by;
* a table that several of them read is stored once, with the columns they need;
* an output that others read (``stat:<name>`` among their inputs) is stored once.

A failure of one output, while its plan is built or its inputs are stored, is
logged and kept in ``Outputs.failed``; the others still run.  A caller that wants
all of them or none calls ``Outputs.check``.
"""

from __future__ import annotations

import inspect
import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rollup import Rollup, aggregate_together
from ..schemas import ASPECT_NAMES
from ..scratch import drop, stored
from . import stats as S
from . import views as V

log = logging.getLogger(__name__)

#: An input with this prefix is the output of another stat.
OUTPUT = "stat:"


class StatError(ValueError):
    """A stat that does not fit its declaration."""


@dataclass(frozen=True)
class Stat:
    """``columns`` lists the columns read of each input; a name with ``?`` may be missing.

    Inputs without an entry are read whole.  ``schema`` is the result's DDL
    without ``replay_id``; ``None`` leaves it open.
    """

    func: Callable[[dict[str, DataFrame]], DataFrame]
    description: str
    default_enabled: bool = False
    inputs: tuple[str, ...] = ()
    sort: tuple[tuple[str, bool], ...] = field(default=())  # (column, descending)
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    schema: str | None = None
    rollup: Rollup | None = None


def _asc(*cols):
    return tuple((c, False) for c in cols)


_DAMAGE = ("frame", "victim_pos_x", "victim_pos_y", "attacker_team_id", "damage")
_RATES = ("metal_make?", "metal_use?", "energy_make?", "energy_use?")
_ECONOMY = ("unit_id", "team_id", "unit_def_id", "frame", "row_ord", *_RATES)
_SUMMARY = ("start_frame long, end_frame long, location_x double, location_y double, "
            "involved_players array<long>, total_damage double, duration_seconds double")

STATS: dict[str, Stat] = {
    "damage_by_unit_def": Stat(
        S.damage_by_unit_def, "Total damage dealt per attacker unit definition.", True,
        ("damage_log",), (("total_damage_dealt", True),),
        {"damage_log": ("attacker_def_id", "damage")},
        "unit_def_id long, total_damage_dealt double"),
    "resources_by_player": Stat(
        S.resources_by_player, "Metal/energy produced and used per team.", True,
        ("team_stats",), _asc("team_id"),
        {"team_stats": ("team_id", "metal_produced", "metal_used", "energy_produced",
                        "energy_used")},
        "team_id long, total_metal_produced double, total_metal_used double, "
        "total_energy_produced double, total_energy_used double", S.team_totals()),
    "player_economic_efficiency": Stat(
        S.player_economic_efficiency, "End-of-game damage per resource spent.", True,
        ("team_stats",), (("damage_per_resource_unit", True),),
        {"team_stats": ("team_id", "metal_used", "energy_used", "damage_dealt")},
        "player_id long, total_metal_spent double, total_energy_spent double, "
        "total_damage_output double, damage_per_resource_unit double", S.ECONOMIC_EFFICIENCY),
    "player_collaboration": Stat(
        S.player_collaboration, "Resource sharing: net donors and receivers.", True,
        ("team_stats",), (("net_metal_contribution", True),),
        {"team_stats": ("team_id", "metal_sent", "metal_received", "energy_sent",
                        "energy_received")},
        "player_id long, total_metal_sent double, total_metal_received double, "
        "total_energy_sent double, total_energy_received double, net_metal_contribution double, "
        "net_energy_contribution double", S.COLLABORATION),
    "aggression_by_unit": Stat(
        S.aggression_by_unit, "Distance-over-time from each unit's start position.", True,
        ("unit_positions",), (("aggression_score", True),),
        {"unit_positions": ("unit_id", "frame", "row_ord", "x", "y")},
        "unit_id long, aggression_score double"),
    "calculate_player_apm_and_focus": Stat(
        S.calculate_player_apm_and_focus, "Actions per minute and combat/economy focus.", True,
        ("commands_log",), _asc("player_id", "minute"),
        {"commands_log": ("teamId", "frame", "cmd_name")},
        "player_id long, minute int, actions_per_minute long, combat_focus_pct double, "
        "economy_focus_pct double"),
    "map_control_timeline": Stat(
        S.map_control_timeline, "Bounding box and dispersion of units per minute.", True,
        ("unit_positions",), _asc("player_id", "minute"),
        {"unit_positions": ("team_id", "frame", "x", "y")},
        "player_id long, minute int, bounding_box_area long, dispersion_x double, "
        "dispersion_y double"),
    "force_composition_timeline": Stat(
        S.force_composition_timeline, "Units produced per type, per player, per minute.", True,
        ("unit_events",), _asc("player_id", "minute"),
        {"unit_events": ("event_type", "unit_team_id", "frame", "unit_def_id")},
        "player_id long, minute int, unit_stats array<struct<unit_def_id: long, "
        "units_produced: long>>"),
    "combat_engagement_summary_default": Stat(
        partial(S.combat_engagement_summary_spatiotemporal, lull_seconds=10.0,
                spatial_threshold=500.0),
        "Engagements clustered by time and victim position.", True,
        ("damage_log",), _asc("start_frame"),
        {"damage_log": ("attacker_unit_id", "row_ord", *_DAMAGE)},
        f"engagement_id long, {_SUMMARY}"),
    "combat_engagement_summary_global": Stat(
        partial(S.combat_engagement_summary_global, lull_seconds=10.0),
        "Engagements by replay-wide time gaps only.", False,
        ("damage_log",), _asc("start_frame"), {"damage_log": _DAMAGE},
        f"engagement_id long, {_SUMMARY}"),
    "combat_engagement_summary_per_unit": Stat(
        partial(S.combat_engagement_summary_per_unit, lull_seconds=15.0),
        "Each attacker unit's separate encounters.", False,
        ("damage_log",), _asc("start_frame"),
        {"damage_log": ("attacker_unit_id", "row_ord", *_DAMAGE)},
        f"engagement_id string, {_SUMMARY}"),
    "crisis_response_index": Stat(
        S.crisis_response_index, "Reaction time when a player's units are attacked.", True,
        ("damage_log", "commands_log", "unit_events"), _asc("crisis_id"),
        {"damage_log": ("victim_unit_id", "victim_team_id", "frame", "row_ord"),
         "commands_log": ("cmd_name", "teamId", "frame"),
         "unit_events": ("event_type", "unit_id", "frame", "row_ord")},
        "player_id long, crisis_id long, victim_unit_id long, crisis_start_frame long, "
        "time_to_response_frames long, asset_survived boolean"),
    "army_value_timeline": Stat(
        S.army_value_timeline, "Army metal value per team at fixed intervals.", True,
        ("unit_events", "defs_map", "unit_defs"), _asc("frame", "team_id"),
        {"unit_events": ("event_type", "unit_id", "unit_def_id", "unit_team_id", "frame",
                         "row_ord"),
         "defs_map": ("unit_def_id", "unit_name"), "unit_defs": ("unit_name", "metalcost")},
        "frame long, team_id long, army_value double"),
    "unit_economic_contribution": Stat(
        S.unit_economic_contribution, "Net contribution and lifetime per unit type.", False,
        ("unit_economy",), _asc("team_id", "unit_def_id"), {"unit_economy": _ECONOMY}),
    "unit_economic_contribution_binned": Stat(
        S.unit_economic_contribution_binned, "Per-bin economy per unit type.", True,
        ("unit_economy", "unit_events"), _asc("time_bin_start_frame", "team_id", "unit_def_id"),
        {"unit_economy": _ECONOMY,
         "unit_events": ("event_type", "unit_id", "unit_def_id", "unit_team_id", "frame")}),
}

BINNED = OUTPUT + "unit_economic_contribution_binned"


def _view(func: Callable[..., DataFrame], description: str, **params) -> Stat:
    return Stat(lambda tables: func(tables[BINNED], **params), description, False, (BINNED,))


#: Derived views; all of them read one stored output of the binned economy.
VIEWS: dict[str, Stat] = {
    "vw_net_metal_by_time_team": _view(V.net_metal_by_time_team, "Net metal per bin and team."),
    "vw_metal_by_time_def": _view(V.metal_by_time_def, "Metal produced per bin and definition."),
    "vw_build_order_events": _view(V.build_order_events, "Production events."),
    "vw_net_metal_heatmap": _view(V.net_metal_heatmap, "Net metal heatmap cells."),
    "vw_economic_flow_edges": _view(V.economic_flow_edges, "Producer and consumer edges."),
    "vw_small_multiples": _view(V.small_multiples, "Metal per definition over all bins."),
    "vw_composition_snapshot": _view(V.composition_snapshot, "Metal by definition in each bin."),
    "vw_build_order_transitions": _view(V.build_order_transitions, "Production transitions."),
    "vw_producer_consumer_hierarchy": _view(V.producer_consumer_hierarchy, "Roles of units."),
    "vw_economic_rhythm": _view(V.economic_rhythm, "Production per bin and team."),
    "vw_first_appearance_summary": _view(V.first_appearance_summary, "First bins alive."),
    "vw_lag_correlation": _view(V.lag_correlation, "Lagged production correlation of two teams.",
                                team_a=0, team_b=1),
    "vw_resource_tradeoff": _view(V.resource_tradeoff, "Net metal against net energy."),
    "vw_sankey_fold": _view(V.sankey_by_fold, "Production and consumption fold."),
    "vw_longest_surplus": _view(V.longest_surplus, "Longest runs of net production."),
}

STREAMS: dict[str, Stat] = {
    "command_log": Stat(S.command_log, "Command log in frame order.", False,
                        ("commands_log",), _asc("frame", "row_ord")),
    **{a: Stat(S.passthrough(a), f"Clean {a} as-is.", False, (a,), ())
       for a in ASPECT_NAMES},
}

DEFAULT_STREAMS = ["unit_positions", "unit_events", "team_stats", "damage_log", "start_pos"]


class Registry:
    """The stats and streams that a run may be asked for."""

    def __init__(self, stats: Mapping[str, Stat] | None = None,
                 streams: Mapping[str, Stat] | None = None):
        self.stats = {**STATS, **VIEWS} if stats is None else dict(stats)
        self.streams = dict(STREAMS if streams is None else streams)

    def with_stat(self, name: str, stat: Stat) -> Registry:
        """A registry with one more stat; an existing name is refused."""
        if name in self.stats:
            raise StatError(f"stat {name!r} is there already")
        _check_parameters(name, stat)
        return Registry({**self.stats, name: stat}, self.streams)

    def variant(self, name: str, of: str, default_enabled: bool = False, **params) -> Registry:
        """A registry with stat ``of`` once more, under ``name`` and with other parameters."""
        base = self.stats[of]
        return self.with_stat(name, replace(
            base, func=partial(base.func, **params), default_enabled=default_enabled, rollup=None))

    def defaults(self) -> list[str]:
        return [k for k, s in self.stats.items() if s.default_enabled]

    def find(self, name: str) -> Stat:
        stat = self.stats.get(name) or self.streams.get(name)
        if stat is None:
            raise KeyError(f"unknown stat or stream: {name!r}")
        return stat


def _check_parameters(name: str, stat: Stat) -> None:
    try:
        inspect.signature(stat.func).bind({})
    except (TypeError, ValueError) as e:
        raise StatError(f"stat {name!r}: {e}") from e


def default_stats() -> list[str]:
    return Registry().defaults()


def _needed(stat: Stat, table: str) -> tuple[str, ...] | None:
    return stat.columns.get(table)


def _check_inputs(name: str, stat: Stat, tables: Mapping[str, DataFrame]) -> None:
    for table in stat.inputs:
        if table.startswith(OUTPUT):
            continue
        if table not in tables:
            raise StatError(f"missing input {table!r}")
        lost = [c for c in _needed(stat, table) or () if not c.endswith("?")
                and c not in tables[table].columns]
        if lost:
            raise StatError(f"input {table!r} has no column {', '.join(lost)}")


def _check_schema(name: str, stat: Stat, df: DataFrame) -> None:
    if stat.schema is None:
        return
    want = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(stat.schema)}
    got = {f.name: f.dataType.simpleString() for f in df.schema if f.name != "replay_id"}
    if want != got:
        wrong = sorted(c for c in {*want, *got} if want.get(c) != got.get(c))
        raise StatError(f"columns {', '.join(wrong)} are not as declared")


class Outputs(dict):
    """Outputs by name; ``close`` removes the tables stored for them once they are written.

    ``failed`` has the error of each requested output that is not there.
    """

    def __init__(self):
        super().__init__()
        self.paths: list[str] = []
        self.failed: dict[str, Exception] = {}

    def check(self) -> None:
        """Raise, and remove the stored tables, if a requested output failed."""
        if self.failed:
            self.close()
            why = "; ".join(f"{n}: {type(e).__name__}: {e}" for n, e in self.failed.items())
            raise StatError(f"outputs failed: {why}") from next(iter(self.failed.values()))

    def close(self) -> None:
        for df in self.values():
            for path in self.paths:
                drop(df.sparkSession, path)
            self.paths.clear()
            break


def _with_sources(registry: Registry, names: list[str]) -> list[str]:
    """``names`` and the stats they read, sources first."""
    ordered: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise StatError(f"stats read each other: {' -> '.join((*path, name))}")
        if name in ordered:
            return
        for table in registry.find(name).inputs:
            if table.startswith(OUTPUT):
                visit(table.removeprefix(OUTPUT), (*path, name))
        ordered.append(name)

    for name in names:
        visit(name, ())
    return ordered


def _isolated(outputs: dict, failed: dict[str, Exception], name: str,
              make: Callable[[], DataFrame]) -> None:
    try:
        outputs[name] = make()
        failed.pop(name, None)
    except StatError as e:
        log.warning("skipping %s: %s", name, e)
        failed[name] = e
    except Exception as e:  # one broken stat must not stop the run
        log.exception("stat %s failed while building its plan; skipped", name)
        failed[name] = e


def _shared_tables(registry: Registry, names: list[str], passes: dict[tuple, list[str]],
                   tables: Mapping[str, DataFrame], paths: list[str]) -> dict[str, DataFrame]:
    """The tables, those with several readers stored with the columns they need."""
    fused = {n for group in passes.values() for n in group}
    readers: dict[str, list[list[Stat]]] = {}
    for name in names:
        if name not in fused:
            for table in registry.find(name).inputs:
                readers.setdefault(table, []).append([registry.find(name)])
    for (aspect, *_), group in passes.items():
        readers.setdefault(aspect, []).append([registry.find(n) for n in group])
    out = dict(tables)
    for table, groups in readers.items():
        if len(groups) < 2 or table not in tables:
            continue
        df = tables[table]
        needs = [_needed(s, table) for group in groups for s in group]
        if all(n is not None for n in needs):
            wanted = {c.rstrip("?") for n in needs for c in n} | {"replay_id"}
            df = df.select(*[c for c in df.columns if c in wanted])
        try:
            out[table] = stored(df, f"shared-{table}", paths)
        except Exception:  # its readers fail one by one; the others go on
            log.exception("table %s could not be stored; read by each stat", table)
    return out


def build(tables: Mapping[str, DataFrame], names: Iterable[str], registry: Registry,
          share: bool = True) -> Outputs:
    """The named stats and streams as DataFrames, with shared work stored."""
    names, outputs = list(names), Outputs()
    ordered, failed = [], {}
    for name in _with_sources(registry, names):
        try:
            _check_inputs(name, registry.find(name), tables)
            ordered.append(name)
        except StatError as e:
            log.warning("skipping %s: %s", name, e)
            failed[name] = e
    passes: dict[tuple, list[str]] = {}
    if share:
        for name in ordered:
            rollup = registry.find(name).rollup
            if rollup is not None:
                passes.setdefault(rollup.pass_key, []).append(name)
        passes = {k: group for k, group in passes.items() if len(group) > 1}
        tables = _shared_tables(registry, ordered, passes, tables, outputs.paths)
    built: dict[str, DataFrame] = {}
    for (aspect, *_), group in passes.items():
        rollups = {n: registry.find(n).rollup for n in group}
        try:
            summed = stored(aggregate_together(list(rollups.values()), tables[aspect]),
                            f"rollup-{aspect}", outputs.paths)
        except Exception:
            log.exception("the shared pass over %s failed; its stats run alone", aspect)
            continue
        for name, rollup in rollups.items():
            _isolated(built, failed, name, partial(rollup.finish, summed))
    readers = [t.removeprefix(OUTPUT) for n in ordered for t in registry.find(n).inputs
               if t.startswith(OUTPUT)]
    for name in ordered:
        stat = registry.find(name)
        if name not in built:
            sources = {t: built.get(t.removeprefix(OUTPUT)) for t in stat.inputs
                       if t.startswith(OUTPUT)}
            lost = [t.removeprefix(OUTPUT) for t, df in sources.items() if df is None]
            if lost:
                log.warning("skipping %s: an output that it reads is missing", name)
                failed[name] = StatError("; ".join(
                    f"it reads {n}, which failed: {failed[n]}" for n in lost))
                continue

            def make(stat=stat, name=name, sources=sources) -> DataFrame:
                df = stat.func({**tables, **sources})
                _check_schema(name, stat, df)
                if share and readers.count(name) + (name in names) > 1:
                    df = stored(df, name, outputs.paths)
                return df

            _isolated(built, failed, name, make)
        if name in built and name in names:
            outputs[name] = built[name]
    outputs.failed = {n: failed[n] for n in names if n in failed}
    return outputs


def run(tables: Mapping[str, DataFrame], stats: Iterable[str] | None = None,
        streams: Iterable[str] | None = None, registry: Registry | None = None,
        share: bool = True) -> tuple[Outputs, Outputs]:
    """The requested stats and streams (defaults when ``None``).

    A registry of your own may add stats; ``share=False`` builds each plan on its own.
    """
    registry = registry or Registry()
    stats = registry.defaults() if stats is None else list(stats)
    streams = DEFAULT_STREAMS if streams is None else list(streams)
    for name in (*stats, *streams):
        registry.find(name)
    # names are told apart here: a stat and a stream may share one
    both = build(tables, [*stats, *(f"stream/{s}" for s in streams)], Registry(
        {**registry.stats, **{f"stream/{n}": s for n, s in registry.streams.items()}},
        registry.streams), share)
    found, raw = Outputs(), Outputs()
    for name, df in both.items():
        if name.startswith("stream/"):
            raw[name.removeprefix("stream/")] = df
        else:
            found[name] = df
    for name, e in both.failed.items():
        if name.startswith("stream/"):
            raw.failed[name.removeprefix("stream/")] = e
        else:
            found.failed[name] = e
    found.paths = both.paths
    return found, raw


def sort_keys(name: str, df: DataFrame, registry: Registry | None = None) -> list[Column]:
    """The stat's declared order, nulls first, within a replay."""
    registry = registry or Registry()
    stat = registry.stats.get(name) or registry.streams.get(name)
    return [F.col(c).desc_nulls_first() if desc else F.col(c).asc_nulls_first()
            for c, desc in (stat.sort if stat else ()) if c in df.columns]


def sorted_for_sink(name: str, df: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Apply the stat's declared order within each replay."""
    keys = sort_keys(name, df, registry)
    return df.orderBy(*(["replay_id"] if "replay_id" in df.columns else []), *keys) if keys else df
