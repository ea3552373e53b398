"""Derived views over the binned economy table (ST-15 output).

The chart pages shape exported rows in the browser; here each shaping is a
DataFrame operator over the whole corpus.  Per-team / per-bin views take an
optional ``team`` / ``bin`` filter; ``None`` computes every team / bin at once
(grouped), which is what a corpus job wants.

Zero-filled grids (VW-1, VW-2, VW-6) are the *output* of those views: rows of
the sparse table are folded into one map per (replay, bin) and expanded
against the replay's key list (an n:1 join on ``replay_id`` plus ``explode``)
-- no cross join of data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_BUCKET_FRAMES
from ..operators import next_values
from ..operators.fold import Fold, fold_by

R = "replay_id"
BIN = "time_bin_start_frame"


def _net_metal() -> Column:
    return F.col("total_metal_produced_in_bin") - F.col("total_metal_consumed_in_bin")


def _net_energy() -> Column:
    return F.col("total_energy_produced_in_bin") - F.col("total_energy_consumed_in_bin")


def _team_filter(df: DataFrame, team) -> DataFrame:
    if team is None:
        return df
    teams = list(team) if isinstance(team, (list, tuple, set)) else [team]
    return df.filter(F.col("team_id").isin(teams))


def _large(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: it is shuffled, never sent to the driver.

    Files of a stored table are far smaller than its rows, so their size says
    too little of what a broadcast would hold.
    """
    return df.hint("merge")


def _zero_fill(values: DataFrame, row_keys: Sequence[str], fill_key: str, value: str,
               key_domain: DataFrame) -> DataFrame:
    """values(row_keys..., fill_key, value) -> every row_keys x fill_key in the
    domain (key_domain: R + row-group keys + fill_key), zero-filled."""
    group = [k for k in key_domain.columns if k != fill_key]
    cells = values.groupBy(*row_keys).agg(
        F.map_from_entries(F.collect_list(F.struct(fill_key, value))).alias("__m"))
    domain = key_domain.groupBy(*group).agg(F.array_sort(F.collect_set(fill_key)).alias("__keys"))
    j = cells.join(_large(domain), group)
    j = j.select(*row_keys, F.explode("__keys").alias(fill_key), "__m")
    return j.select(*row_keys, fill_key,
                    F.coalesce(F.try_element_at("__m", F.col(fill_key)), F.lit(0.0)).alias(value))


# VW-1 ------------------------------------------------------------------------
def net_metal_by_time_team(binned: DataFrame) -> DataFrame:
    """Net metal (produced - consumed) per bin and team, zero-filled over the
    replay's teams for every bin present."""
    v = binned.groupBy(R, BIN, "team_id").agg(F.sum(_net_metal()).alias("net_metal"))
    teams = binned.select(R, "team_id").distinct()
    return _zero_fill(v, [R, BIN], "team_id", "net_metal", teams)


# VW-2 / VW-6 -----------------------------------------------------------------
def metal_by_time_def(binned: DataFrame, team=None, bins_from_all_teams: bool = False) -> DataFrame:
    """Metal produced per bin and unit def for each team, zero-filled over the
    team's defs.  Bins are the team's own bins (VW-2) or every bin of the
    replay (``bins_from_all_teams=True``, the small multiples VW-6)."""
    t = _team_filter(binned, team)
    v = t.groupBy(R, "team_id", BIN, "unit_def_id").agg(
        F.sum("total_metal_produced_in_bin").alias("metal_produced"))
    cells = v.groupBy(R, "team_id", BIN).agg(
        F.map_from_entries(F.collect_list(F.struct("unit_def_id", "metal_produced"))).alias("__m"))
    defs = t.groupBy(R, "team_id").agg(F.array_sort(F.collect_set("unit_def_id")).alias("__defs"))
    if bins_from_all_teams:
        # every bin of the replay for every team shown: the grid is the output
        rows = binned.select(R, BIN).distinct().join(_large(defs), R).join(
            _large(cells), [R, "team_id", BIN], "left")
    else:
        rows = cells.join(_large(defs), [R, "team_id"])
    rows = rows.select(R, "team_id", BIN, F.explode("__defs").alias("unit_def_id"), "__m")
    return rows.select(R, "team_id", BIN, "unit_def_id", F.coalesce(
        F.try_element_at("__m", F.col("unit_def_id")), F.lit(0.0)).alias("metal_produced"))


def small_multiples(binned: DataFrame, teams=None) -> DataFrame:
    return metal_by_time_def(binned, teams, bins_from_all_teams=True)


# VW-3 ------------------------------------------------------------------------
def build_order_events(binned: DataFrame, team=None) -> DataFrame:
    return _team_filter(binned, team).filter(F.col("total_units_produced_in_bin") > 0).select(
        R, "team_id", BIN, "unit_def_id", "total_units_produced_in_bin")


# VW-4 ------------------------------------------------------------------------
def net_metal_heatmap(binned: DataFrame, team=None) -> DataFrame:
    """Heatmap cells: (time index among the replay's bins, unit index among the
    team's "Unit <id>" labels in string order, net metal), plus the team's
    colour range (min/max of net metal, both starting from 0)."""
    t = _team_filter(binned, team)
    bins = binned.select(R, BIN).distinct().withColumn(
        "time_index", (F.dense_rank().over(Window.partitionBy(R).orderBy(BIN)) - 1).cast("long"))
    labels = t.select(R, "team_id", "unit_def_id").distinct().withColumn(
        "label", F.concat(F.lit("Unit "), F.col("unit_def_id").cast("string")))
    labels = labels.withColumn(
        "unit_index",
        (F.dense_rank().over(Window.partitionBy(R, "team_id").orderBy("label")) - 1).cast("long"))
    cells = t.select(R, "team_id", BIN, "unit_def_id", _net_metal().alias("net_metal"))
    rng = cells.groupBy(R, "team_id").agg(
        F.least(F.min("net_metal"), F.lit(0.0)).alias("min_value"),
        F.greatest(F.max("net_metal"), F.lit(0.0)).alias("max_value"))
    return (cells.join(_large(bins), [R, BIN])
            .join(_large(labels.drop("label")), [R, "team_id", "unit_def_id"])
            .join(_large(rng), [R, "team_id"])
            .select(R, "team_id", "time_index", "unit_index", BIN, "unit_def_id", "net_metal",
                    "min_value", "max_value"))


# VW-5 ------------------------------------------------------------------------
def economic_flow_edges(binned: DataFrame, team=None) -> DataFrame:
    """Sankey edges: producer def -> team (sum of positive production) and
    team -> consumer def (sum of positive consumption)."""
    t = _team_filter(binned, team)
    p, c = F.col("total_metal_produced_in_bin"), F.col("total_metal_consumed_in_bin")
    g = t.groupBy(R, "team_id", "unit_def_id").agg(
        F.sum(F.when(p > 0, p)).alias("produced"), F.sum(F.when(c > 0, c)).alias("consumed"))
    prod = g.filter(F.col("produced").isNotNull()).select(
        R, "team_id", "unit_def_id", F.lit("produced").alias("direction"),
        F.col("produced").alias("value"))
    cons = g.filter(F.col("consumed").isNotNull()).select(
        R, "team_id", "unit_def_id", F.lit("consumed").alias("direction"),
        F.col("consumed").alias("value"))
    return prod.unionByName(cons)


# VW-7 ------------------------------------------------------------------------
def composition_snapshot(binned: DataFrame, team=None, bin_start: int | None = None) -> DataFrame:
    t = _team_filter(binned, team)
    if bin_start is not None:
        t = t.filter(F.col(BIN) == bin_start)
    return t.filter(F.col("total_metal_produced_in_bin") > 0).groupBy(
        R, "team_id", BIN, "unit_def_id").agg(
        F.sum("total_metal_produced_in_bin").alias("metal_produced"))


# VW-8 ------------------------------------------------------------------------
def build_order_transitions(binned: DataFrame, team=None,
                            width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Counts of consecutive production events A -> B per team (events ordered
    by bin, then unit def)."""
    ev = build_order_events(binned, team).select(R, "team_id", BIN, "unit_def_id")
    nxt = next_values(ev, [R, "team_id"], [BIN, "unit_def_id"], ["unit_def_id"], width=width)
    return nxt.filter(F.col("next_unit_def_id").isNotNull()).groupBy(
        R, "team_id", F.col("unit_def_id").alias("source_def_id"),
        F.col("next_unit_def_id").alias("target_def_id")).agg(F.count(F.lit(1)).alias("transitions"))


# VW-9 ------------------------------------------------------------------------
def producer_consumer_hierarchy(binned: DataFrame, team=None) -> DataFrame:
    """Team -> role (Producers / Consumers) -> [unit def, value] hierarchy."""
    e = economic_flow_edges(binned, team)
    role = F.when(F.col("direction") == "produced", "Producers").otherwise("Consumers")
    return e.groupBy(R, "team_id", role.alias("role")).agg(
        F.array_sort(F.collect_list(F.struct("unit_def_id", "value"))).alias("children"))


# VW-10 -----------------------------------------------------------------------
def economic_rhythm(binned: DataFrame, team=None) -> DataFrame:
    return _team_filter(binned, team).groupBy(R, "team_id", BIN).agg(
        F.sum("total_metal_produced_in_bin").alias("metal_produced"),
        F.sum("total_energy_produced_in_bin").alias("energy_produced"),
        F.sum("total_units_produced_in_bin").alias("units_produced"))


# VW-11 -----------------------------------------------------------------------
def first_appearance(binned: DataFrame) -> DataFrame:
    """First bin in which each (replay, team, def) has a unit alive."""
    return binned.filter(F.col("units_alive_in_bin") > 0).groupBy(R, "team_id", "unit_def_id").agg(
        F.min(BIN).alias("first_bin"))


def first_appearance_summary(binned: DataFrame) -> DataFrame:
    """Five-number summary (seconds) of first-appearance times across replays
    per (team, def).  ``percentile`` keeps a value->count map, bounded by the
    number of distinct bins, not by the number of replays."""
    fa = first_appearance(binned).withColumn("t", F.col("first_bin") / F.lit(30.0))
    return fa.groupBy("team_id", "unit_def_id").agg(
        F.count(F.lit(1)).alias("replays"),
        F.min("t").alias("t_min"),
        F.percentile("t", 0.25).alias("t_q1"),
        F.percentile("t", 0.5).alias("t_median"),
        F.percentile("t", 0.75).alias("t_q3"),
        F.max("t").alias("t_max"))


# VW-12 -----------------------------------------------------------------------
def lag_correlation(binned: DataFrame, team_a: int, team_b: int,
                    def_a: int | None = None, def_b: int | None = None,
                    lags: Sequence[int] = (-3, -2, -1, 0, 1, 2, 3),
                    bin_frames: int = 300) -> DataFrame:
    """Pearson correlation of B's production at bin t+lag with A's at bin t,
    over each replay's dense bin range (missing bins count as 0).  A series is
    one team's production of one unit def (``None``: all its defs).  The
    correlation is null when either series is constant."""
    def series(team, d):
        cond = F.col("team_id") == team
        if d is not None:
            cond = cond & (F.col("unit_def_id") == d)
        return binned.filter(cond).groupBy(R, BIN).agg(
            F.sum("total_units_produced_in_bin").alias("v"))

    rng = binned.groupBy(R).agg(F.min(BIN).alias("lo"), F.max(BIN).alias("hi"))
    grid = rng.select(R, F.explode(F.sequence("lo", "hi", F.lit(bin_frames).cast("long"))).alias(BIN))
    a = grid.join(_large(series(team_a, def_a)), [R, BIN], "left").select(
        R, BIN, F.coalesce("v", F.lit(0)).cast("double").alias("a"))
    b = grid.join(_large(series(team_b, def_b)), [R, BIN], "left").select(
        R, F.col(BIN).alias("b_bin"), F.coalesce("v", F.lit(0)).cast("double").alias("b"))
    lag_arr = F.array(*[F.lit(int(x)) for x in lags])
    b = b.select(R, "b", F.explode(lag_arr).alias("lag"), "b_bin")
    b = b.withColumn(BIN, F.col("b_bin") - F.col("lag") * bin_frames)
    j = a.join(_large(b), [R, BIN])
    # Pearson = cov / (sd_a * sd_b); try_divide keeps constant series null
    # instead of failing under ANSI arithmetic.
    sd = F.stddev_pop("a") * F.stddev_pop("b")
    r = F.when(sd > 0, F.try_divide(F.covar_pop("a", "b"), sd))
    return j.groupBy(R, "lag").agg(r.alias("correlation"), F.count(F.lit(1)).alias("pairs"))


# VW-13 -----------------------------------------------------------------------
def resource_tradeoff(binned: DataFrame, bin_start: int | None = None) -> DataFrame:
    t = binned if bin_start is None else binned.filter(F.col(BIN) == bin_start)
    return t.select(R, BIN, "team_id", "unit_def_id", _net_metal().alias("net_metal"),
                    _net_energy().alias("net_energy"), F.col("units_alive_in_bin").alias("units_alive"))


# VW-14 -----------------------------------------------------------------------
def fold(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Generic single-pass fold over chosen columns: ``aggregates`` maps output
    name -> aggregate Column (sum/min/max/count/collect/...).  Built-in
    aggregates combine map-side, so a hot group is never gathered in one task.
    What they do not cover, ``operators.fold.fold_by`` folds in Python, by
    mergeable states."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def sankey_by_fold(binned: DataFrame) -> DataFrame:
    """The chart page's Sankey fold (production/consumption per team|def)."""
    p, c = F.col("total_metal_produced_in_bin"), F.col("total_metal_consumed_in_bin")
    return fold(binned, [R, "team_id", "unit_def_id"], {
        "production": F.sum(F.when(p > 0, p)),
        "consumption": F.sum(F.when(c > 0, c)),
    })


def _surplus_bins(state: set, rows: dict) -> set:
    state.update(rows[BIN][rows["net_metal"] > 0].tolist())
    return state


def _longest_run(bins: set, step: int) -> tuple[int | None, int]:
    """(first bin, bins) of the longest run of adjacent bins, the earliest of several."""
    start = best = None
    length = longest = 0
    for b in sorted(bins):
        if length and b == start + length * step:
            length += 1
        else:
            start, length = b, 1
        if length > longest:
            best, longest = start, length
    return best, longest


def longest_surplus(binned: DataFrame, bin_frames: int = 300) -> DataFrame:
    """The longest run of adjacent bins in which a unit definition made more metal than it
    used, per team; a fold whose states (sets of bins) merge in any order."""
    return fold_by(
        binned.select(R, "team_id", "unit_def_id", BIN, _net_metal().alias("net_metal")),
        [R, "team_id", "unit_def_id"],
        Fold((BIN, "net_metal"), set, _surplus_bins, lambda a, b: a | b,
             lambda bins: _longest_run(bins, bin_frames), "run_start long, run_bins long"))
