"""A run reads each input once, whatever it computes, and takes stats of one's own."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import make
from tickframe.operators.rollup import Rollup, aggregate_together
from tickframe.plans import catalog, pipeline, registry
from tickframe.plans import stats as S
from tickframe.plans.registry import Registry, Stat, StatError
from tickframe.sources import adapters

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r])
                  for r in df.select(*sorted(df.columns)).collect())


def paths_read(df):
    plan = df._jdf.queryExecution().optimizedPlan()
    found = re.findall(r"Relation \[", plan.toString())
    return len(found), set(df.inputFiles())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The aspects as Parquet files of their own, so that scans can be told apart."""
    root = tmp_path_factory.mktemp("aspects")
    out = {}
    for name, df in adapters.load(spark, SF).items():
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    return out


def test_shared_run_equals_single_plans(spark, tables):
    shared, _ = registry.run(tables, None, [])
    alone, _ = registry.run(tables, None, [], share=False)
    assert list(shared) and set(shared) == set(alone) == set(registry.default_stats())
    for name in shared:
        assert rows(shared[name]) == rows(alone[name]), name
    shared.close()


def test_each_aspect_is_read_once(spark, tables, monkeypatch):
    stores = []
    real = registry.stored

    def counted(df, name, paths=None):
        stores.append((name, set(df.inputFiles()), df.columns))
        return real(df, name, paths)

    monkeypatch.setattr(registry, "stored", counted)
    outputs, _ = registry.run(tables, None, [])
    reads = [f for _, files, _ in stores for f in files if "/scratch/" not in f]
    for df in outputs.values():
        reads += [f for f in df.inputFiles() if "/scratch/" not in f]
    # every file of an aspect appears in one plan only, be it a stored table or an output
    assert reads and len(reads) == len(set(reads))
    names = [n for n, _, _ in stores]
    assert names.count("rollup-team_stats") == 1
    shared = {n: set(c) for n, _, c in stores}
    assert "projectile_id" not in shared["shared-damage_log"]      # only columns that are needed
    assert {"damage", "victim_unit_id", "attacker_def_id"} <= shared["shared-damage_log"]
    outputs.close()


def test_views_share_one_binned_output(spark, tables, monkeypatch):
    stores = []
    real = registry.stored
    monkeypatch.setattr(registry, "stored", lambda df, name, paths=None: stores.append(name)
                        or real(df, name, paths))
    outputs, _ = registry.run(tables, list(registry.VIEWS), [])
    assert set(outputs) == set(registry.VIEWS)
    assert stores.count("unit_economic_contribution_binned") == 1
    for df in outputs.values():
        assert all("/scratch/" in f for f in df.inputFiles())
    binned = S.unit_economic_contribution_binned(tables)
    assert rows(outputs["vw_economic_rhythm"]) == rows(registry.V.economic_rhythm(binned))
    outputs.close()


def test_rollups_compute_equal_expressions_once(spark, tables):
    group = [S.team_totals(), S.team_totals(final=True), S.ECONOMIC_EFFICIENCY, S.COLLABORATION]
    summed = aggregate_together(group, tables["team_stats"])
    # 4 sums, 4 maxima of totals, 3 + 4 maxima, of which none repeats but by expression
    exprs = [e for r in group for _, e in r.aggregates]
    assert len([c for c in summed.columns if c.startswith("a")]) == len(set(exprs))
    for r in group:
        assert rows(r.finish(summed)) == rows(r.evaluate(tables["team_stats"]))
    with pytest.raises(ValueError):
        aggregate_together([S.COLLABORATION, Rollup("team_stats", (), (), ())],
                           tables["team_stats"])


def units_lost(tables, event="DESTROYED"):
    return tables["unit_events"].filter(F.col("event_type") == event).groupBy(
        "replay_id", F.col("unit_team_id").alias("player_id")).agg(
        F.count(F.lit(1)).alias("units_lost"))


LOST = Stat(units_lost, "Units lost per player.", inputs=("unit_events",),
            sort=(("units_lost", True),), columns={"unit_events": ("event_type", "unit_team_id")},
            schema="player_id long, units_lost long")


def test_user_stat_with_parameters(spark, tables, tmp_path):
    known = Registry().with_stat("units_lost", LOST).variant(
        "units_made", "units_lost", event="CREATED")
    status = pipeline.run(tables, str(tmp_path / "o"), stats=["units_lost", "units_made"],
                          streams=[], known=known)
    assert status == {"units_lost": "written", "units_made": "written"}
    made = spark.read.parquet(str(tmp_path / "o" / "units_made"))
    assert rows(made.select("player_id", "units_lost")) == rows(
        units_lost(tables, "CREATED").select("player_id", "units_lost"))


def test_declarations_are_checked_before_any_job(spark, tables):
    with pytest.raises(StatError, match="there already"):
        Registry().with_stat("damage_by_unit_def", LOST)
    with pytest.raises(StatError, match="unknown_parameter"):
        Registry().with_stat("units_lost", LOST).variant("x", "units_lost", unknown_parameter=1)
    with pytest.raises(KeyError, match="unknown stat"):
        registry.run(tables, ["nope"], [])
    wrong = Registry({"schema": Stat(units_lost, "", inputs=("unit_events",),
                                     schema="player_id long, units_lost double"),
                      "column": Stat(units_lost, "", inputs=("unit_events",),
                                     columns={"unit_events": ("no_such_column",)}),
                      "input": Stat(units_lost, "", inputs=("no_such_table",)),
                      "broken": Stat(lambda t: 1 / 0, "", inputs=("unit_events",)),
                      "reader": Stat(lambda t: t["stat:broken"], "", inputs=("stat:broken",)),
                      "good": LOST}, {})
    outputs, _ = registry.run(tables, list(wrong.stats), [], wrong)
    assert list(outputs) == ["good"]
    loop = Registry({"a": Stat(units_lost, "", inputs=("stat:b",)),
                     "b": Stat(units_lost, "", inputs=("stat:a",))}, {})
    with pytest.raises(StatError, match="read each other"):
        registry.run(tables, ["a"], [], loop)


def test_stored_tables_go_with_the_run(spark, tables):
    outputs, _ = registry.run(tables, ["force_composition_timeline", "crisis_response_index"], [])
    where = [p.removeprefix("file:") for p in outputs.paths]
    assert where and all(os.path.isdir(p) for p in where)
    outputs.close()
    assert not any(os.path.isdir(p) for p in where)


def test_odd_inputs(spark):
    """Empty tables, optional columns that are missing, nulls in keys."""
    empty = make(spark, [], "replay_id string, frame long, team_id long, metal_used double, "
                            "energy_used double, damage_dealt double, metal_produced double, "
                            "energy_produced double")
    outputs, _ = registry.run({"team_stats": empty}, [
        "resources_by_player", "player_economic_efficiency", "player_collaboration"], [])
    assert {n: df.count() for n, df in outputs.items()} == {
        "resources_by_player": 0, "player_economic_efficiency": 0}
    nulls = make(spark, [("r", None, None, 1.0, None, None, 1.0, 2.0),
                         (None, 1, 3, None, None, None, None, None)],
                 "replay_id string, frame long, team_id long, metal_used double, "
                 "energy_used double, damage_dealt double, metal_produced double, "
                 "energy_produced double")
    outputs, _ = registry.run({"team_stats": nulls}, ["resources_by_player",
                                                      "player_economic_efficiency"], [])
    assert sorted(map(repr, outputs["resources_by_player"].collect())) == sorted(map(
        repr, S.resources_by_player({"team_stats": nulls}).collect()))


def test_failed_outputs_are_told_from_results(spark, tables, tmp_path):
    broken = Stat(lambda t: 1 / 0, "", inputs=("unit_events",))
    known = Registry({"broken": broken, "reader": Stat(lambda t: t["stat:broken"], "",
                                                       inputs=("stat:broken",)),
                      "input": Stat(units_lost, "", inputs=("no_such_table",)),
                      "both": broken, "lost": LOST}, {"broken": broken, "both": LOST})
    outputs, raw = registry.run(tables, ["reader", "input", "lost"], ["broken"], known)
    assert list(outputs) == ["lost"] and set(outputs.failed) == {"reader", "input"}
    assert isinstance(raw.failed["broken"], ZeroDivisionError)
    with pytest.raises(StatError, match="reader.*division by zero.*no_such_table"):
        outputs.check()
    good, _ = registry.run(tables, ["lost"], [], known)
    good.check()
    # the stream has the name: the stat's failure is not its, and its own is not hidden
    status = pipeline.run(tables, str(tmp_path / "o"), stats=["reader", "lost", "both"],
                          streams=["broken", "both"], known=known)
    assert status == {"lost": "written", "both": "written", "reader": "failed: StatError",
                      "broken": "failed: ZeroDivisionError"}
    swapped = Registry({"both": LOST}, {"both": broken})
    assert pipeline.run(tables, str(tmp_path / "p"), stats=["both"], streams=["both"],
                        known=swapped) == {"both": "failed: ZeroDivisionError"}


def test_whole_run_with_a_failing_stat_fails(spark, monkeypatch):
    name = "force_composition_timeline"
    monkeypatch.setitem(registry.STATS, name, Stat(
        lambda t: 1 / 0, "", True, registry.STATS[name].inputs))
    with pytest.raises(StatError, match=f"{name}: ZeroDivisionError"):
        catalog.queries()["run_default_stats"](spark, SF)
