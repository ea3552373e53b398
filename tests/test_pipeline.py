"""Runner: default stats over the adapted driver tables, isolation of a
failing output, sink formats."""

from pyspark.sql import functions as F

from tickframe.plans import pipeline, registry
from tickframe.sources import adapters

SF = "/root/testdata/sf0.001"


def test_default_run_parquet(spark, tmp_path):
    tables = adapters.load(spark, SF)
    status = pipeline.run(tables, str(tmp_path / "out"), "parquet",
                          stats=["damage_by_unit_def", "army_value_timeline"],
                          streams=["command_log"])
    assert status == {"damage_by_unit_def": "written", "army_value_timeline": "written",
                      "command_log": "written"}
    back = spark.read.parquet(str(tmp_path / "out" / "damage_by_unit_def"))
    assert back.count() > 0 and "replay_id" in back.columns


def test_failing_stat_is_isolated(spark, tmp_path, monkeypatch):
    def boom(tables):
        return tables["damage_log"].select(F.raise_error(F.lit("boom")).alias("x"))
    monkeypatch.setitem(registry.STATS, "broken", registry.Stat(boom, "fails", inputs=("damage_log",)))
    tables = adapters.load(spark, SF, "damage_log")
    status = pipeline.run(tables, str(tmp_path / "o"), "jsonl-gz",
                          stats=["broken", "damage_by_unit_def"], streams=[])
    assert status["damage_by_unit_def"] == "written" and status["broken"].startswith("failed")


def test_row_major_and_columnar_runs(spark, tmp_path):
    tables = adapters.load(spark, SF)
    s = pipeline.run(tables, str(tmp_path / "rm"), "row-major",
                     stats=["army_value_timeline"], streams=["unit_positions", "damage_log"])
    assert s["army_value_timeline"] == "written" and s["unit_positions"] == "written"
    assert s["damage_log"] == "not in this layout"
    c = pipeline.run(tables, str(tmp_path / "col"), "columnar",
                     stats=["unit_economic_contribution_binned", "force_composition_timeline"],
                     streams=[])
    assert c == {"unit_economic_contribution_binned": "written",
                 "force_composition_timeline": "written"}
    chunks = spark.read.parquet(str(tmp_path / "col" / "chunks"))
    keys = {r.data_key for r in chunks.select("data_key").distinct().collect()}
    assert "force_composition_timeline.unit_stats_list_offs" in keys
    assert "force_composition_timeline.unit_stats.units_produced" in keys
