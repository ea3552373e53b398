"""Derived views on small binned tables."""

from tests.conftest import make
from tickframe.plans import views as V

BIN = ("replay_id long, team_id long, unit_def_id long, time_bin_start_frame long, "
       "units_alive_in_bin long, total_unit_seconds_in_bin double, "
       "total_units_produced_in_bin long, total_metal_produced_in_bin double, "
       "total_metal_consumed_in_bin double, total_energy_produced_in_bin double, "
       "total_energy_consumed_in_bin double")


def _binned(spark):
    rows = [  # replay, team, def, bin, alive, secs, produced, metal+, metal-, energy+, energy-
        (0, 0, 5, 0, 1, 10.0, 1, 30.0, 10.0, 0.0, 0.0),
        (0, 0, 7, 300, 1, 10.0, 2, 0.0, 4.0, 1.0, 0.0),
        (0, 1, 5, 300, 2, 20.0, 0, 5.0, 0.0, 0.0, 2.0),
        (0, 0, 5, 600, 1, 5.0, 1, 1.0, 0.0, 0.0, 0.0),
    ]
    return make(spark, rows, BIN)


def test_zero_filled_net_metal(spark):
    got = {(r.time_bin_start_frame, r.team_id): r.net_metal
           for r in V.net_metal_by_time_team(_binned(spark)).collect()}
    assert got == {(0, 0): 20.0, (0, 1): 0.0, (300, 0): -4.0, (300, 1): 5.0,
                   (600, 0): 1.0, (600, 1): 0.0}


def test_metal_grid_and_small_multiples(spark):
    b = _binned(spark)
    own = {(r.team_id, r.time_bin_start_frame, r.unit_def_id): r.metal_produced
           for r in V.metal_by_time_def(b, team=0).collect()}
    assert own == {(0, 0, 5): 30.0, (0, 0, 7): 0.0, (0, 300, 5): 0.0, (0, 300, 7): 0.0,
                   (0, 600, 5): 1.0, (0, 600, 7): 0.0}
    sm = V.small_multiples(b, teams=(1,)).collect()
    assert sorted((r.time_bin_start_frame, r.metal_produced) for r in sm) == [
        (0, 0.0), (300, 5.0), (600, 0.0)]


def test_build_order_transitions_and_flows(spark):
    b = _binned(spark)
    tr = {(r.source_def_id, r.target_def_id): r.transitions
          for r in V.build_order_transitions(b, team=0, width=300).collect()}
    assert tr == {(5, 7): 1, (7, 5): 1}
    edges = {(r.team_id, r.unit_def_id, r.direction): r.value
             for r in V.economic_flow_edges(b).collect()}
    assert edges == {(0, 5, "produced"): 31.0, (0, 5, "consumed"): 10.0,
                     (0, 7, "consumed"): 4.0, (1, 5, "produced"): 5.0}
    rh = {r.time_bin_start_frame: (r.metal_produced, r.units_produced)
          for r in V.economic_rhythm(b, team=0).collect()}
    assert rh == {0: (30.0, 1), 300: (0.0, 2), 600: (1.0, 1)}


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grids_join_without_broadcasts(spark):
    """Sides that grow with the corpus stay off the driver, however small their files are."""
    b = _binned(spark)
    for view in (V.net_metal_heatmap(b), V.net_metal_by_time_team(b), V.metal_by_time_def(b),
                 V.small_multiples(b), V.lag_correlation(b, team_a=0, team_b=1)):
        assert "SortMergeJoin" in _joins(view) and "Broadcast" not in _joins(view)


def test_heatmap_cells(spark):
    got = {(r.team_id, r.time_index, r.unit_index): (r.net_metal, r.min_value, r.max_value)
           for r in V.net_metal_heatmap(_binned(spark)).collect()}
    assert got == {(0, 0, 0): (20.0, -4.0, 20.0), (0, 1, 1): (-4.0, -4.0, 20.0),
                   (0, 2, 0): (1.0, -4.0, 20.0), (1, 1, 0): (5.0, 0.0, 5.0)}
