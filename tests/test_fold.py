"""Mergeable folds: partial states, trees of merges, hot groups, odd inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import make
from tickframe.operators import fold as M
from tickframe.operators.fold import Fold, fold_by
from tickframe.plans import views

# the texts of a group one after the other: a merge that does not commute
JOINED = Fold(("x",), list, lambda s, rows: s + [str(v) for v in rows["x"]], lambda a, b: a + b,
              lambda s: (len(s), " ".join(s)), "n int, joined string")


def test_states_merge_in_the_order_of_tasks(spark):
    n = 400
    df = spark.range(0, n, 1, 50).selectExpr("CAST(id % 3 AS string) AS k", "id AS x")
    got = {r["k"]: r["joined"] for r in fold_by(df, ["k"], JOINED, fan=3).collect()}
    assert got == {str(k): " ".join(str(i) for i in range(n) if i % 3 == k) for k in range(3)}


def test_a_hot_group_is_merged_as_a_tree(spark, monkeypatch):
    most = []
    real = M.stored

    def counted(df, name, paths=None):
        out = real(df, name, paths)
        if "__branch" in df.columns or "__part" in df.columns:
            n = out.groupBy("k").count().agg(F.max("count")).first()[0]
            most.append(n)
        return out

    monkeypatch.setattr(M, "stored", counted)
    df = spark.range(0, 9000, 1, 64).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS k", "id AS x")
    got = fold_by(df, ["k"], Fold(("x",), int, lambda s, r: s + int(r["x"].sum()),
                                  lambda a, b: a + b, lambda s: (s,), "total long"), fan=4)
    assert {r["k"]: r["total"] for r in got.where("k = 'hot'").collect()} == {
        "hot": sum(range(0, 9000, 3))}
    # 64 states of the hot group, then 16, 4 and 1: never more than 4 in one merge
    assert most == [64, 16, 4, 1]
    assert got.count() == 6001


def test_states_are_passed_on_when_many(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_STATES", 10)
    run = M._partial(JOINED, ["k"], make(spark, [("a", 1)], "k string, x long").schema.fields[:1])
    import pyarrow as pa
    batches = [pa.table({"k": [f"k{i % 25}" for i in range(j, j + 20)],
                         "x": list(range(j, j + 20))}).to_batches()[0] for j in range(0, 100, 20)]

    class Task:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": staticmethod(lambda: 7)})

    import pyspark
    monkeypatch.setattr(pyspark, "TaskContext", Task)
    out = list(run(iter(batches)))
    assert len(out) > 1 and all(b.column("__part").to_pylist() == [7] * b.num_rows for b in out)
    assert [b.column("__seq")[0].as_py() for b in out] == list(range(len(out)))


def test_nulls_no_keys_and_empty(spark):
    df = make(spark, [(None, 1, 2.0), (None, 2, None), ("a", None, 1.0)], "k string, x long, y double")
    got = fold_by(df, ["k"], Fold(("y",), int, lambda s, r: s + len(r["y"]), int.__add__,
                                  lambda s: (s,), "n long"))
    assert sorted((r["k"] or "", r["n"]) for r in got.collect()) == [("", 2), ("a", 1)]
    count = Fold(("x",), int, lambda s, r: s + len(r["x"]), int.__add__, lambda s: (s,), "n long")
    assert [tuple(r) for r in fold_by(df, [], count).collect()] == [(3,)]
    assert fold_by(df.where("k = 'none'"), ["k"], count).collect() == []


BINNED = ("replay_id string, team_id long, unit_def_id long, time_bin_start_frame long, "
          "total_metal_produced_in_bin double, total_metal_consumed_in_bin double")


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_surplus_against_all_runs(spark, seed):
    draw = random.Random(seed)
    rows = [("r", t, d, b * 300, draw.choice([0.0, 2.0, 2.0]), 1.0) for t in range(2)
            for d in range(4) for b in range(60) if draw.random() < 0.9]
    got = {(r["team_id"], r["unit_def_id"]): (r["run_start"], r["run_bins"]) for r in
           views.longest_surplus(make(spark, rows, BINNED).repartition(20)).collect()}
    for t, d in itertools.product(range(2), range(4)):
        bins = {r[3] for r in rows if r[1:3] == (t, d) and r[4] > r[5]}
        runs = [(-n, s) for s in bins for n in range(1, 61)
                if all(s + 300 * k in bins for k in range(n))]
        assert got[t, d] == ((min(runs)[1], -min(runs)[0]) if runs else (None, 0))
