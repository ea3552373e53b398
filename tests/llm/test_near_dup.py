import random
from collections import defaultdict

import pytest

from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import near_dup as nd
from tickframe.llm.components import connected_components


def _brute(rows):
    sets = [set(nd.shingles(t or "").tolist()) for _, t in rows]
    linked = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                linked[a].add(b)
                linked[b].add(a)
    out, seen = {}, set()
    for a in range(len(rows)):
        if a in seen:
            continue
        group, todo = {a}, [a]
        while todo:
            for b in linked[todo.pop()] - group:
                group.add(b)
                todo.append(b)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            out[k] = (rows[k][0], min(ids) if ids else None, len(linked[k]))
    return sorted(out.values(), key=str)


def _near(text, seed, changes):
    draw, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(w)


def _check(spark, rows):
    got = nd.near_duplicates(documents(spark, rows)).select("doc_id", "class_id", "n_links")
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows)


def test_families_and_odd_rows(spark):
    rows = odd_rows()
    for k in range(25):
        base = " ".join(words(k, 40 + 12 * k))
        rows += [(100 * (k + 1) + j, _near(base, 31 * k + j, j % 5)) for j in range(k % 7 + 1)]
    _check(spark, rows)


def test_crowd_of_near_copies_and_shared_passage(spark, monkeypatch):
    # a crowd goes through the deeper levels, pivots and several blocks
    monkeypatch.setattr(nd, "BLOCK", 24)
    base, passage = " ".join(words(1, 160)), " ".join(words(2, 30))
    rows = [(k, _near(base, k, k % 4)) for k in range(120)]
    rows += [(1000 + k, passage + " " + " ".join(words(50 + k, 40))) for k in range(60)]
    _check(spark, rows)


def test_recall_grows_with_runs():
    assert nd.runs_for(0.5) < nd.runs_for(0.99) < nd.runs_for(0.9999)


def test_one_of_each(spark):
    base = " ".join(words(3, 60))
    rows = [(5, base), (9, _near(base, 1, 1)), (7, "alone here"), (5, base), (8, None), (6, "")]
    docs = documents(spark, rows)
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8]


def test_null_and_repeated_ids_are_told_apart_by_text(spark):
    base, other = " ".join(words(3, 60)), " ".join(words(4, 60))
    rows = [(5, base), (None, _near(base, 1, 1)), (None, "clean one"), (None, "clean two"),
            (None, None), (None, other), (None, _near(other, 2, 1)), (7, "x y z"), (7, base)]
    kept = [(r.doc_id, r.text) for r in nd.one_of_each(documents(spark, rows)).collect()]
    assert {t for i, t in kept if i is None} >= {"clean one", "clean two", None}
    assert sum(t in (other, rows[6][1]) for _, t in kept) == 1 and len(kept) == 6
    assert (5, base) in kept and (7, "x y z") in kept


def test_empty_table(spark):
    assert nd.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(k, k + 1) for k in range(40)], [(k, k ^ 1) for k in range(20)],
    [(random.Random(k).randrange(60), random.Random(-k).randrange(60)) for k in range(50)]])
def test_components(spark, edges):
    root = {}
    for e in edges:
        for k in e:
            root.setdefault(k, k)
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    linked = {k for a, b in edges if a != b for k in (a, b)}
    assert got == {k: root[k] for k in linked}
