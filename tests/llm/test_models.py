"""Classifiers and the language model: brute force, exact sums, held-out accuracy."""

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import hmm_lm, quality, toxicity
from tickframe.llm.common import crc_mod
from tickframe.llm.kernels import apply_knots, isotonic

LABELS = "doc_id long, quality int, toxic int, score string"


def _labelled(spark):
    """Good and junk texts, some with one of a few bad words; odd rows besides."""
    rows, labels = odd_rows(), [(None, 1, 1, ""), (4, None, None, "")]
    for k in range(400):
        good, bad = k % 3 > 0, k % 4 == 0
        w = words(k, 40 + k % 60)
        if bad:
            w[7] = w[20] = ("vile", "nasty", "rotten")[k % 3]
        text = " ".join(w) + "." if good else " ".join(f"{x.upper()}!!" for x in w)
        rows.append((100 + k, text))
        labels += [(100 + k, int(good), int(bad), "")] * (1 + k % 2)
    return documents(spark, rows), spark.createDataFrame(labels, LABELS), {
        i: (q, t) for i, q, t, _ in labels if i and q is not None}, len(rows)


def _right(got, truth, at):
    known = [(r.predicted, truth[r.doc_id][at]) for r in got if r.held_out and r.doc_id in truth]
    assert len(known) > 50
    return sum(a == b for a, b in known) / len(known)


def test_quality_held_out(spark):
    docs, labels, truth, n = _labelled(spark)
    got = quality.quality_scores(docs, labels, crc_mod("doc_id", 4) == 2).collect()
    assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert _right(got, truth, 0) > 0.97


def test_toxicity_held_out_with_evidence(spark):
    docs, labels, truth, n = _labelled(spark)
    got = toxicity.toxicity_scores(docs, labels, crc_mod("doc_id", 3) == 1).collect()
    assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert _right(got, truth, 1) > 0.97
    assert all(r.evidence_ids for r in got if r.doc_id in truth and truth[r.doc_id][1])


def test_toxicity_learns_from_every_label_and_every_index_part(spark):
    docs, labels, truth, n = _labelled(spark)
    held = crc_mod("doc_id", 3) == 1

    def near(**options):
        return {(r.doc_id, r.score, tuple(r.evidence_similarity)) for r in
                toxicity.toxicity_scores(docs, labels, held, **options).collect()}
    assert near(part_examples=30) == near()
    # a word of four labelled documents joins them, whatever the number of other terms
    rows = [(5000 + k, " ".join(words(900 + k, 30)) + " seldomword") for k in range(40)]
    more = docs.unionByName(documents(spark, rows))
    kept = labels.unionByName(spark.createDataFrame([(i, 1, 1, "") for i, _ in rows], LABELS))
    got = toxicity.toxicity_scores(more, kept, F.col("doc_id") >= 5004).collect()
    assert sum(r.held_out and not {5000, 5001, 5002, 5003}.isdisjoint(r.evidence_ids)
               for r in got if r.doc_id) > 30


def test_scores_without_labels_and_empty_tables(spark):
    docs, none = documents(spark, odd_rows()), spark.createDataFrame([], LABELS)
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        got = score(docs, none, crc_mod("doc_id", 4) == 2).collect()
        assert len(got) == len(odd_rows()) and {r.score for r in got} == {0.5}
        assert score(documents(spark, []), none, crc_mod("doc_id", 4) == 2).count() == 0


def test_isotonic_is_increasing_and_pooled():
    x, y = isotonic([(0.0, 0.1, 10, 1), (0.2, 0.3, 10, 5), (0.4, 0.5, 10, 3), (0.6, 0.7, 10, 9)])
    assert all(a < b for a, b in zip(y, y[1:], strict=False)) and x == sorted(x)
    assert abs(apply_knots(np.array([0.35]), (x, y))[0] - 0.4) < 0.01


def test_block_max_index_is_exact():
    draw = np.random.default_rng(3)

    def vector():
        cols = sorted(draw.choice(60, draw.integers(1, 7), replace=False).tolist())
        w = draw.random(len(cols)) + 0.1
        return tuple(cols), tuple((w / np.sqrt((w * w).sum())).tolist())

    examples = {vector(): k for k in range(900)}
    index = toxicity.BlockMaxIndex.build([(k, c, w, k % 2, 1) for (c, w), k in examples.items()], 8)
    for _ in range(60):
        cols, weights = vector()
        q = dict(zip(cols, weights, strict=True))
        want = sorted((round(sum(q.get(c, 0) * x for c, x in zip(cc, ww, strict=True)), 9)
                       for cc, ww in examples), reverse=True)[:10]
        got = [s for s, _ in index.nearest(list(cols), list(weights), 10)]
        assert got == [w for w in want if w > 0]


def _tiny_hmm(k=3, size=5):
    draw = np.random.default_rng(1)
    step, emit = draw.random((k, k)), draw.random((size, k))
    return hmm_lm.Hmm(np.full(k, 1 / k), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def _paths(model, text):
    """(probability, states) of every state sequence of a text."""
    for states in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[states[0]] * model.emit[text[0], states[0]]
        for t in range(1, len(text)):
            p *= model.step[states[t - 1], states[t]] * model.emit[text[t], states[t]]
        yield p, states


def test_forward_and_counts_equal_sums_over_paths(monkeypatch):
    model = _tiny_hmm()
    texts = [np.array(t, np.uint16) for t in ([0], [1, 4, 2], [3, 3, 0, 1, 2], [4, 2])]
    like = [sum(p for p, _ in _paths(model, t)) for t in texts]
    assert np.allclose(model.log10(texts), np.log10(like))
    start, move, emit, total = model.expected(texts)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    for t, z in zip(texts, like, strict=True):
        for p, s in _paths(model, t):
            want[0][s[0]] += p / z
            for i in range(len(t)):
                want[2][t[i], s[i]] += p / z
                if i:
                    want[1][s[i - 1], s[i]] += p / z
    for a, b in zip((start, move, emit), want, strict=True):
        assert np.allclose(a, b)
    assert np.isclose(total[0], np.log10(like).sum())


def test_model_is_a_distribution(spark):
    # over all next tokens (words seen, one unseen type a class) a text's shares sum to one
    rows = [(k, " ".join(words(k, 30, 60))) for k in range(60)]
    c = Counter(w for _, t in rows for w in [*t.split(), ""])
    df = spark.createDataFrame([(w.encode(), hmm_lm.class_of(w.encode()), n) for w, n in c.items()],
                               "word binary, class int, c long")
    lex = hmm_lm.lexicon(df)
    share = np.zeros(hmm_lm.CLASSES)
    for w, i in lex.index.items():
        if i >= lex.first_class:
            share[hmm_lm.class_of(w)] += lex.counts[i] + 1
    assert np.allclose((share + 1) / lex.class_totals, 1)


def _brute_base(rows, held):
    texts = {k: [*(t or "").encode().lower().split(), b""] for k, (_, t) in enumerate(rows)}
    c = Counter(w for k, ws in texts.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(rows[k][0], len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for k, ws in texts.items()]


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "TABLE", 40)  # most words come by the join
    monkeypatch.setattr(hmm_lm, "SYMBOLS", 20)
    rows = odd_rows() + [(100 + k, " ".join(words(k, 50, 300 if k % 2 else 60)))
                         for k in range(150)]
    docs = documents(spark, rows)
    held = [r[0] for r in docs.select(crc_mod("doc_id", 7) == 2).collect()]
    got = hmm_lm.text_scores(docs, crc_mod("doc_id", 7) == 2, blocks=2).collect()
    want = _brute_base(rows, held)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                   for r in got), key=str) == sorted(
        ((*w[:4], round(w[4], 4)) for w in want), key=str)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_language_model_without_training(spark):
    got = hmm_lm.text_scores(documents(spark, odd_rows()), crc_mod("doc_id", 1) == 0,
                             blocks=2).collect()
    assert {(r.base_score, r.score, r.train_tokens) for r in got} == {(0.0, 0.0, 0)}
    assert hmm_lm.text_scores(documents(spark, []), crc_mod("doc_id", 7) == 2, blocks=2).count() == 0


def test_segments_carry_the_state_on(monkeypatch):
    model = _tiny_hmm()
    draw = np.random.default_rng(4)
    texts = [draw.integers(0, 5, n).astype(np.uint16) for n in (1, 256, 257, 900, 5000)]
    start, move, emit, total = model.expected(texts)
    # every token, every step from token to token and every text's start counts once
    assert np.isclose(start.sum(), len(texts))
    assert np.isclose(move.sum(), sum(len(t) - 1 for t in texts))
    assert np.allclose(emit.sum(axis=1), np.bincount(np.concatenate(texts), minlength=5))
    monkeypatch.setattr(hmm_lm, "SEGMENT", 10_000)
    whole = model.expected(texts)
    assert np.allclose(start, whole[0], rtol=1e-6) and np.isclose(total[0], whole[3][0], rtol=1e-6)
    assert np.allclose(move, whole[1], rtol=5e-3) and np.allclose(emit, whole[2], rtol=5e-3)
    assert np.isclose(whole[3][0], model.log10(texts).sum())


def test_training_sees_all_rows_and_the_likelihood_grows(spark):
    rows = [(k, " ".join(words(k, 60, 40) if k % 2 else [w.upper() + "x" for w in words(k, 60, 40)]))
            for k in range(120)]
    docs = documents(spark, rows).select("doc_id", "text")
    counts = docs.mapInArrow(lambda it: hmm_lm._word_counts(b.select(["text"]) for b in it),
                             "word binary, class int, n long").groupBy("word", "class").agg(
        F.sum("n").alias("c"))
    lex = hmm_lm.lexicon(counts)
    shared = spark.sparkContext.broadcast(lex)
    encoded = docs.mapInArrow(
        lambda it: hmm_lm._encoded(it, shared),
        "row long, doc_id long, symbols binary, n_tokens long, known long, head_log double, "
        "class_log double, rare array<binary>, rare_n array<long>").select(
        "row", "n_tokens", "symbols")
    seen = []
    model = hmm_lm.train(encoded, lex, states=4, blocks=4, seen=seen)
    assert len(seen) >= hmm_lm.LEAST_PASSES and seen[-1] > seen[0]
    texts = [np.frombuffer(r["symbols"], np.uint16) for r in encoded.collect()]
    flat = np.concatenate(texts)
    unigram = np.bincount(flat, minlength=lex.size) / len(flat)
    assert model.log10(texts).sum() > np.log10(unigram[flat]).sum()
    # the counts of one pass over all blocks are those of one machine
    whole = model.expected(texts)
    blocks = [hmm_lm._block_counts(encoded.where(f"pmod(xxhash64(row), 3) = {b}"), model)
              for b in range(3)]
    for a, parts in zip(whole, zip(*blocks, strict=True), strict=True):
        assert np.allclose(a, sum(parts))


def test_quality_sums_equal_a_solve_on_one_machine(spark):
    docs, labels, _, _ = _labelled(spark)
    x = quality.document_statistics(docs, "doc_id", "text")
    rows = x.join(labels.selectExpr("doc_id AS label_id", "quality AS label"),
                  F.col("doc_id") == F.col("label_id")).where("label IS NOT NULL").select(
        "doc_id", "x", "label").repartition(7)
    model = quality.fit(rows)
    held = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    got = rows.select("x", "label", held.alias("held")).collect()
    a, y = np.array([r["x"] for r in got]), np.array([r["label"] for r in got], dtype=float)
    assert np.allclose(model.mean, a.mean(axis=0))
    assert np.allclose(model.scale[a.std(axis=0) > 1e-4], a.std(axis=0)[a.std(axis=0) > 1e-4])
    fit = ~np.array([r["held"] for r in got])
    phi = model.features(a[fit])
    penalty = quality.RIDGE * fit.sum() * np.eye(phi.shape[1]) / quality.FEATURES
    penalty[-1, -1] = 1e-9
    want = np.linalg.solve(phi.T @ phi + penalty + 1e-9 * np.eye(len(penalty)), phi.T @ y[fit])
    assert np.allclose(model.weights, want, rtol=1e-5, atol=1e-8)
    assert np.allclose(model.raw(a[:50]), model.features(a[:50]) @ want, atol=1e-6)


def test_toxicity_search_holds_one_part_of_the_index_at_a_time(spark):
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(120):
        cols = np.sort(rng.choice(60, 12, replace=False)).astype(np.int32)
        weights = rng.random(12)
        vectors.append((cols, weights / np.sqrt((weights * weights).sum())))
    examples = spark.createDataFrame(
        [(k, c.tolist(), w.tolist(), k % 2, 1) for k, (c, w) in enumerate(vectors)],
        "name long, cols array<int>, weights array<double>, ones long, n long")
    path, parts = toxicity.index_parts(examples, 30)
    assert parts == 4
    dense = np.zeros((120, 60))
    for k, (c, w) in enumerate(vectors):
        dense[k, c] = w
    queries = vectors[:40]
    got = toxicity.neighbours([(c.tobytes(), w.tobytes()) for c, w in queries], path, parts, 5)
    assert len(toxicity._PART) == 1
    for (c, w), near in zip(queries, got, strict=True):
        truth = np.round(dense[:, c] @ w, 9)
        assert np.allclose([s for s, _, _ in near], np.sort(truth)[::-1][:5], atol=2e-9)
        assert all(abs(truth[name] - s) < 2e-9 and share == name % 2 for s, share, name in near)


def test_toxicity_whole_lists_score_as_blocks_do():
    rng = np.random.default_rng(6)
    examples = []
    for k in range(300):
        cols = np.sort(rng.choice(80, 20, replace=False)).astype(np.int32)
        weights = rng.random(20)
        examples.append((k, cols, weights / np.sqrt((weights * weights).sum()), 0, 1))
    index = toxicity.BlockMaxIndex.build(examples, 8)
    for _, cols, weights, _, _ in examples[:30]:
        entry, of = toxicity._ranges(index.lists, cols.astype(np.int64))
        assert (index._all_scores(cols, weights, 10)
                == index._scores(entry, weights[of], np.ones(len(entry), bool), 10)
                == index.nearest(cols, weights, 10))


@pytest.mark.parametrize("share, dense", [(16, 512), (2, 3), (1, 0)])
def test_many_queries_at_once_find_the_same_neighbours(monkeypatch, share, dense):
    monkeypatch.setattr(toxicity, "DENSE_SHARE", share)
    monkeypatch.setattr(toxicity, "DENSE_TERMS", dense)
    rng = np.random.default_rng(5)

    def vector(terms):
        cols = np.unique(np.minimum(rng.geometric(0.08, 12), terms) - 1).astype(np.int32)
        weights = rng.random(len(cols)) + 0.1
        return cols, weights / np.sqrt((weights * weights).sum())

    examples = [(k, *vector(40), k % 2, 1) for k in range(300)]
    examples += [(300 + k, *examples[k][1:3], 1, 1) for k in range(30)]     # ties
    index = toxicity.BlockMaxIndex.build(examples, 8)
    queries = [vector(60) for _ in range(150)] + [(c, w) for _, c, w, _, _ in examples[:20]]
    queries += [(np.zeros(0, np.int32), np.zeros(0)), (np.array([55], np.int32), np.ones(1))]
    for k in (1, 10, 400):
        assert list(index.nearest_of_many(queries, k)) == [
            index.nearest(c, w, k) for c, w in queries]
    empty = toxicity.BlockMaxIndex.build([], 8)
    assert list(empty.nearest_of_many(queries[:3], 10)) == [[], [], []]


def _kinds_of_examples(n):
    """Vectors of two vocabularies that share five terms, and the index over them."""
    rng = np.random.default_rng(8)
    vectors = []
    for k in range(n):
        cols = np.unique(np.append(rng.choice(60, 25) + 5 + 60 * (k % 2), rng.choice(5, 2)))
        weights = rng.random(len(cols)) + 0.1
        vectors.append((cols.astype(np.int32), weights / np.sqrt((weights * weights).sum())))
    return vectors, toxicity.BlockMaxIndex.build(
        [(k, *v, 0, 1) for k, v in enumerate(vectors)], 8)


def test_kinds_of_examples_have_dense_rows_of_their_own_terms(monkeypatch):
    vectors, index = _kinds_of_examples(400)
    # a matrix over all examples has 125 rows of 400; examples of a kind lack half of the terms
    assert sum(k.dense.size for k in index._by_kind[0]) < 0.7 * 125 * 400
    assert sum(k.stop - k.first for k in index._by_kind[0]) == 400
    got = index.nearest_of_many(vectors, 10)
    assert got == [index.nearest(c, w, 10) for c, w in vectors]
    # lists read in slices, and with few dense rows
    monkeypatch.setattr(toxicity, "LISTED", 50)
    monkeypatch.setattr(toxicity, "DENSE_TERMS", 3)
    del index.__dict__["_by_kind"]
    assert got == index.nearest_of_many(vectors, 10)
    # with a bound, nothing that reaches it is missed
    least = np.array([found[4][0] for found in got])
    for found, few in zip(got, index.nearest_of_many(vectors, 10, least), strict=True):
        assert few[:5] == found[:5]


def test_neighbours_closer_than_single_precision_are_told_apart():
    # 30 examples that differ by 1e-8 of a similarity, in falling order
    share = 0.5 - 1e-8 * np.arange(30)
    examples = [(k, np.array([0, 1 + k], np.int32),
                 np.array([s, np.sqrt(1 - s * s)]), 0, 1) for k, s in enumerate(share)]
    index = toxicity.BlockMaxIndex.build(examples, 8)
    queries = [(np.array([0], np.int32), np.ones(1))] * 40
    for found in index.nearest_of_many(queries, 10):
        assert [index.names[i] for _, i in found] == list(range(10))
        assert [s for s, _ in found] == [round(s, 9) for s in share[:10].tolist()]


def test_vectors_count_words_and_their_starts(monkeypatch):
    found = ["bb", "word", "word*", "wordy", "wordy*", "wordyest"]
    table = pa.table({"term": found, "weight": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    text = "Word wordy WORDYEST wordyest bb unknown wordsmith"
    for words in (100_000, 1):      # kept columns of words, or not
        monkeypatch.setattr(toxicity, "_WORDS", words)
        known = toxicity.Vocabulary(table)
        for _ in range(2):
            cols, weights = toxicity._vector(text, known)
            counts = toxicity.terms(text)
            want = np.array([(1 + np.log(counts[t])) * (i + 1) for i, t in enumerate(found)])
            assert cols.tolist() == list(range(6)) and cols.dtype == np.int32
            assert np.allclose(weights, want / np.sqrt((want * want).sum()), rtol=1e-14)
    assert counts["word*"] == 4 and counts["wordy*"] == 2 and counts["wordyest"] == 2
    assert [len(x) for x in toxicity._vector("", known)] == [0, 0]
