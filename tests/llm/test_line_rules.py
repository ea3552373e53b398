import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import line_rules


def base(text):
    """The base columns straight from their definitions."""
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    at = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if at[tuple(w[i:i + 5])] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), failed)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, label string")


def good(seed):
    draw = random.Random(seed)
    return "\n".join(" ".join(words(seed * 50 + i, draw.randrange(5, 30))).capitalize() + "."
                     for i in range(draw.randrange(2, 7)))


def bad(seed):
    w = words(seed, 40)
    return " | ".join(w[:20]) + "\n" + " ".join(x.upper() + "!!" for x in w[20:])


def mixed(seed):
    """Mostly boilerplate around one line of content."""
    return bad(seed) + "\n" + " ".join(words(seed, 12)).capitalize() + ".\n" + bad(seed + 1)


def odd_texts():
    return [*(t for _, t in odd_rows()), "a b c d e f a b c d e f", "a a a a a a", "a b c d e",
            "x y z w v\n" * 30, "one\x0btwo\x0cthree\rfour\tfive #*$%&|<> \x85 　",
            "\n\n a \n a\n a \n", " ".join(words(3, 500, 8)), " ".join(words(4, 500, 50)),
            "p q r s t p q r s t u", "p q r s p q r s p q r s"]


@pytest.mark.parametrize("text", odd_texts(), ids=range(len(odd_texts())))
def test_base_columns(text):
    if text is not None and len(text) > 100_000:
        text = text[:40_000]            # the definition is quadratic in lines only
    assert line_rules.judge(text, None)[:6] == base(text)


def test_whole_table_and_odd_rows(spark):
    rows = [*odd_rows(), *((100 + i, good(i)) for i in range(60)),
            *((200 + i, bad(i)) for i in range(60)), *((300 + i, mixed(i)) for i in range(10))]
    known = labels(spark, [*((100 + i, 1, 0, "x") for i in range(40)),
                           *((200 + i, 0, 0, "x") for i in range(40)), (100, None, 0, "x"),
                           (None, 0, 1, "x"), (999, 1, 1, "x")])
    got = line_rules.line_quality(documents(spark, rows), known).collect()
    assert sorted(map(repr, (r["doc_id"] for r in got))) == sorted(repr(i) for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in got:
        want = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"], r["base_failed"]) == want
        if r["base_failed"]:
            assert not r["kept"]
        elif (r["doc_id"] or 0) >= 100:
            assert r["kept"] == (r["doc_id"] < 200)
    held_out = [r for r in got if (r["doc_id"] or 0) >= 300]
    assert all(0 < r["n_content_lines"] < r["n_lines"] for r in held_out)


def test_lines_between_many_neighbours(spark):
    copies = [(i, "one line here\nshared by copies\nand an end") for i in range(40)]
    boiler = [(100 + i, f"body {i}\nAll rights reserved.\nmore {i}") for i in range(12)]
    found = line_rules.shared_lines(documents(spark, copies + boiler), "text", 10)
    want = spark.sql("SELECT xxhash64('All rights reserved.')").first()[0]
    assert [r["line"] for r in found.collect()] == [want]


def test_shared_lines_are_learnt_as_boilerplate(spark):
    rows = [(i, f"{good(i)}\nAll rights reserved worldwide.\n{good(i + 500)}") for i in range(40)]
    got = line_rules.labelled_lines(documents(spark, rows), labels(spark, [
        (i, 1, 0, "") for i in range(40)]), "doc_id", "text", "quality", 4000, 10).collect()
    assert len(got) == 40 and all(r["labels"].count(0) == 1 for r in got)


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(1)
    for n in range(1, 8):
        chain = line_rules.LineChain(draw.normal(size=(line_rules.FEATURES, 2)),
                                     draw.normal(size=(2, 2)), draw.normal(size=(2, 2)))
        active = [draw.choice(line_rules.FEATURES, 5).tolist() for _ in range(n)]

        def value(path, chain=chain, active=active):
            return (sum(chain.emit[a, y].sum() for a, y in zip(active, path, strict=True))
                    + sum(chain.step[a, b] for a, b in itertools.pairwise(path))
                    + chain.ends[0, path[0]] + chain.ends[1, path[-1]])

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(chain.viterbi(active)) == best


def test_without_labels_and_empty(spark):
    none = labels(spark, [])
    got = line_rules.line_quality(documents(spark, [(1, good(1)), (2, "short")]), none)
    assert {r["doc_id"]: r["kept"] for r in got.collect()} == {1: True, 2: False}
    assert line_rules.line_quality(documents(spark, []), none).collect() == []
