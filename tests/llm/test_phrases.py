import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.helpers import CLASH, LONG, words
from tickframe.llm import phrases


def documents(spark, rows):
    schema = "lang string, text string, " + ", ".join(
        f"`{c}` string" for c in (*CLASH, "phrase", "rank", "slot", "shard", "cnt", "len", "n"))
    return spark.createDataFrame([(*r, *["clash"] * (len(CLASH) + 7)) for r in rows], schema)


def counts(rows, threshold, length=4):
    found, totals = Counter(), Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(w)
            for k in range(1, length + 1):
                found.update(("und" if lang is None else lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    return {p: n for p, n in found.items() if n >= threshold}, totals


def brute(rows, threshold, inside=80, top=2000):
    f, totals = counts(rows, threshold)
    out = {}
    for p, a in f.items():
        lang, w = p[0], p[1:]
        if len(w) < 2:
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
        longer = max((n for q, n in f.items() if q[0] == lang and len(q) > len(p)
                      and any(q[i:i + len(w)] == w for i in range(1, len(q)))), default=0)
        if 100 * longer < inside * a:
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]],
                                             f[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, totals[lang], -s)
                  for lang, found in out.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


def corpus(seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(150):
        w = words(seed * 1000 + i, draw.randrange(1, 80), 25)
        marks = [x + draw.choice(["", "", "", ".", ", ", "\n", ";", "\t", "\x0c"]) for x in w]
        rows.append((draw.choice(["en", "en", "en", "de", None]), " ".join(marks)))
    return rows


def odd():
    return [("en", None), ("en", ""), ("en", " \n\t"), (None, "Alpha BETA gamma Delta. alpha beta"),
            ("und", "alpha beta gamma delta"), ("und", "alpha  beta\tgamma delta,alpha"),
            ("fr", "été ÉTÉ. été ÉTÉ. été x y"), ("fr", "été ÉTÉ! été ÉTÉ? . . été x y"),
            ("xx", LONG), ("", "a a a a a a a a a")]


@pytest.mark.parametrize("shards,slot_bits", [(4, 24), (1, 20), (3, 6)])
def test_counts_equal_brute_force(spark, shards, slot_bits):
    rows = corpus() + odd()
    found, totals = phrases.frequent_phrases(documents(spark, rows), threshold=3, shards=shards,
                                             slot_bits=slot_bits)
    want, n = counts(rows, 3)
    assert {(r["lang"], *r["phrase"].split(" ")): r["f"] for r in found.collect()} == want
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in n.items() if v}


def late(seed, shard):
    """A word that is frequent in shard 2 only, after words that are so everywhere."""
    found, i = [], 0
    for draw in [f"a{seed} b{seed}"] * 150 + [f"c{seed} a{seed} b{seed} z{seed} y{seed}"] * (
            60 if shard == 2 else 3):
        while True:
            i += 1
            text = f"q{i}.{draw}"
            if zlib.crc32(text.encode().replace(b".", b" . ")) % 3 == shard:
                found.append(("en", text))
                break
    return found


def test_slots_that_others_filled_earlier(spark):
    """Phrases of a late word, in slots that reached the threshold before it did."""
    for seed in (1, 7):
        rows = [r for shard in range(3) for r in late(seed, shard)]
        found, _ = phrases.frequent_phrases(documents(spark, rows), threshold=30, shards=3,
                                            slot_bits=4)
        assert {(r["lang"], *r["phrase"].split(" ")): r["f"]
                for r in found.collect()} == counts(rows, 30)[0]


@pytest.mark.parametrize("top", [5, 2000])
def test_collocations_equal_brute_force(spark, top):
    rows = corpus(2) + odd()
    got = phrases.collocations(documents(spark, rows), threshold=3, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, top=top)


def test_one_piece_without_separators(spark):
    rows = [("en", " ".join(words(5, 60_000, 40)))]
    got = phrases.collocations(documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows, 30)


def test_large_counts_are_exact():
    """2000000 * a passes 64 bits."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    a = 9_000_000_000_000_000
    got = spark.sql(f"SELECT CAST(CAST({phrases.SCALE} AS DECIMAL(8, 0)) * CAST({a}L AS "
                    f"DECIMAL(19, 0)) div (CAST({a}L AS DECIMAL(19, 0)) + CAST({a + 1}L AS "
                    "DECIMAL(19, 0))) AS BIGINT)").first()[0]
    assert got == 2_000_000 * a // (2 * a + 1)


def test_empty(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [("en", None)])).collect() == []


def test_scans_are_read_as_one_table_and_slots_travel_as_words(spark, tmp_path):
    slots = [[0, 63, 64, 1000], [63, 4095], [7]]
    paths = []
    for k, found in enumerate(slots):
        paths.append(str(tmp_path / f"scan-{k}"))
        spark.createDataFrame([(2, "en", f"a {s}", s, 2) for s in found],
                              phrases.COUNTED).write.parquet(paths[-1])
    rows = phrases._together(spark, paths)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    packed = phrases._bits(rows, 4096)
    assert packed.nbytes == 4096 // 8
    assert phrases._slots_of(packed).tolist() == sorted(set(sum(slots, [])))
    asked = packed.copy()
    asked[0] = 1 << 63
    assert sorted(r.slot for r in phrases._in_slots(rows, asked).collect()) == [
        63, 63, 64, 1000, 4095]
    full = phrases._full_slots(rows, packed, 4, phrases.F.lit(True)).collect()
    assert [(r.slot, r.n) for r in full] == [(63, 4)]
    assert phrases._slots_of(phrases._bits(rows.where("false"), 4096)).tolist() == []
