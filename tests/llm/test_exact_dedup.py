from collections import defaultdict
from hashlib import sha256

from tests.llm.helpers import documents, odd_rows, words
from tickframe.llm import exact_dedup as ed


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_lower(t)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def _check(spark, rows, block_bytes=16):
    got = ed.exact_groups(documents(spark, rows), block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got),
                  key=str) == _brute(rows)
    assert sum(r.kept for r in got) == len({_lower(t) for _, t in rows})


def test_odd_rows(spark):
    _check(spark, odd_rows(), block_bytes=4096)


def test_many_levels_and_shared_blocks(spark):
    # texts that share blocks in other orders and lengths must not meet
    a, b = "x" * 16, "y" * 16
    texts = [a, a + b, b + a, a + b + a, a + b + a + b, a * 7, a * 8, a * 8 + "z", a * 8]
    _check(spark, list(enumerate(texts)))


def test_hot_group(spark):
    rows = [(i, "Same text " * 9) for i in range(200)] + [
        (1000 + i, " ".join(words(i, 12))) for i in range(100)]
    _check(spark, rows)


def test_drop_keeps_columns_and_one_of_repeated_rows(spark):
    docs = documents(spark, odd_rows())
    kept = ed.drop_exact_copies(docs, block_bytes=64)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i) == [2, 3, 5, 6, 8, 9, 10] and None not in got


def test_empty_table(spark):
    assert ed.exact_groups(documents(spark, [])).count() == 0
