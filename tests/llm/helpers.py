"""Small tables with every odd case, and brute-force versions of the operators."""

import random

CLASH = ("rid", "name", "levels", "row", "path", "s", "word", "chunk", "bucket", "ids", "score",
         "label", "x", "window", "at", "tokens", "part", "start")
LONG = " ".join(f"w{i % 977} thing," for i in range(30_000))


def documents(spark, rows):
    """Rows (doc_id, text) as a documents table with extra columns of clashing names."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              + ", ".join(f"`{c}` string" for c in CLASH))
    return spark.createDataFrame(
        [(i, t, "en", "src0", len(t or ""), *["clash"] * len(CLASH)) for i, t in rows], schema)


def odd_rows():
    """Nulls, empty and blank texts, repeated rows, a null id and a very long text."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "Alpha beta"), (5, "ALPHA BETA"),
            (5, "ALPHA BETA"), (None, "alpha beta"), (6, "été ÉTÉ ß İ ñandú"), (7, LONG),
            (8, LONG), (9, "日本 語 テスト 🙂"), (10, "a<|endoftext|>b <|STARTOFTEXT|>")]


def words(seed, n, pool=4000):
    draw = random.Random(seed)
    return [f"t{draw.randrange(pool)}" for _ in range(n)]
