"""Quality rules by line sequence labelling.

A linear-chain conditional random field over the lines of a text marks each as
content or boilerplate; Viterbi decoding finds the likeliest marks.  A text is
kept when lines of content hold at least ``SHARE`` of its words (in bytes) and
the base rules (length, repetition) pass.

Line features: sizes, shares of symbols, capitals, digits, marks and short
words, repetition in the line and of the line in its text, place in the text,
and the words of short lines (hashed).

Training lines come from labelled documents, ``max_train`` of them at most
(picked by hash of the id): lines of documents labelled bad are boilerplate;
lines of the others are content, except those that stand in the corpus between
at least ``CONTEXTS`` different pairs of neighbouring lines.  These counts cover
the whole corpus; copies of a text share their contexts, so a text does not
become boilerplate by being copied.  Every text is decoded whole.

Cases: null and empty texts have no words and fail the base rules; lines
without a word are no part of the chain; without labelled documents all lines
count as content, so the base rules alone decide; labels with a null id or
value are left out, of several labels of a document the largest counts; rows
may repeat, null ids stay; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import stored
from tickframe.llm.html_extract import FEATURES, Chain, train
from tickframe.llm.kernels import bounded, one_label

MAX_TRAIN = 4000
CONTEXTS = 10
SHARE = 0.5
ROUNDS = 30
MIN_WORDS = 10
REPEATED = 20           # percent of the words in repeated windows
WINDOW = 5
SHORT_LINE = 12         # words; longer lines have no word features
_FIRST_WORD = 128       # features below are those of a line's shape

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = b"abcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEPS = (0.0, 0.05, 0.15, 0.3, 0.5, 0.75)


def _without(text: bytes, chars: bytes) -> int:
    """How many of ``chars`` a text has."""
    return len(text) - len(text.translate(None, chars))


def _grade(share: float) -> int:
    return sum(share > s for s in _STEPS)


def line_features(line: bytes, words: list[bytes], place: int, last: bool,
                  seen: bool) -> list[int]:
    """Active features of one line."""
    n, size = len(words), len(line)
    upper, lower = _without(line, _UPPER), _without(line, _LOWER)
    end, head = line.rstrip(_SPACE)[-1:], words[0][:1]
    grades = (min(7, n.bit_length()), _grade(_without(line, _SYMBOLS) / n),
              _grade(_without(line, b"!") / n), _grade(upper / max(1, upper + lower)),
              _grade(_without(line, _DIGITS) / size), min(7, size // (2 * n)),
              _grade(1 - len(set(words)) / n),
              _grade(sum(len(w) < 4 for w in words) / n),
              _grade(_without(line, b".,;:") / n),
              0 if end in b".?" else 1 if end in b"!" else 2,
              0 if head in _UPPER else 1 if head in _LOWER else 2,
              int(place == 0) + 2 * last, int(seen))
    out = [127, *(8 * i + g for i, g in enumerate(grades))]
    if n <= SHORT_LINE:
        room = FEATURES - _FIRST_WORD
        out += {_FIRST_WORD + zlib.crc32(w.lower()) % room for w in words}
    return out


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in windows that are found twice or more in a text."""
    n = len(words)
    if n <= window:
        return 0
    code = np.fromiter(map(zlib.crc32, words), np.uint64, n)
    mixed = code[:n - window + 1].copy()
    for k in range(1, window):
        mixed = mixed * _ODD + code[k:n - window + 1 + k]
    if len(np.unique(mixed)) == len(mixed):
        return 0
    # some codes repeat: exact names of the windows, word by word
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    name = ids
    for k in range(1, window):
        name = np.unique(name[:n - k] * len(known) + ids[k:], return_inverse=True)[1]
    twice = np.bincount(name)[name] > 1
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[:n - window + 1] += twice
    edge[window:] -= twice
    return int((np.cumsum(edge)[:n] > 0).sum())


class LineChain(Chain):
    """The chain with its emissions summed for all lines of a text at once."""

    def _scores(self, active: list[list[int]]) -> np.ndarray:
        sizes = np.fromiter(map(len, active), np.int64, len(active))
        flat = np.fromiter((f for a in active for f in a), np.int64, int(sizes.sum()))
        out = np.add.reduceat(self.emit[flat], np.cumsum(sizes) - sizes)
        out[0] += self.ends[0]
        out[-1] += self.ends[1]
        return out


def described(text: bytes) -> tuple[list[list[int]], list[int], list[int], list[bytes], int]:
    """A text's lines with words: features, word characters, places; its words; repeated lines."""
    lines = text.split(b"\n")
    rows = [(i, line, words) for i, line in enumerate(lines) if (words := line.split())]
    active, sizes, places, all_words = [], [], [], []
    earlier: set[bytes] = set()
    for k, (i, line, words) in enumerate(rows):
        active.append(line_features(line, words, k, k + 1 == len(rows), line in earlier))
        earlier.add(line)
        sizes.append(sum(map(len, words)))
        places.append(i)
        all_words += words
    return active, sizes, places, all_words, len(rows) - len(earlier)


def shared_lines(docs: DataFrame, text_col: str, contexts: int) -> DataFrame:
    """Hashes of the lines that stand between many different pairs of neighbours."""
    lines = docs.select(F.filter(F.split(F.col(text_col), "\n"),
                                 lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    places = lines.select(F.explode(F.transform("lines", lambda x, i: F.struct(
        F.xxhash64(x).alias("line"),
        F.xxhash64(F.get("lines", i - 1), F.get("lines", i + 1)).alias("context")))).alias("at"))
    return (places.select("at.line", "at.context").distinct().groupBy("line")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= contexts).select("line"))


def labelled_lines(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                   max_train: int, contexts: int) -> DataFrame:
    """Rows (active, labels) of the labelled documents, one a document."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        one_label(labels, label_col, id_col), F.col("doc_id") == F.col("label_id"))
    known = stored(bounded(known, F.col("doc_id"), max_train).select(
        F.monotonically_increasing_id().alias("row"), "text", "label"), "line-train")
    shared = shared_lines(docs, text_col, contexts)
    marked = (known.select("row", F.posexplode(F.split("text", "\n")).alias("place", "line"))
              .select(F.col("row").alias("at"), "place", F.xxhash64("line").alias("line"))
              .join(shared, "line", "left_semi").groupBy("at")
              .agg(F.collect_list("place").alias("shared")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label, common in zip(*(batch.column(c).to_pylist()
                                             for c in ("text", "label", "shared")), strict=True):
                active, _, places, _, _ = described((text or "").encode())
                common = set(common or ())
                if active:
                    rows.append((active, [int(label and i not in common) for i in places]))
            yield pa.record_batch([pa.array([a for a, _ in rows], pa.list_(pa.list_(pa.int32()))),
                                   pa.array([y for _, y in rows], pa.list_(pa.int32()))],
                                  ["active", "labels"])

    return stored(known.join(marked, F.col("row") == F.col("at"), "left")
                  .select("text", "label", "shared")
                  .mapInArrow(run, "active array<array<int>>, labels array<int>"), "line-labels")


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_content_lines long, "
          "content_bytes long")


def judge(text: str | None, model: Chain | None, share: float = SHARE) -> tuple:
    """The values of ``RESULT`` for one text."""
    text = text or ""
    raw = text.encode()
    active, sizes, _, words, dup_lines = described(raw)
    n, chars, repeats = len(words), len(text) - _without(raw, _SPACE), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEATED * n
    marks = [1] * len(active) if model is None else model.viterbi(active)
    content = sum(s for s, y in zip(sizes, marks, strict=True) if y)
    return (n, chars, _without(raw, _SYMBOLS), dup_lines, repeats, failed,
            not failed and content >= share * sum(sizes), len(active), sum(marks), content)


def line_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "quality", max_train: int = MAX_TRAIN,
                 contexts: int = CONTEXTS, share: float = SHARE,
                 rounds: int = ROUNDS) -> DataFrame:
    """doc_id and the columns of ``RESULT`` for every row of ``docs``."""
    known = labelled_lines(docs, labels, id_col, text_col, label_col, max_train, contexts)
    model = None
    if not known.isEmpty():
        fit = train(known, rounds)
        model = LineChain(fit.emit, fit.step, fit.ends)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c.split(" ")[0] for c in RESULT.split(", ")]
    kinds = [pa.bool_() if c.endswith("boolean") else pa.int64() for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t, shared.value, share) for t in batch.column("text").to_pylist()]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(list(c), k)
                                           for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *names])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {RESULT}")
