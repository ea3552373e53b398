"""Hidden Markov language model, trained and scored over a whole corpus.

Symbols.  The ``SYMBOLS`` most frequent training words have a symbol each; all
other words, seen or not, fall into ``CLASSES`` classes by their last bytes.
Within its class a word has its add-one share of the class's training count
(one more share stands for all unseen words), so the model is a distribution
over all texts: P(text) = P(symbols) * P(words | their classes).

Training.  Word counts, class totals and Baum-Welch counts cover all training
texts.  Texts are cut into segments of ``SEGMENT`` tokens; every partition runs
the scaled forward and backward recursions over its segments and sums expected
transition, start and emission counts; the partitions' sums are added up in
Spark.  A segment's forward recursion begins ``WARM`` tokens before it, so that
it carries on the state of the text; starts are counted at texts' starts only.

The corpus is taken in ``BLOCKS`` blocks (by hash of the row).  After each block
its counts replace those of its last visit and the model is estimated again
from the counts of all blocks (incremental Baum-Welch), so one pass over the
corpus makes many steps.  Passes go over all training texts until, after
``LEAST_PASSES``, the likelihood grows by less than ``SETTLED`` of itself,
``PASSES`` at most.

Scoring.  The scaled forward recursion runs over each whole text, with memory
for one state vector a text, and gives its exact likelihood.

Counts of up to ``TABLE`` of the most frequent words are broadcast; those of all other
words, as many as the corpus has, are joined to the texts that have them.

Cases: null and empty texts are the end token alone; repeated rows are scored,
and count in training, one by one; without a training text both scores are 0
for the end token and any word; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import stored
from tickframe.llm.kernels import tree_sum

STATES = 12
SYMBOLS = 4096
CLASSES = 1024
TABLE = 131_072
SEGMENT = 256
WARM = 24
BLOCKS = 16
LEAST_PASSES = 3
PASSES = 12
SETTLED = 0.01
EMISSION_PRIOR = 20.0
_FLUSH = 300_000
END = b""


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII white space."""
    return (text or b"").lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        found = list(counts.items())
        counts.clear()
        return pa.record_batch([pa.array([w for w, _ in found], pa.binary()),
                                pa.array([class_of(w) for w, _ in found], pa.int32()),
                                pa.array([n for _, n in found], pa.int64())],
                               ["word", "class", "n"])

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > _FLUSH:
                yield flush()
    yield flush()


@dataclass
class Lexicon:
    """Counts of frequent words, and which of them are symbols."""

    index: dict[bytes, int]
    counts: np.ndarray
    symbols: np.ndarray
    class_totals: np.ndarray
    first_class: int
    tokens: int
    types: int
    least: int

    @property
    def size(self) -> int:
        return self.first_class + CLASSES


def _magnitude() -> Column:
    """Counts on a logarithmic scale: some thousand values, however large the corpus."""
    return F.floor(F.log2("c") * 256).cast("int")


def lexicon(counts: DataFrame) -> Lexicon:
    """From rows (word, class, c); collects ``TABLE`` words and ``CLASSES`` totals."""
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # the lowest magnitude of counts that at most TABLE words reach, so that no sort is needed
    least, room = 1 << 20, TABLE - 1
    for r in sorted(counts.groupBy(_magnitude().alias("m")).agg(F.count(F.lit(1)).alias("n"))
                    .collect(), reverse=True):
        if r["n"] > room:
            break
        least, room = r["m"], room - r["n"]
    # the end token always has a symbol
    top = counts.where((_magnitude() >= least) | (F.length("word") == 0)).collect()
    top.sort(key=lambda r: (len(r["word"]) > 0, -r["c"], bytes(r["word"])))
    words = [bytes(r["word"]) for r in top]
    c = np.array([r["c"] for r in top], dtype=np.int64)
    first_class = min(SYMBOLS, len(words))
    symbols = np.array([i if i < first_class else first_class + class_of(w)
                        for i, w in enumerate(words)], dtype=np.uint16)
    totals = np.ones(CLASSES)
    for r in counts.groupBy("class").agg(F.sum(F.col("c") + 1).alias("t")).collect():
        totals[r["class"]] += r["t"]
    for i, w in enumerate(words[:first_class]):
        totals[class_of(w)] -= c[i] + 1
    return Lexicon({w: i for i, w in enumerate(words)}, c, symbols, totals, first_class,
                   tokens, types, least)


def _encoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Symbols of each text, its sums over known frequent words, and its other words."""
    lex = shared.value
    row = TaskContext.get().partitionId() << 33
    log_count = np.log10(lex.counts + 1.0)
    log_class = np.log10(lex.class_totals)
    get = lex.index.get
    for batch in batches:
        out = []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            words = words_of(text)
            words.append(END)
            at = np.array([get(w, -1) for w in words], dtype=np.int64)
            known = at >= 0
            symbols = np.empty(len(words), dtype=np.uint16)
            symbols[known] = lex.symbols[at[known]]
            rare = [words[i] for i in np.flatnonzero(~known)]
            symbols[~known] = [lex.first_class + class_of(w) for w in rare]
            if not lex.first_class:
                symbols[-1] = 0
            classed = symbols >= lex.first_class
            head = log_count[at[known]]
            found = Counter(w for w in rare if w)
            out.append((symbols.tobytes(), len(words), int(known.sum()), float(head.sum()),
                        float(log_count[at[known & classed]].sum()
                              - log_class[symbols[classed].astype(np.int64)
                                          - lex.first_class].sum()),
                        list(found), list(found.values())))
        cols = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                 pa.list_(pa.binary()), pa.list_(pa.int64())]
        yield pa.record_batch(
            [pa.array(np.arange(row, row + len(out))), batch.column(0),
             *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
            ["row", "doc_id", "symbols", "n_tokens", "known", "head_log", "class_log",
             "rare", "rare_n"])
        row += len(out)


@dataclass
class Hmm:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # symbols x states

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of whole symbol sequences, by scaled forward recursion."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lens = np.array([len(texts[i]) for i in order])
        out = np.zeros(len(texts))
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else lens
        flat = np.concatenate([texts[i] for i in order]) if texts else np.zeros(0, np.uint16)
        state = np.broadcast_to(self.start, (len(texts), len(self.start)))
        alive = len(texts)
        for t in range(int(lens[0]) if len(lens) else 0):
            while alive and lens[alive - 1] <= t:
                alive -= 1
            state = state[:alive] * self.emit[flat[starts[:alive] + t]]
            scale = state.sum(axis=1)
            out[:alive] += np.log10(scale)
            state = (state / scale[:, None]) @ self.step
        back = np.empty(len(texts))
        back[order] = out
        return back

    def expected(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Baum-Welch counts of texts: starts, transitions, emissions, log10 likelihood."""
        k, size = len(self.start), len(self.emit)
        # (tokens, how many of the first are there to warm up)
        parts = [(t[max(0, i - WARM):i + SEGMENT], min(i, WARM))
                 for t in texts for i in range(0, len(t), SEGMENT)]
        total = [np.zeros(k), np.zeros((k, k)), np.zeros((size, k)), np.zeros(1)]
        parts.sort(key=lambda p: len(p[0]), reverse=True)
        for i in range(0, len(parts), 1024):
            for a, b in zip(total, self._batch(parts[i:i + 1024]), strict=True):
                a += b
        return total

    def _batch(self, parts: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
        k, n = len(self.start), len(parts)
        lens = np.array([len(p) for p, _ in parts])
        warm = np.array([w for _, w in parts])
        longest = int(lens[0]) if n else 0
        grid = np.zeros((longest, n), dtype=np.int64)
        for i, (p, _) in enumerate(parts):
            grid[:len(p), i] = p
        at = np.arange(longest)[:, None]
        alive = (lens[None, :] > at).sum(axis=1)
        counted = (at >= warm[None, :]) & (at < lens[None, :])
        forward = np.zeros((longest, n, k))
        scales = np.ones((longest, n))
        state = np.broadcast_to(self.start, (n, k))
        for t in range(longest):
            m = alive[t]
            state = state[:m] * self.emit[grid[t, :m]]
            scales[t, :m] = state.sum(axis=1)
            state = state / scales[t, :m, None]
            forward[t, :m] = state
            state = state @ self.step
        move = np.zeros((k, k))
        # forward becomes the posterior of each position, from the last to the first
        back = np.ones((n, k))
        for t in range(longest - 1, 0, -1):
            m = alive[t]
            forward_t = forward[t, :m]
            right = self.emit[grid[t, :m]] * back[:m] / scales[t, :m, None]
            before = forward[t - 1, :m]
            if t <= WARM:
                move += (before[counted[t, :m]].T @ right[counted[t, :m]]) * self.step
            else:
                move += (before.T @ right) * self.step
            forward[t, :m] = forward_t * back[:m]
            back[:m] = right @ self.step.T
        if longest:
            forward[0] *= back
        emit = np.zeros((len(self.emit), k))
        flat, post = grid[counted], forward[counted]
        for s in range(k):
            emit[:, s] = np.bincount(flat, post[:, s], len(self.emit))
        first = forward[0][warm == 0].sum(axis=0) if longest else np.zeros(k)
        return [first, move, emit, np.array([np.log10(scales[counted]).sum()])]


def _normalised(counts: list[np.ndarray], unigram: np.ndarray) -> Hmm:
    start, move, emit, _ = counts
    emit = emit + EMISSION_PRIOR * unigram[:, None]
    move, start = move + 1.0, start + 1.0
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True),
               emit / emit.sum(axis=0, keepdims=True))


def _first_guess(unigram: np.ndarray, states: int, seed: int) -> Hmm:
    draw = np.random.default_rng(seed)
    emit = unigram[:, None] * draw.gamma(2.0, size=(len(unigram), states))
    step = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Hmm(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint16) for x in column.to_pylist()]


def _block_counts(texts: DataFrame, model: Hmm) -> list[np.ndarray] | None:
    """Baum-Welch counts of rows (symbols, n_tokens), summed over partitions."""
    shapes = [model.start.shape, model.step.shape, model.emit.shape, (1,)]
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(int(np.prod(s)) for s in shapes))
        for batch in batches:
            for part in _by_tokens(batch):
                found = shared.value.expected(_sequences(part.column("symbols")))
                total += np.concatenate([a.ravel() for a in found])
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

    flat = tree_sum(texts.select("symbols", "n_tokens").mapInArrow(partial, "sums binary"))
    shared.destroy()
    if flat is None:
        return None
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return [a.reshape(s) for a, s in zip(np.split(flat, cuts), shapes, strict=True)]


def train(texts: DataFrame, lex: Lexicon, states: int = STATES, passes: int = PASSES,
          settled: float = SETTLED, blocks: int = BLOCKS, seed: int = 5,
          seen: list[float] | None = None) -> Hmm:
    """Fit on rows (row, n_tokens, symbols); ``seen`` gets the log10 likelihood of each pass."""
    weight = np.ones(lex.size)
    weight[:lex.first_class] = lex.counts[:lex.first_class] + 1
    weight[lex.first_class:] = lex.class_totals
    unigram = weight / weight.sum()
    model = _first_guess(unigram, states, seed)
    block = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(blocks))
    counts: dict[int, list[np.ndarray]] = {}
    before = None
    for done in range(passes):
        for b in range(blocks):
            found = _block_counts(texts.where(block == b), model)
            if found is not None:
                counts[b] = found
                model = _normalised([sum(c) for c in zip(*counts.values(), strict=True)], unigram)
        likelihood = float(sum(c[3][0] for c in counts.values()))
        if seen is not None:
            seen.append(likelihood)
        if done + 1 >= LEAST_PASSES and likelihood - before < settled * abs(likelihood):
            break
        before = likelihood
    return model


def _by_tokens(batch: pa.RecordBatch, most: int = 400_000) -> Iterator[pa.RecordBatch]:
    part = np.cumsum(np.asarray(batch.column("n_tokens"))) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def text_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id",
                text_col: str = "text", states: int = STATES, passes: int = PASSES,
                blocks: int = BLOCKS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``held_out`` is a condition on ``doc_id``; the model learns from the other rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = stored(texts.where(~held_out).select("text").mapInArrow(
        _word_counts, "word binary, class int, n long")
        .groupBy("word", "class").agg(F.sum("n").alias("c")), "word-counts")
    lex = lexicon(counts)
    shared = spark.sparkContext.broadcast(lex)
    rows = stored(texts.mapInArrow(
        lambda it: _encoded(it, shared),
        "row long, doc_id long, symbols binary, n_tokens long, known long, head_log double, "
        "class_log double, rare array<binary>, rare_n array<long>"), "symbols")
    model = spark.sparkContext.broadcast(
        train(rows.where(~held_out).select("row", "n_tokens", "symbols"), lex, states, passes,
              blocks=blocks))

    # counts of the words beyond the table, summed up for each text
    rare = rows.select("row", F.arrays_zip("rare", "rare_n").alias("z")).select(
        "row", F.explode("z").alias("z")).select(
        "row", F.col("z.rare").alias("word"), F.col("z.rare_n").alias("n"))
    beyond = (rare.join(counts.where(_magnitude() < lex.least).select("word", "c"), "word")
              .groupBy("row").agg(F.sum("n").alias("rare_known"),
                                  F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log")))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch(
                [*(batch.column(c) for c in keep),
                 pa.array(model.value.log10(_sequences(batch.column("symbols"))), pa.float64())],
                [*keep, "symbols_log"])

    keep = ["row", "doc_id", "n_tokens", "known", "head_log", "class_log"]
    scored = rows.select(*keep, "symbols").mapInArrow(
        forward, "row long, doc_id long, n_tokens long, known long, head_log double, "
                 "class_log double, symbols_log double").join(beyond, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    base = (F.col("head_log") + rare_log
            - F.col("n_tokens") * float(np.log10(lex.tokens + lex.types + 1)))
    score = F.col("symbols_log") + F.col("class_log") + rare_log if lex.tokens else base
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens",
                         (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                         F.lit(lex.tokens).cast("long").alias("train_tokens"),
                         base.alias("base_score"), score.alias("score"))
