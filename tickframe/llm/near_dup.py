"""N-gram Jaccard join by the chosen path method.

Texts become sets of hashed word n-grams.  Each set walks down random trees:
at a node it goes on with those of its elements whose hash, drawn anew for
every node, is below 1 / (spread * size), so about 1 / spread of them.  Sets
that share much of their elements meet in the same node; sets that share
little part ways within a few levels.  Nodes with few sets are compared by
brute force; sets in crowded nodes are split on further elements, level by
level.  The number of trees follows from the recall that is asked for.

1. One pass gives each text an identity of its set and its nodes at the first
   depth.  Texts with equal sets are one set from here on.
2. Sets of nodes with more than ``SMALL`` sets go ``STEP`` levels deeper.  In
   every other node each set is paired with the node's pivot, and then, where a
   node holds sets not joined so far, with all of those.  What is crowded at
   the last depth holds sets that are all alike; there each set is paired with
   a few pivots.
3. Bottom-k sketches discard pairs that are clearly apart; the rest, with a
   wide margin, makes candidate classes by connected components.
4. Each candidate class compares all its sets exactly, in blocks of bounded
   size: similarities are exact, nothing is estimated in the result, and links
   are counted where they are found, never written out as pairs.

Result: one row a document with its class (smallest id of its component) and
its number of links, copies included.

Cases: null and empty texts, and texts without a word, have no shingle, no
links, and are classes of their own; texts with fewer words than a shingle
have one shingle, all their words; rows may repeat (they are linked copies);
null ids are kept as rows, and a class of null ids alone has a null class; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import kept, release, split_by_keys, stored
from tickframe.llm.components import connected_components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
SPREAD = 0.5
FIRST_DEPTH = 2
STEP = 2
LAST_DEPTH = 6
SMALL = 16
PIVOTS = 3
SKETCH = 96
SKETCH_MARGIN = 0.2
BLOCK = 512
BLOCK_GRAMS = 1_500_000
PART_BYTES = 4 << 20

_WORD = re.compile(r"\w+")
# the same words where all characters are ASCII
_ASCII_WORDS = bytes(c if chr(c).isalnum() or c == ord("_") else 32 for c in range(128)) + bytes(
    128)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text's lower-cased words."""
    if text.isascii():
        words = text.lower().encode().translate(_ASCII_WORDS).split()
    else:
        words = "\n".join(_WORD.findall(text.lower())).encode().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total += codes[k:len(codes) - size + 1 + k]
        total *= _ODD[1]
    return np.unique(_mix(total + np.uint64(size)))


def runs_for(recall: float, similarity: float = SIMILARITY, spread: float = SPREAD,
             depth: int = LAST_DEPTH) -> int:
    """Trees needed to join a pair of the given similarity with the given probability.

    A pair's common nodes are a branching process with at least similarity /
    spread children a node on average; its chance to die out by ``depth`` bounds
    the chance that one tree misses the pair.
    """
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(-(similarity / spread) * (1 - lost))
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def paths(grams: np.ndarray, runs: int, depth: int, spread: float = SPREAD) -> np.ndarray:
    """Hashes of the nodes at ``depth`` that a set reaches, in all trees."""
    if not len(grams):
        return np.zeros(0, dtype=np.int64)
    limit = np.uint64(min(2 ** 64 - 1, int(2 ** 64 / (spread * len(grams)))))
    nodes = _mix((np.arange(1, runs + 1, dtype=np.uint64)) * _ODD[2])
    step = max(1, (1 << 21) // len(grams))
    for level in range(depth):
        found = []
        for i in range(0, len(nodes), step):
            drawn = _mix(nodes[i:i + step, None] ^ (grams * _ODD[3 + level % 4]))
            at, element = np.nonzero(drawn <= limit)
            found.append(_mix(nodes[i + at] * _ODD[0] + grams[element]))
        nodes = np.unique(np.concatenate(found)) if found else nodes
        if not len(nodes):
            break
    return nodes.view(np.int64)


def _identity(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64), kind))


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a few MB of a column each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                       if not pa.types.is_list(batch.schema.field(column).type)
                       else pc.multiply(pc.list_value_length(batch.column(column)), 8))
    part = np.cumsum(sizes, dtype=np.int64) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list<int64> column as unsigned arrays, without Python integers."""
    whole = pa.concat_arrays([column])
    flat = np.asarray(whole.values).view(np.uint64)
    ends = np.asarray(whole.offsets).tolist()
    return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _described(batches: Iterator[pa.RecordBatch], n: int, runs: int,
               depth: int) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    for batch in (p for b in batches for p in _parts(b, "text")):
        sets = [shingles(t or "", n) for t in batch.column(1).to_pylist()]
        yield pa.record_batch(
            [pa.array(np.arange(row, row + len(sets), dtype=np.int64)), batch.column(0),
             batch.column(2),
             pa.array([_identity(s) if len(s) else None for s in sets], pa.binary()),
             _lists([paths(s, runs, depth) for s in sets], pa.int64())],
            ["row", "doc_id", "text_hash", "identity", "paths"])
        row += len(sets)


def _gram_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in (p for b in batches for p in _parts(b, "text")):
        sets = [shingles(t or "", n) for t in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array([_identity(s) for s in sets], pa.binary()),
                               _lists(sets, pa.int64())], ["identity", "grams"])


def _deeper(batches: Iterator[pa.RecordBatch], runs: int, depth: int) -> Iterator[pa.RecordBatch]:
    for batch in (p for b in batches for p in _parts(b, "grams")):
        sets = _arrays(batch.column("grams"))
        yield pa.record_batch([batch.column("s"),
                               _lists([paths(s, runs, depth) for s in sets], pa.int64())],
                              ["s", "paths"])


def _crowds(nodes: DataFrame) -> DataFrame:
    """Rows (path, s, n) of nodes that two sets or more have reached."""
    counts = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(nodes.join(counts, "path"), "nodes")


def _all_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs of different groups in small nodes; a node's list holds ``SMALL`` sets at most."""
    lists = (nodes.where(F.col("n") <= SMALL).groupBy("path")
             .agg(F.sort_array(F.collect_list(F.struct("s", "group"))).alias("sets"),
                  F.min("group").alias("low"), F.max("group").alias("high"))
             .where("low <> high"))
    first = lists.select("sets", F.posexplode("sets").alias("i", "a"))
    pairs = first.select("a", F.explode(F.filter(
        F.slice("sets", F.col("i") + 2, F.lit(SMALL)),
        lambda b: b["group"] != F.col("a.group"))).alias("b"))
    return pairs.select(F.col("a.s").alias("a"), F.col("b.s").alias("b"))


def _pivot_pairs(nodes: DataFrame, pivots: int) -> DataFrame:
    """Pairs of each set of a node with a few pivots of the node.

    The pivots are drawn by the sets alone, so that sets which meet in many nodes
    meet the same few pivots there, and the pairs collapse.
    """
    out = None
    for k in range(pivots):
        order = F.struct(F.xxhash64("s", F.lit(k)), "s")
        pivot = nodes.groupBy("path").agg(F.min(order).getField("s").alias("b"))
        part = nodes.join(pivot, "path").select(F.col("s").alias("a"), "b").where(
            "a <> b").distinct()
        out = part if out is None else out.unionByName(part)
    return out


def _edges(pairs: DataFrame, sketch: DataFrame, least: float) -> DataFrame:
    """Distinct pairs whose sketches are not clearly apart."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(lambda it: _likely(it, least),
                                                      "a long, b long")


def _sketch_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity estimated from bottom-k sketches; exact for small sets."""
    union = np.union1d(x, y)
    if len(x) == SKETCH or len(y) == SKETCH:
        union = union[:SKETCH]
    return len(np.intersect1d(np.intersect1d(x, y, True), union, True)) / len(union)


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in (p for b in batches for p in _parts(b, "x")):
        keep = [_sketch_similarity(x, y) >= least for x, y in
                zip(_arrays(batch.column("x")), _arrays(batch.column("y")), strict=True)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _exact_links(table: pa.Table, similarity: float) -> pa.Table:
    """Exact links of one block pair: rows (s, root, links).

    ``side`` 0 and 1 are the two blocks (all rows 0 for a block with itself);
    root is the smallest set that s is linked to through this block pair.
    """
    s = np.asarray(table.column("s"))
    order = np.argsort(s, kind="stable")
    s, copies = s[order], np.asarray(table.column("copies"))[order]
    side = np.asarray(table.column("side"))[order]
    lists = table.column("grams").combine_chunks().take(pa.array(order))
    sizes = np.diff(np.asarray(lists.offsets))
    owner = np.repeat(np.arange(len(s), dtype=np.int32), sizes)
    flat = np.asarray(lists.flatten())
    by_gram = np.argsort(flat, kind="stable")
    owner, new = owner[by_gram], np.diff(flat[by_gram], prepend=flat[by_gram][:1] - 1) != 0
    del flat, by_gram, lists
    column = np.cumsum(new, dtype=np.int32) - 1
    # grams of one set alone are common to no pair
    shared = np.bincount(column, minlength=1)[column] > 1
    owner = owner[shared]
    column = np.cumsum(np.diff(column[shared], prepend=-1) != 0, dtype=np.int32) - 1
    common = np.zeros((len(s), len(s)), dtype=np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(s), width), dtype=np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    # exact for sets of up to 2**24 elements; compared without dividing
    linked = common >= similarity * union - 1e-6
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    links = linked @ copies.astype(np.int64)
    root = np.arange(len(s))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(s)).min(axis=1, initial=len(s)))
        low = np.minimum(low, low[low])
        if (low == root).all():
            break
        root = low
    return pa.table({"s": s, "root": s[root], "links": links.astype(np.int64)})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, similarity: float = SIMILARITY,
                    recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, copies for every row of ``docs``.

    ``n_links`` counts the other rows with a similarity of at least
    ``similarity``; ``copies`` those rows, itself included, with an equal set.
    """
    return _classes(docs, id_col, text_col, words, similarity, recall).drop(
        "text_hash", "keep_hash")


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS,
             similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``near_duplicates`` with the hash of each row's text and of its class's first row.

    The first row has the smallest id, of several the smallest hash; null ids come last.
    """
    runs = runs_for(recall, similarity)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_hash"))
    described = stored(texts.mapInArrow(
        lambda it: _described(it, words, runs, FIRST_DEPTH),
        "row long, doc_id long, text_hash long, identity binary, paths array<long>"), "described")
    rows = stored(described.drop("paths"), "rows")
    sets = stored(rows.where("identity IS NOT NULL").groupBy("identity")
                  .agg(F.min(F.struct("row", "doc_id", "text_hash")).alias("first"),
                       F.count(F.lit(1)).alias("copies"))
                  .select("identity", F.col("first.row").alias("s"),
                          F.col("first.doc_id").alias("doc_id"),
                          F.col("first.text_hash").alias("text_hash"), "copies"), "sets")
    full = kept(lambda: _linked(texts, described, sets, words, similarity, runs), "classes")
    release(described)
    found = rows.join(full.select("identity", "copies", "others", "root"), "identity", "left")
    least = stored(rows.join(full.select("identity", "root"), "identity").groupBy("root")
                   .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
                        .alias("least"))
                   .select("root", F.col("least.doc_id").alias("least_id"),
                           F.col("least.text_hash").alias("least_hash")), "class-ids")
    return (found.join(least, "root", "left").select(
        "doc_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
        .alias("class_id"),
        F.coalesce(F.col("others") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("copies"), "text_hash",
        F.when(F.col("root").isNull(), F.col("text_hash")).otherwise(F.col("least_hash"))
        .alias("keep_hash")))


def _linked(texts: DataFrame, described: DataFrame, sets: DataFrame, words: int,
            similarity: float, runs: int) -> DataFrame:
    """(identity, copies, others, root, doc_id) of all sets, their links counted exactly."""
    nodes = _crowds(described.join(sets.select(F.col("s").alias("row")), "row", "left_semi")
                    .select(F.col("row").alias("s"), F.explode("paths").alias("path")))

    # sets with company, with their n-grams: the second and last look at the texts
    company = sets.join(nodes.select("s").distinct(), "s", "left_semi")
    near, _ = split_by_keys(texts, F.xxhash64("doc_id", "text_hash"), company.select(
        F.xxhash64("doc_id", "text_hash").alias("key")).distinct(), "company")
    grams = near.select("text").mapInArrow(
        lambda it: _gram_sets(it, words), "identity binary, grams array<long>")
    grams = stored(grams.dropDuplicates(["identity"])
                   .join(company.select("identity", "s", "copies"), "identity")
                   .drop("identity"), "grams")

    layers, depth = [nodes], FIRST_DEPTH
    crowded = nodes.where(F.col("n") > SMALL)
    while depth < LAST_DEPTH and not crowded.isEmpty():
        depth += STEP
        here = depth
        again = grams.join(crowded.select("s").distinct(), "s", "left_semi").select("s", "grams")
        deeper = again.mapInArrow(lambda it, d=here: _deeper(it, runs, d),
                                  "s long, paths array<long>")
        layers.append(_crowds(deeper.select("s", F.explode("paths").alias("path"))))
        crowded = layers[-1].where(F.col("n") > SMALL)
    # first each set with its node's pivot: what that joins needs no further pairs
    # the n-grams are sorted by hash, so the first ones are the sketch
    sketch = grams.select("s", F.slice("grams", 1, SKETCH).alias("sketch"))
    least = similarity - SKETCH_MARGIN
    pairs = _pivot_pairs(crowded, PIVOTS)
    for layer in layers:
        pairs = pairs.unionByName(_pivot_pairs(layer.where(F.col("n") <= SMALL), 1))
    stars = stored(connected_components(_edges(pairs, sketch, least)), "stars")
    groups = stars.select(F.col("node").alias("s"), F.col("root").alias("group"))
    pairs = None
    for layer in layers:
        part = layer.where(F.col("n") <= SMALL).join(groups, "s", "left").withColumn(
            "group", F.coalesce("group", "s"))
        pairs = _all_pairs(part) if pairs is None else pairs.unionByName(_all_pairs(part))
    bridges = _edges(pairs, sketch, least).unionByName(
        stars.select(F.col("node").alias("a"), F.col("root").alias("b")))
    candidates = stored(connected_components(bridges), "candidates")

    # every candidate class compares its sets exactly, one pair of blocks a group
    sizes = (candidates.join(grams.select(F.col("s").alias("node"), F.size("grams").alias("g")),
                             "node").groupBy("root")
             .agg(F.count(F.lit(1)).alias("m"), F.sum("g").alias("g")).select(
                 "root", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("g") / BLOCK_GRAMS))
                 .cast("int").alias("blocks")))
    placed = candidates.join(sizes, "root").select(
        F.col("node").alias("s"), "root", "blocks",
        F.when(F.col("blocks") == 1, 0).otherwise(
            F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int").alias("block"))
    places = placed.select("s", "root", "block", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "s", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"))
    links = stored(
        places.join(grams.select("s", "copies", "grams"), "s").groupBy("root", "i", "j")
        .applyInArrow(lambda t: _exact_links(t, similarity), "s long, root long, links long"),
        "links")
    classes = connected_components(links.select(F.col("s").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("s").agg(F.sum("links").alias("others"))
    return (sets.join(counted, "s", "left")
            .join(classes.withColumnRenamed("node", "s"), "s", "left")
            .select("identity", "copies", F.coalesce("others", F.lit(0)).alias("others"),
                    F.coalesce("root", "s").alias("root"), "doc_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, one a class.

    Rows are told apart by id and text: others with the id of a row that goes stay.
    """
    def lists() -> DataFrame:
        """Rows that go, and rows that repeat id and text of a class's first row."""
        first = "doc_id <=> class_id AND text_hash = keep_hash"
        found = _classes(docs, id_col, text_col, **options).where(
            f"NOT ({first}) OR n_links > 0").groupBy(
            F.col("doc_id").alias("__near_id"), F.col("text_hash").alias("__near_hash"),
            (~F.expr(first)).alias("__goes")).agg(F.count(F.lit(1)).alias("__rows"))
        return found.where("__goes OR __rows > 1")

    found = kept(lists, "near-lists")
    pair = F.xxhash64("__near_id", "__near_hash").alias("key")
    gone = found.where("__goes").select("__near_id", "__near_hash")
    repeated = found.where("NOT __goes").select("__near_id", "__near_hash")
    same = (F.col(id_col).eqNullSafe(F.col("__near_id"))
            & (F.xxhash64(F.col(text_col)) == F.col("__near_hash")))
    # only rows that pass the bit table of those lists are joined with them
    some, rest = split_by_keys(
        docs, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))),
        gone.select(pair).unionByName(repeated.select(pair)).distinct(), "near-texts")
    some = some.join(gone, same, "left_anti")
    if not repeated.isEmpty():
        # rows that repeat id and text of a class's first row: one of them stays
        once = some.join(repeated, same, "left_anti")
        some = once.unionByName(some.join(repeated, same, "left_semi")
                                .dropDuplicates([id_col, text_col]))
    return rest.unionByName(some)
