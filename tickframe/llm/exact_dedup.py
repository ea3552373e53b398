"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes.  The distinct blocks are
sorted into integer names; then adjacent names are paired and every distinct
pair is named in turn, so the number of names of a document halves at each
level until one is left.  (levels, name) is then the document's identity: two
documents share it if and only if their normalised texts are equal.

Names are integers given in sorted order, never truncated hashes.  Block rows
travel under their SHA-256 instead of their bytes, after the naming step has
grouped the blocks themselves and proved that no two distinct blocks of the
corpus share a digest (it fails the job otherwise).

Everything is DataFrame code.  A block or pair held by a third of all rows is
aggregated on the map side before it is named, and the joins that bring names
back are plain equi-joins whose large side AQE may split.  Each level's names
are written to the shared scratch folder, so they are fixed for every retry.

Cases: a null text counts as empty; an empty text is one empty block; null ids
are kept as rows and sort below all others; of rows that repeat both id and
text exactly one stays; an empty table gives an empty result; other columns
pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import ascii_lower, kept, split_by_keys, stored

BLOCK_BYTES = 4096


def _named(keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One integer per row of ``keys`` (distinct rows), in sorted order."""
    ordered = keys.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stored(ordered.select(*columns, F.monotonically_increasing_id().alias("name")), name)


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, text_sha256, levels, name."""
    norm = docs.select(F.col(id_col).alias("doc_id"),
                       ascii_lower(F.col(text_col)).cast("binary").alias("bytes"))
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.octet_length("bytes"), F.lit(1)) - 1)
                                     / block_bytes).cast("int")),
        lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)))

    distinct = norm.select(F.explode(cut).alias("block")).groupBy("block").agg(
        F.count(F.lit(1)).alias("n"))
    digests = (distinct.select(F.unhex(F.sha2("block", 256)).alias("digest"))
               .groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
               .select(F.when(F.col("n") == 1, F.col("digest")).otherwise(
                   F.raise_error(F.lit("two distinct blocks share a SHA-256"))).alias("digest")))
    names = _named(digests, ["digest"], "block-names")

    # one scan gives each row its digests and the digest of its whole text
    rows = stored(norm.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id",
        F.sha2("bytes", 256).alias("text_sha256"),
        F.transform(cut, lambda b: F.unhex(F.sha2(b, 256))).alias("digests")), "blocks")
    level = (rows.select("rid", F.posexplode("digests").alias("pos", "digest"))
             .join(names, "digest").select("rid", "pos", "name"))
    depth, size = 0, F.size("digests")
    longest = rows.agg(F.max(size)).first()[0] or 1
    done = []
    while True:
        level = stored(level, f"level-{depth}")
        last = longest <= 1
        single = level if last else level.join(
            rows.select("rid", F.ceil(F.log2(size)).cast("int").alias("levels"))
            .where(F.col("levels") == depth), "rid", "left_semi")
        done.append(single.select("rid", F.lit(depth).alias("levels"), "name"))
        if last:
            break
        depth, longest = depth + 1, (longest + 1) // 2
        halves = (level.join(rows.where(F.ceil(F.log2(size)) >= depth).select("rid"), "rid",
                             "left_semi")
                  .groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                  .agg(*[F.coalesce(F.max(F.when(F.col("pos") % 2 == k, F.col("name"))),
                                    F.lit(-1)).alias(side)
                         for k, side in enumerate(("left_name", "right_name"))]))
        halves = stored(halves, f"pairs-{depth}")
        pair_names = _named(halves.select("left_name", "right_name").distinct(),
                            ["left_name", "right_name"], f"pair-names-{depth}")
        level = halves.join(pair_names, ["left_name", "right_name"]).select("rid", "pos", "name")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return rows.select("rid", "doc_id", "text_sha256").join(found, "rid")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    ids = kept(lambda: identities(docs, id_col, text_col, block_bytes), "identities")
    keep = stored(ids.groupBy("levels", "name")
            .agg(F.max(F.struct("doc_id", "rid")).alias("keep"),
                 F.count(F.lit(1)).alias("group_size")), "groups")
    return ids.join(keep, ["levels", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Only rows whose text is in a group of several are joined with the list of
    dropped rows; the others pass a broadcast bit table and are not moved.
    """
    dropped = kept(lambda: exact_groups(docs, id_col, text_col, block_bytes)
                   .where("NOT kept").groupBy("doc_id", "text_sha256", "keep_id")
                   .agg(F.count(F.lit(1)).alias("n")), "dropped")
    sha = F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256)
    rows = docs.withColumn("__dedup_sha", sha)
    some, rest = split_by_keys(rows, F.xxhash64(F.col(id_col), F.col("__dedup_sha")), dropped.select(
        F.xxhash64("doc_id", "text_sha256").alias("key")).distinct(), "copies")
    gone = dropped.where("NOT doc_id <=> keep_id").select(
        F.col("doc_id").alias("__gone_id"), F.col("text_sha256").alias("__gone_sha"))
    some = some.join(gone, F.col(id_col).eqNullSafe(F.col("__gone_id"))
                     & (F.col("__dedup_sha") == F.col("__gone_sha")), "left_anti")
    if not dropped.where("doc_id <=> keep_id").isEmpty():
        # rows that repeat id and text alike: any one of them is the same row
        some = some.dropDuplicates([id_col, "__dedup_sha"])
    return rest.unionByName(some).drop("__dedup_sha")
