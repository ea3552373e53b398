"""Qualified layer (ING-9 / SRC-8): clean aspects persisted as Parquet under
a pipeline version, read back only when the version matches.

The version hashes the schema declarations and enum tables, so any change to
how raw records are interpreted starts a fresh layer.

``Layer`` keeps itself up to date with the input files.  Its manifest says for
every (replay, aspect) which files it was decoded from and in which batch:

* ``update`` decodes only what is new: (replay, aspect) pairs whose files are
  not those of the manifest, by path, length and modification time;
* a batch's rows are written first, then its manifest rows to a folder of
  their own that is renamed into place.  Rows of a batch without manifest rows
  (the run died) are never read;
* ``read`` returns the rows of the pairs that the inputs hold now, each from
  its latest batch.

Layout: ``<root>/version=<hash>/aspect=<name>/batch=<id>/reject=<kind>/`` and
``<root>/version=<hash>/manifest/batch=<id>/``.  Files follow the tasks that
wrote them, not the replays.

``write_qualified`` and ``read_qualified`` keep whole tables by replay.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import __version__
from ..enums import ENUMS
from ..schemas import ASPECTS, clean_schema
from ..scratch import stored
from . import scan
from .dims import _exists

log = logging.getLogger(__name__)


def pipeline_version() -> str:
    spec = {
        "v": __version__,
        "aspects": {a: [(f.name, f.kind, f.nullable, f.divisor, f.enum) for f in fs]
                    for a, fs in ASPECTS.items()},
        "enums": {k: sorted(v.items()) for k, v in ENUMS.items()},
    }
    return hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()[:16]


def _path(root: str, version: str, aspect: str) -> str:
    return f"{root.rstrip('/')}/version={version}/aspect={aspect}"


def write_qualified(tables: dict[str, DataFrame], root: str, version: str | None = None,
                    mode: str = "overwrite") -> str:
    version = version or pipeline_version()
    for aspect, df in tables.items():
        df.write.mode(mode).partitionBy("replay_id").parquet(_path(root, version, aspect))
    return version


def read_qualified(spark: SparkSession, root: str, aspects=None, version: str | None = None
                   ) -> dict[str, DataFrame] | None:
    """The stored aspects for this pipeline version, or ``None`` on a miss."""
    version = version or pipeline_version()
    names = list(aspects) if aspects is not None else list(ASPECTS)
    out = {}
    for a in names:
        p = _path(root, version, a)
        if not _exists(spark, p):
            log.info("qualified layer miss: %s", p)
            return None
        out[a] = spark.read.schema(clean_schema(a)).parquet(p)
    return out


# --------------------------------------------------------------------------- incremental
MANIFEST = "replay_id string, aspect string, signature string, files int, batch string, seq long"


class Layer:
    """The qualified layer under ``root``, kept up to date with input folders."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self.spark = spark
        self.version = version or pipeline_version()
        self.root = f"{root.rstrip('/')}/version={self.version}"

    def manifest(self) -> DataFrame:
        """Committed (replay, aspect) pairs with their batch, all batches."""
        if not _exists(self.spark, f"{self.root}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/batch=*")

    def latest(self) -> DataFrame:
        """The newest entry of each (replay, aspect)."""
        newest = Window.partitionBy("replay_id", "aspect").orderBy(F.desc("seq"), F.desc("batch"))
        return (self.manifest().withColumn("__n", F.row_number().over(newest))
                .where("__n = 1").drop("__n"))

    def _current(self, roots: Sequence[str], aspects: Iterable[str]) -> DataFrame:
        """The input files as they are now, with the signature of their (replay, aspect)."""
        files = scan.discover(self.spark, roots, aspects=list(aspects), with_content=False)
        files = stored(files, "input-files")
        pair = files.groupBy("replay_id", "aspect").agg(
            F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(
                "|", "path", F.col("length").cast("string"),
                F.unix_micros("modified").cast("string")))), "\n"), 256).alias("signature"),
            F.count(F.lit(1)).cast("int").alias("files"))
        return files.join(pair.hint("merge"), ["replay_id", "aspect"])

    def update(self, roots: Sequence[str], aspects: Iterable[str] | None = None,
               on_bad_enum: str = "reject", split: int | None = None) -> str | None:
        """Decode the pairs whose files changed; the new batch's id, ``None`` if there are none."""
        names = list(ASPECTS) if aspects is None else list(aspects)
        entries = self.latest().select("replay_id", "aspect", "signature")
        new = stored(self._current(roots, names).join(
            entries.hint("merge"), ["replay_id", "aspect", "signature"], "left_anti"), "new-files")
        found = [r[0] for r in new.select("aspect").distinct().collect()]
        if not found:
            return None
        batch = uuid.uuid4().hex
        for aspect in sorted(found):
            raw = scan.decode_split(new.where(F.col("aspect") == aspect), split)
            scan.split_once(raw, aspect, self._path(aspect, batch), on_bad_enum)
        seq = (self.manifest().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]) + 1
        pending = f"{self.root}/pending/{batch}"
        new.select("replay_id", "aspect", "signature", "files").distinct().withColumn(
            "batch", F.lit(batch)).withColumn("seq", F.lit(seq).cast("long")).coalesce(
            1).write.parquet(pending)
        _rename(self.spark, pending, f"{self.root}/manifest/batch={batch}")
        return batch

    def _path(self, aspect: str, batch: str) -> str:
        return f"{self.root}/aspect={aspect}/batch={batch}"

    def read(self, roots: Sequence[str], aspects: Iterable[str] | None = None
             ) -> tuple[dict[str, DataFrame], DataFrame]:
        """({aspect: clean}, quarantine) of the pairs that the inputs hold now."""
        names = list(ASPECTS) if aspects is None else list(aspects)
        current = self._current(roots, names).select("replay_id", "aspect", "signature").distinct()
        live = stored(self.latest().join(current.hint("merge"), [
            "replay_id", "aspect", "signature"], "left_semi"), "live-pairs")
        # one row a batch and aspect: how many of its pairs are live, of how many
        used = {(r["aspect"], r["batch"]): r["live"] == r["pairs"] for r in self.manifest().join(
            live.select("replay_id", "aspect", "batch", F.lit(1).alias("one"))
            .hint("merge"), ["replay_id", "aspect", "batch"], "left").groupBy("aspect", "batch").agg(
            F.count("one").alias("live"), F.count(F.lit(1)).alias("pairs"))
            .where("live > 0").collect()}
        tables, quarantine = {}, None
        for aspect in names:
            clean, bad = scan.read_split(self.spark, [], aspect)
            for (of, batch), whole in sorted(used.items()):
                if of != aspect:
                    continue
                parts = scan.read_split(self.spark, [self._path(aspect, batch)], aspect)
                if not whole:       # some pairs were decoded again since, or their files went
                    keep = live.where((F.col("aspect") == aspect) & (F.col("batch") == batch))
                    parts = [p.join(keep.select("replay_id").hint("merge"), "replay_id", "left_semi")
                             .select(*p.columns) for p in parts]
                clean, bad = clean.unionByName(parts[0]), bad.unionByName(parts[1])
            tables[aspect] = clean
            quarantine = bad if quarantine is None else quarantine.unionByName(bad)
        return tables, quarantine


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")
