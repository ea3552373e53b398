"""End-to-end run: aspects -> stats and streams -> contracts -> sink.

RUN-1/RUN-2: the requested stats and streams share their inputs (see
``registry``); a failure while building *or writing* one output is logged and
that output skipped, so one broken stat never loses the others; its status says
``failed``.  Empty outputs are not written.  When a stat and a stream share a name
the stream wins (as in the reference), also if it failed.  Tables stored for the
run are removed at its end.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sinks import bundle, writers
from ..sources import qualified
from . import registry

log = logging.getLogger(__name__)

FORMATS = ("parquet", "jsonl-gz", "row-major", "columnar", "hybrid")


def build_outputs(tables: dict[str, DataFrame], stats: Iterable[str] | None = None,
                  streams: Iterable[str] | None = None, known: registry.Registry | None = None,
                  share: bool = True) -> registry.Outputs:
    st, sm = registry.run(tables, stats, streams, known, share)
    for name in set(st) & set(sm):
        log.warning("name clash %r: the unaggregated stream wins", name)
    st.update(sm)
    for name in sm.failed:
        st.pop(name, None)
    st.failed = {n: e for n, e in {**st.failed, **sm.failed}.items() if n not in st}
    return st


def run(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
        stats: Iterable[str] | None = None, streams: Iterable[str] | None = None,
        defs: DataFrame | None = None, game_meta: DataFrame | None = None,
        known: registry.Registry | None = None) -> dict[str, str]:
    """Write every output; returns ``{name: "written" | "empty" | "failed: ..."}``.

    ``known`` is the registry to choose from, the library's own by default.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    known = known or registry.Registry()
    outputs = build_outputs(tables, stats, streams, known)
    try:
        status = _write(outputs, out_dir, fmt, known, defs, game_meta)
        status.update((n, f"failed: {type(e).__name__}") for n, e in outputs.failed.items())
        return status
    finally:
        outputs.close()


def run_files(spark: SparkSession, roots: Sequence[str], layer: str, out_dir: str,
              fmt: str = "parquet", stats: Iterable[str] | None = None,
              streams: Iterable[str] | None = None, dims: dict[str, DataFrame] | None = None,
              known: registry.Registry | None = None, **options) -> dict[str, str]:
    """``run`` over telemetry files, by way of the qualified layer at ``layer``.

    Only replays whose files are new or changed are decoded.  ``dims`` adds
    tables that are no aspects (unit definitions); rejected rows are written to
    ``<out_dir>/quarantine``.
    """
    kept = qualified.Layer(spark, layer)
    kept.update(roots)
    tables, quarantine = kept.read(roots)
    status = run({**tables, **(dims or {})}, out_dir, fmt, stats, streams, known=known, **options)
    status["quarantine"] = "written" if writers.write_parquet(
        {"quarantine": quarantine}, out_dir) else "empty"
    return status


def _write(outputs: dict[str, DataFrame], out_dir: str, fmt: str, known: registry.Registry,
           defs: DataFrame | None, game_meta: DataFrame | None) -> dict[str, str]:
    status: dict[str, str] = {}
    if fmt in ("parquet", "jsonl-gz"):
        write = writers.write_parquet if fmt == "parquet" else writers.write_jsonl_gz
        for name, df in outputs.items():
            try:
                orders = {name: registry.sort_keys(name, df, known)}
                status[name] = "written" if write({name: df}, out_dir, orders=orders) else "empty"
            except Exception as e:  # isolation at action time
                log.exception("output %s failed; skipped", name)
                status[name] = f"failed: {type(e).__name__}"
        return status
    orders = {n: _order_of(known, n, df) for n, df in outputs.items()}
    for name, df in outputs.items():
        try:
            if fmt == "row-major":
                chunks, schema = writers.row_major_bundle({name: df}, orders)
            elif fmt == "columnar":
                chunks, schema = writers.columnar_bundle({name: df}, orders)
            else:
                bundle.write_bundle(bundle.hybrid_bundle({name: df}, orders=orders), out_dir)
                status[name] = "written"
                continue
            if chunks is None:
                status[name] = "not in this layout"
                continue
            writers.write_chunks(chunks, f"{out_dir.rstrip('/')}/chunks", mode="append")
            if schema is not None:
                schema.write.mode("append").partitionBy("replay_id").json(
                    f"{out_dir.rstrip('/')}/schema/{name}")
            status[name] = "written"
        except Exception as e:
            log.exception("output %s failed; skipped", name)
            status[name] = f"failed: {type(e).__name__}"
    if fmt == "hybrid" and (defs is not None or game_meta is not None):
        bundle.write_bundle(bundle.hybrid_bundle({}, defs=defs, game_meta=game_meta), out_dir)
        status["assets"] = "written"
    return status


def _order_of(known: registry.Registry, name: str, df: DataFrame) -> list[str]:
    stat = known.stats.get(name) or known.streams.get(name)
    keys = [c for c, _ in (stat.sort if stat else ())]
    if not keys:
        keys = [c for c in ("frame", "row_ord") if c in df.columns]
    return keys
