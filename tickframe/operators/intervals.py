"""Interval-to-bin apportioning (range join without a nested loop).

An interval ``[start, end)`` overlaps bins ``floor(start/step)*step`` up to
``floor((end-1)/step)*step`` (integer frames).  ``explode(sequence(...))``
emits exactly the overlapping bins per interval, so work is proportional to
the output, never intervals x bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FRAME_RATE


def explode_bins(df: DataFrame, start: str, end: str, step: int,
                 bin_col: str = "bin_start") -> DataFrame:
    """One row per (interval, overlapped bin) for non-empty intervals, with
    ``ov_start``, ``ov_end`` (frames) and ``ov_seconds``."""
    s, e = F.col(start), F.col(end)
    first = F.floor(s / step) * step
    last = F.floor((e - 1) / step) * step
    out = df.filter(e > s).withColumn(
        bin_col, F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(step).cast("long"))))
    b = F.col(bin_col)
    return (
        out.withColumn("ov_start", F.greatest(s, b))
        .withColumn("ov_end", F.least(e, b + step))
        .withColumn("ov_seconds", (F.col("ov_end") - F.col("ov_start")) / F.lit(float(FRAME_RATE)))
    )


def apportion_to_bins(df: DataFrame, keys: list[str], start: str, end: str, step: int,
                      rates: dict[str, str], unit_col: str = "unit_id",
                      bin_col: str = "bin_start") -> DataFrame:
    """Aggregate intervals into ``(keys, bin)``: overlap seconds, distinct units
    alive, and each ``rates`` column (per second) times overlap seconds.

    Two-level aggregation: first per (keys, unit, bin) -- rows of one unit sit
    in one task, so the map-side partial aggregate collapses them -- then per
    (keys, bin) where ``count(*)`` is the distinct unit count.  This avoids
    the row-doubling Expand of a ``count(DISTINCT)`` next to other aggregates.
    """
    ex = explode_bins(df, start, end, step, bin_col)
    per_unit = ex.groupBy(*keys, unit_col, bin_col).agg(
        F.sum("ov_seconds").alias("__s"),
        *[F.sum(F.col(rate) * F.col("ov_seconds")).alias(out) for out, rate in rates.items()],
    )
    return per_unit.groupBy(*keys, bin_col).agg(
        F.sum("__s").alias("total_unit_seconds_in_bin"),
        F.count(F.lit(1)).alias("units_alive_in_bin"),
        *[F.sum(out).alias(out) for out in rates],
    )


def apportion_to_bins_ranges(df: DataFrame, keys: list[str], start: str, end: str, step: int,
                             rates: dict[str, str], unit_col: str = "unit_id",
                             bin_col: str = "bin_start", extra: DataFrame | None = None,
                             extra_col: str = "extra", keep_extra_only: bool = True
                             ) -> DataFrame:
    """Same result as ``apportion_to_bins`` with work proportional to
    intervals + output instead of the summed interval lengths.

    * Each interval's first and last bin (partial overlap) become at most two
      rows, deduplicated per (keys, unit, bin) for the distinct-unit count.
    * Fully covered interior bins become two difference events (+1 / -1 unit,
      +/- step seconds and rate * step) at the first interior bin and just past
      the last; a running sum over each group's dense bin grid -- at most
      (game length / step) rows per group -- gives every interior bin.
    * A unit covering a whole bin has no other interval in it, so interior
      units and partial units are disjoint and their counts add up.

    ``extra`` (keys, ``bin_col``, ``extra_col``) is a per-bin count merged in
    the same pass (no join); bins that only have ``extra`` are kept when
    ``keep_extra_only`` (full-outer semantics) and dropped otherwise (left).
    """
    secs = float(step) / FRAME_RATE
    s, e = F.col(start), F.col(end)
    b0 = (F.floor(s / step) * step).cast("long")
    b1 = (F.floor((e - 1) / step) * step).cast("long")
    rate_cols = list(rates.values())

    def ev(kind, b, unit, cnt, ov, mult):
        return F.struct(F.lit(kind).alias("kind"), b.alias("bin"), unit.alias("u"),
                        F.lit(cnt).cast("long").alias("cnt"), ov.alias("ov"),
                        *[(F.col(r) * mult).alias(f"m{i}") for i, r in enumerate(rate_cols)])

    fps = F.lit(float(FRAME_RATE))
    first_ov = (F.least(e, b0 + step) - s) / fps
    last_ov = (e - b1) / fps
    interior = b1 - b0 >= 2 * step
    unit = F.col(unit_col)
    nul = F.lit(None).cast("long")
    events = F.array(
        ev("p", b0, unit, 1, first_ov, first_ov),
        F.when(b1 > b0, ev("p", b1, unit, 1, last_ov, last_ov)),
        F.when(interior, ev("d", b0 + step, nul, 1, F.lit(secs), F.lit(secs))),
        F.when(interior, ev("d", b1, nul, -1, F.lit(-secs), F.lit(-secs))),
    )
    x = df.filter(e > s).select(*keys, F.explode(F.filter(events, lambda v: v.isNotNull())).alias("v"))
    x = x.select(*keys, "v.*")
    m = [f"m{i}" for i in range(len(rate_cols))]
    # (1) partial rows deduplicate per unit; deltas sum per bin
    l1 = x.groupBy(*keys, "kind", "bin", "u").agg(
        F.sum("cnt").alias("cnt"), F.sum("ov").alias("ov"), *[F.sum(c).alias(c) for c in m])
    if extra is not None:
        l1 = l1.unionByName(extra.select(
            *keys, F.lit("c").alias("kind"), F.col(bin_col).cast("long").alias("bin"),
            F.lit(None).cast("long").alias("u"), F.col(extra_col).cast("long").alias("cnt"),
            F.lit(0.0).alias("ov"), *[F.lit(0.0).alias(c) for c in m]))
    is_p, is_d = F.col("kind") == "p", F.col("kind") == "d"
    # (2) one row per (group, bin): distinct partial units, their sums, net deltas
    l2 = l1.groupBy(*keys, "bin").agg(
        F.count_if(is_p).alias("pu"),
        F.coalesce(F.sum(F.when(is_p, F.col("ov"))), F.lit(0.0)).alias("pov"),
        *[F.coalesce(F.sum(F.when(is_p, F.col(c))), F.lit(0.0)).alias(f"p{c}") for c in m],
        F.coalesce(F.sum(F.when(is_d, F.col("cnt"))), F.lit(0)).alias("dcnt"),
        *[F.coalesce(F.sum(F.when(is_d, F.col(c))), F.lit(0.0)).alias(f"d{c}") for c in m],
        F.coalesce(F.sum(F.when(F.col("kind") == "c", F.col("cnt"))), F.lit(0)).alias("xc"))
    # (3) running interior state over the group's bins (<= game length / step
    #     rows per group) and the next bin that has any event
    w = Window.partitionBy(*keys).orderBy("bin")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    l3 = l2.select(*keys, "bin", "pu", "pov", "xc", *[f"p{c}" for c in m],
                   F.sum("dcnt").over(run).alias("ic"),
                   *[F.sum(f"d{c}").over(run).alias(f"i{c}") for c in m],
                   F.lead("bin").over(w).alias("nb"))
    covered = F.col("ic") > 0
    # (4) this bin, plus the fully covered bins up to the next event bin
    gap_end = F.coalesce(F.col("nb"), F.col("bin") + step) - step
    between = F.when(covered & (gap_end > F.col("bin")),
                     F.sequence(F.col("bin") + step, gap_end, F.lit(step).cast("long"))
                     ).otherwise(F.array().cast("array<bigint>"))
    l3 = l3.select("*", F.explode(F.concat(F.array(F.col("bin")), between)).alias("ob"))
    own = F.col("ob") == F.col("bin")
    ic = F.when(covered, F.col("ic")).otherwise(F.lit(0))

    def interior(c):
        return F.when(covered, F.col(c)).otherwise(F.lit(0.0))

    keep = ~own | (F.col("pu") > 0) | covered
    if extra is not None and keep_extra_only:
        keep = keep | (F.col("xc") > 0)
    out = l3.filter(keep).select(
        *keys, F.col("ob").alias(bin_col),
        (F.when(own, F.col("pov")).otherwise(F.lit(0.0)) + ic * F.lit(secs))
        .alias("total_unit_seconds_in_bin"),
        (F.when(own, F.col("pu")).otherwise(F.lit(0)) + ic).cast("long").alias("units_alive_in_bin"),
        *[(F.when(own, F.col(f"p{c}")).otherwise(F.lit(0.0)) + interior(f"i{c}")).alias(o)
          for c, o in zip(m, rates)],
        *([F.when(own, F.col("xc")).otherwise(F.lit(0)).cast("long").alias(extra_col)]
          if extra is not None else []))
    return out
