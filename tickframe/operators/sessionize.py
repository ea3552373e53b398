"""Gap sessionization (flag a row when it is "far" from the previous row in
order, then number sessions by a running count of flags) in one bucketed pass.

Phase 1 (per ``(keys, bucket)``): ``lag`` inside the bucket decides every flag
except the bucket's first row, and a local running count of those flags.
Phase 2 (per key, one row per bucket): the first row's flag is decided against
the previous non-empty bucket's last row; offsets are the running total of
the bucket flag counts.  ``session = offset + first_flag + local``.

Sessions are numbered from 1 within each key, like a cumulative sum of
"new session" flags whose first row is always a new session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_BUCKET_FRAMES
from .ordered import BUCKET, join_on_keys, with_bucket, with_plain_keys

SplitRule = Callable[[Mapping[str, Column], Mapping[str, Column]], Column]


def time_gap_rule(frame: str, limit: float) -> SplitRule:
    """New session when ``frame - prev.frame > limit`` (equal gap stays)."""
    return lambda prev, cur: (cur[frame] - prev[frame]) > F.lit(limit)


def _extreme(cols: Sequence[str], order: Sequence[str], last: bool) -> Column:
    """First/last row's ``cols`` as a struct.  When the only carried column is
    the leading order column, a plain min/max keeps the aggregate hash-based
    (``min_by`` over structs forces a sort-based aggregate)."""
    if list(cols) == [order[0]]:
        agg = F.max if last else F.min
        return F.struct(agg(order[0]).alias(order[0]))
    by = F.max_by if last else F.min_by
    return by(F.struct(*cols), F.struct(*order))


def gap_sessionize(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   carry: Sequence[str], split: SplitRule, out: str = "session_id",
                   width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Number gap sessions.

    ``carry`` lists the columns ``split`` looks at; ``split(prev, cur)`` gets
    two mappings column -> Column and returns true when ``cur`` starts a new
    session.  A null rule result counts as "no split".  The first row of each
    key always starts session 1.
    """
    d, plain = with_plain_keys(with_bucket(df, order[0], width, keys), keys)
    at = [*plain, BUCKET]
    w = Window.partitionBy(*at).orderBy(*[F.col(o) for o in order])
    d = d.withColumn("__prev", F.lag(F.struct(*[F.col(c) for c in carry])).over(w))
    prev = {c: F.col("__prev").getField(c) for c in carry}
    cur = {c: F.col(c) for c in carry}
    flag = F.when(F.col("__prev").isNull(), F.lit(0)).otherwise(
        F.coalesce(split(prev, cur), F.lit(False)).cast("int"))
    d = d.withColumn("__flag", flag)
    d = d.withColumn(
        "__local",
        F.sum("__flag").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summ = d.groupBy(*at).agg(
        _extreme(carry, order, last=False).alias("__first"),
        _extreme(carry, order, last=True).alias("__last"),
        F.sum("__flag").alias("__inner"),
    )
    ws = Window.partitionBy(*plain).orderBy(BUCKET)
    summ = summ.withColumn("__prev_last", F.lag("__last").over(ws))
    bprev = {c: F.col("__prev_last").getField(c) for c in carry}
    bcur = {c: F.col("__first").getField(c) for c in carry}
    first_flag = F.when(F.col("__prev_last").isNull(), F.lit(1)).otherwise(
        F.coalesce(split(bprev, bcur), F.lit(False)).cast("int"))
    summ = summ.withColumn("__ff", first_flag)
    summ = summ.select(
        *at, "__ff",
        F.coalesce(
            F.sum(F.col("__inner") + F.col("__ff")).over(
                ws.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("__off"),
    )
    res = join_on_keys(d, summ, at)
    sid = (F.col("__off") + F.col("__ff") + F.col("__local")).cast("long")
    return res.withColumn(out, sid).drop(
        "__prev", "__flag", "__local", "__ff", "__off", BUCKET, *plain)
