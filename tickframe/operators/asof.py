"""As-of join (backward: last right row at or before; forward: first right
row at or after) as a union + bucketed window, no nested-loop join.

Left and right rows are unioned on ``(by, t)``.  Inside each
``(by, bucket)`` a window picks the nearest right payload; a per-bucket
summary (one row per key and bucket) carries the nearest payload across
bucket boundaries, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_BUCKET_FRAMES
from .ordered import BUCKET, join_on_keys, with_bucket, with_plain_keys


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str,
              right_on: str, payload: Sequence[str], direction: str = "backward",
              right_order: str | None = None,
              width: int = DEFAULT_BUCKET_FRAMES) -> DataFrame:
    """Attach ``payload`` columns of the matching right row to every left row.

    Both boundaries are inclusive (a right row at exactly ``left_on`` matches).
    ``right_order`` breaks ties between right rows at the same ``right_on``
    (backward takes the last, forward the first).  Unmatched left rows get
    nulls.  ``by`` keys match null-safely.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    backward = direction == "backward"
    # Sort right rows before left rows at equal t for backward, after for forward.
    left_side, right_side = (1, 0) if backward else (0, 1)
    tie = F.col(right_order) if right_order else F.lit(0).cast("long")
    lcols = left.columns
    L = left.select(
        *[F.col(k) for k in by],
        F.col(left_on).alias("__t"), F.lit(left_side).alias("__side"),
        F.lit(0).cast("long").alias("__tie"),
        F.struct(*[F.col(c) for c in lcols]).alias("__l"),
        F.lit(None).cast(right.select(F.struct(*payload)).schema[0].dataType).alias("__r"),
    )
    R = right.select(
        *[F.col(k) for k in by],
        F.col(right_on).alias("__t"), F.lit(right_side).alias("__side"),
        tie.alias("__tie"),
        F.lit(None).cast(L.schema["__l"].dataType).alias("__l"),
        F.struct(*[F.col(c) for c in payload]).alias("__r"),
    )
    u, plain = with_plain_keys(with_bucket(L.unionByName(R), "__t", width, by), by)
    at = [*plain, BUCKET]

    def nearest(col: str, w):
        """The last non-null value up to the row, counted in the search's direction.

        A running frame takes one step a row; a frame from the row to the end of
        its partition would be scanned anew for every row.
        """
        return F.last(col, ignorenulls=True).over(w)

    def ordered(*names: str):
        return [F.col(n).asc() if backward else F.col(n).desc() for n in names]

    w = Window.partitionBy(*at).orderBy(*ordered("__t", "__side", "__tie"))
    is_right = F.col("__side") == right_side
    rkey = F.when(is_right, F.struct("__t", "__tie"))
    agg = (F.max_by if backward else F.min_by)("__r", rkey)
    summ = u.groupBy(*at).agg(agg.alias("__b"))
    ws = Window.partitionBy(*plain).orderBy(*ordered(BUCKET))
    summ = summ.select(*at, nearest("__b", ws.rowsBetween(Window.unboundedPreceding, -1))
                       .alias("__carry"))
    u = u.withColumn("__m", nearest("__r", w.rowsBetween(Window.unboundedPreceding,
                                                         Window.currentRow)))
    res = join_on_keys(u.filter(F.col("__side") == left_side), summ, at)
    m = F.coalesce(F.col("__m"), F.col("__carry"))
    return res.select(
        *[F.col("__l").getField(c).alias(c) for c in lcols],
        *[m.getField(p).alias(p) for p in payload],
    )
