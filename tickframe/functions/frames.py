"""Frame-clock helpers (30 frames per second)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import FRAME_RATE, FRAMES_PER_MINUTE


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def minute_of(frame: str | Column) -> Column:
    """Game minute as a 32-bit int: ``floor(frame / 1800)``."""
    return F.floor(_c(frame) / F.lit(float(FRAMES_PER_MINUTE))).cast("int")


def bin_start(frame: str | Column, step: int) -> Column:
    """Start frame of the ``step``-frame bin holding ``frame`` (floor division)."""
    return (F.floor(_c(frame) / F.lit(step)) * F.lit(step)).cast("long")


def frames_to_seconds(frames: str | Column) -> Column:
    return _c(frames) / F.lit(float(FRAME_RATE))
