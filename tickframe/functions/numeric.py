"""Numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def euclid(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def quantize(c: str | Column, scale: float) -> Column:
    """Static quantization ``round(x / scale)`` with half-even ties."""
    return F.bround(_c(c).cast("double") / F.lit(scale), 0)
