"""Table-level helpers used across plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def force_int_column(df: DataFrame, col: str) -> DataFrame:
    """ING-8: if ``col`` is a struct, lift its fields to top level; then make
    ``col`` a 64-bit integer.  Absent columns leave the frame unchanged."""
    if col not in df.columns:
        return df
    if isinstance(df.schema[col].dataType, T.StructType):
        others = [F.col(c) for c in df.columns if c != col]
        df = df.select(*others, f"{col}.*")
    return df.withColumn(col, F.col(col).cast("long"))


def union_diagonal(*dfs: DataFrame) -> DataFrame:
    """SET-2: union by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def null_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG-16: number of nulls per column (optionally per group)."""
    cols = [c for c in df.columns if c not in (by or [])]
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    return df.groupBy(*(by or [])).agg(*aggs)
