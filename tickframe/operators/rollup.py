"""Grouped aggregations that are declared, so that several can share one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rollup:
    """One group-by over one aspect, in SQL expressions.

    ``columns`` are the result's columns, over ``keys`` and ``aggregates`` by name.
    """

    aspect: str
    keys: tuple[tuple[str, str], ...]
    aggregates: tuple[tuple[str, str], ...]
    columns: tuple[tuple[str, str], ...]
    where: str | None = None

    @property
    def pass_key(self) -> tuple:
        """Rollups with equal pass keys can be evaluated in one pass."""
        return self.aspect, tuple(e for _, e in self.keys), self.where

    def evaluate(self, df: DataFrame) -> DataFrame:
        return self.finish(aggregate_together([self], df))

    def finish(self, summed: DataFrame) -> DataFrame:
        """The result, from a frame of ``aggregate_together`` that includes this rollup."""
        places = _places(summed)
        named = summed.select("replay_id", *[
            F.col(places[e]).alias(n) for n, e in (*self.keys, *self.aggregates)])
        return named.select("replay_id", *[F.expr(e).alias(n) for n, e in self.columns])


def _places(summed: DataFrame) -> dict[str, str]:
    """Expression -> column of a summed frame; the expressions are kept as column metadata."""
    return {f.metadata["expr"]: f.name for f in summed.schema.fields if "expr" in f.metadata}


def aggregate_together(rollups: Sequence[Rollup], df: DataFrame) -> DataFrame:
    """All aggregates of rollups with one pass key; equal expressions are computed once."""
    first = rollups[0]
    if any(r.pass_key != first.pass_key for r in rollups):
        raise ValueError("rollups of different aspects, keys or filters share no pass")
    if first.where:
        df = df.where(first.where)
    keys = [e for _, e in first.keys]
    wanted = list(dict.fromkeys(e for r in rollups for _, e in r.aggregates))
    return df.groupBy("replay_id", *[
        F.expr(e).alias(f"k{i}") for i, e in enumerate(keys)]).agg(
        *[F.expr(e).alias(f"a{i}") for i, e in enumerate(wanted)]).select(
        "replay_id",
        *[F.col(f"k{i}").alias(f"k{i}", metadata={"expr": e}) for i, e in enumerate(keys)],
        *[F.col(f"a{i}").alias(f"a{i}", metadata={"expr": e}) for i, e in enumerate(wanted)])
