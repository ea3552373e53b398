"""Folds that no built-in aggregate covers (VW-14), without gathering a group.

A ``Fold`` says how rows are folded into a state and how two states are merged.
Every task folds its own rows into one state a group; the states are then merged
as a tree, ``FAN`` at a time, so neither the rows nor the states of a hot group
meet in one task.  States are merged in the order of the tasks, so a merge must
be associative but need not commute.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..scratch import stored

FAN = 16
MAX_STATES = 50_000     # groups a task holds before it passes their states on


@dataclass(frozen=True)
class Fold:
    """``update`` gets a group's rows of one batch, as an array a column.

    ``finish`` returns the values of ``result`` (DDL) for a group.
    """

    columns: tuple[str, ...]
    zero: Callable[[], Any]
    update: Callable[[Any, dict[str, np.ndarray]], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], tuple]
    result: str


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def _partial(fold: Fold, keys: Sequence[str], fields: list[T.StructField]):
    """A task's states: rows (keys..., part, seq, state)."""
    arrow = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in fields),
                       ("__part", pa.int64()), ("__seq", pa.int64()), ("__state", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        states: dict[tuple, Any] = {}

        def flush() -> pa.RecordBatch:
            nonlocal seq
            columns = list(zip(*states, strict=True)) if keys else []
            out = pa.record_batch(
                [*(pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=False)),
                 pa.array([part] * len(states), pa.int64()),
                 pa.array([seq] * len(states), pa.int64()),
                 pa.array([pickle.dumps(s) for s in states.values()], pa.binary())],
                schema=arrow)
            states.clear()
            seq += 1
            return out

        for batch in batches:
            table = pa.table([*(batch.column(c) for c in batch.schema.names),
                              pa.array(np.arange(batch.num_rows))],
                             names=[*batch.schema.names, "__row"])
            values = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in fold.columns}
            if keys:
                groups = table.group_by(list(keys), use_threads=False).aggregate(
                    [("__row", "list")])
                names = zip(*(groups.column(k).to_pylist() for k in keys), strict=True)
                places = groups.column("__row_list").to_pylist()
            else:
                names, places = [()], [list(range(batch.num_rows))]
            for name, rows in zip(names, places, strict=True):
                if not rows:
                    continue
                state = states[name] if name in states else fold.zero()
                states[name] = fold.update(state, {c: v[rows] for c, v in values.items()})
            if len(states) > MAX_STATES:
                yield flush()
        if states:
            yield flush()

    return run


def _merged(fold: Fold, keys: Sequence[str]):
    """Neighbouring states of one group and branch become one; rows come sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state, schema = None, None, None
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.record_batch([pa.array(list(c), f.type)
                                    for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            at = [*keys, "__branch"]
            schema = pa.schema([*(batch.schema.field(c) for c in at), ("__seq", pa.int64()),
                                ("__state", pa.binary())])
            for *key, packed in zip(*(batch.column(c).to_pylist() for c in (*at, "__state")),
                                    strict=True):
                if key == open_key:
                    state = fold.merge(state, pickle.loads(packed))
                    continue
                if open_key is not None:
                    done.append((*open_key, 0, pickle.dumps(state)))
                open_key, state = key, pickle.loads(packed)
            if done:
                yield flush()
        if open_key is not None:
            done.append((*open_key, 0, pickle.dumps(state)))
            yield flush()

    return run


def fold_by(df: DataFrame, keys: Sequence[str], fold: Fold, fan: int = FAN) -> DataFrame:
    """(keys..., result columns): ``fold`` over the rows of each group."""
    keys = list(keys)
    fields = _key_fields(df, keys)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    lead = f"{names}, " if names else ""
    states = stored(df.select(*keys, *[c for c in fold.columns if c not in keys]).mapInArrow(
        _partial(fold, keys, fields), f"{lead}__part long, __seq long, __state binary"), "states")
    while True:
        most = states.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if not most or most == 1:
            break
        # the states of ``fan`` neighbouring tasks, or branches, meet
        rows = states.withColumn("__branch", F.floor(F.col("__part") / fan).cast("long"))
        states = stored(
            rows.repartition(*keys, "__branch").sortWithinPartitions(
                *keys, "__branch", "__part", "__seq")
            .mapInArrow(_merged(fold, keys),
                        f"{lead}__branch long, __seq long, __state binary")
            .withColumnRenamed("__branch", "__part"), "states")
    out = T.StructType.fromDDL(fold.result)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fold.finish(pickle.loads(s)) for s in batch.column("__state").to_pylist()]
            columns = list(zip(*values, strict=True)) if values else [()] * len(out)
            yield pa.record_batch(
                [*(batch.column(k) for k in keys),
                 *(pa.array(list(c), to_arrow_type(f.dataType))
                   for c, f in zip(columns, out, strict=True))], [*keys, *out.names])

    return states.select(*keys, "__state").mapInArrow(finish, T.StructType([*fields, *out]))

