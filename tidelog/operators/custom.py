"""Hooks for user-written mappers and aggregates, for what built-in functions cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def map_values_with(
    df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series], kind: str, out: str
) -> DataFrame:
    """Apply a vectorised Python function to one column."""
    return df.withColumn(out, F.pandas_udf(fn, kind)(F.col(column)))


def aggregate_with(
    df: DataFrame,
    keys: Sequence[str],
    initial: Callable[[], tuple],
    add: Callable[[tuple, dict], tuple],
    merge: Callable[[tuple, tuple], tuple],
    state: Sequence[tuple[str, str]],
) -> DataFrame:
    """Initializer, adder and merger per key, with ``state`` naming the result columns.

    Each task folds its own rows first, so a hot key ships one state per task. Rows arrive
    sorted by key and only the current key's state is held.
    """
    names = [n for n, _ in state]
    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join(kinds + [f"`{n}` {t}" for n, t in state])
    fields = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def folding(step: Callable[[tuple | None, dict], tuple]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, None

            def made(done: list[tuple]) -> pa.RecordBatch:
                columns = list(zip(*done)) if done else [()] * len(fields)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
                return pa.RecordBatch.from_arrays(arrays, schema=fields)

            for batch in batches:
                done = []
                # Python values keep whole numbers beside nulls as they are.
                for row in batch.to_pylist():
                    at = tuple(row[k] for k in keys)
                    if at != key:
                        if key is not None:
                            done.append((*key, *held))
                        key, held = at, None
                    held = step(held, row)
                yield made(done)
            if key is not None:
                yield made([(*key, *held)])

        return run

    def add_row(held, row):
        return add(initial() if held is None else held, row)

    def merge_row(held, row):
        other = tuple(row[n] for n in names)
        return other if held is None else merge(held, other)

    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    partial = df.sortWithinPartitions(*keys).mapInArrow(folding(add_row), schema)
    moved = partial.repartition(*keys).sortWithinPartitions(*keys)
    return moved.mapInArrow(folding(merge_row), schema)
