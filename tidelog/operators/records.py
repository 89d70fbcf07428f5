"""Stateless record operators. All of them run unchanged on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def filter_not(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where the predicate holds; a null predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def branch(df: DataFrame, predicates: Sequence[Column], name: str = "branch") -> DataFrame:
    """Tag each row with the index of its first matching predicate; drop rows matching none."""
    first = F.coalesce(*[F.when(p, F.lit(i)) for i, p in enumerate(predicates)])
    return df.withColumn(name, first).filter(F.col(name).isNotNull())


def map_values(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """Replace the value; the key and therefore the partitioning stay."""
    return df.withColumn(name, value)


def map_pairs(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.alias("key"), value.alias("value"))


def flat_map_pairs(df: DataFrame, pairs: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Each row becomes one row per ``(key, value)`` expression."""
    made = F.array(*[F.struct(k.alias("key"), v.alias("value")) for k, v in pairs])
    return df.select(F.explode(made).alias("kv")).select("kv.key", "kv.value")


def flat_map_values(df: DataFrame, values: Column, name: str = "value") -> DataFrame:
    """Each element of the array becomes one row under the same key."""
    return df.withColumn(name, F.explode(values))


def select_key(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumn("key", key)


def peek_count(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows while they pass; read the number from ``observation`` after an action."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def prefix_values(df: DataFrame, column: str, prefix: str = "PREFIX:") -> DataFrame:
    return df.withColumn(column, F.concat(F.lit(prefix), F.col(column)))


def drop_corrupt(df: DataFrame, decoded: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into decoded ones and dead letters, where ``decoded`` is null on failure."""
    tried = df.withColumn(name, decoded)
    good = tried.filter(F.col(name).isNotNull())
    dead = tried.filter(F.col(name).isNull()).drop(name)
    return good, dead


def sink_fanout(
    df: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """One input, several transformed outputs, told apart by the column ``out``.

    Transformations may be anything, so each reads the input; projections share one pass in
    ``fanout_values``.
    """
    parts = [fn(df).withColumn("out", F.lit(name)) for name, fn in outputs.items()]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def fanout_values(df: DataFrame, outputs: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Several outputs that are projections of one input, made in one pass over it.

    The columns of each output carry the same names and types; ``out`` tells the outputs apart.
    """
    made = [F.struct(*columns, F.lit(name).alias("out")) for name, columns in outputs.items()]
    return df.select(F.inline(F.array(*made)))


def fold_sum(df: DataFrame, value: Column, name: str = "total") -> DataFrame:
    """Fold all rows into one sum; partial sums are made before the single-row exchange."""
    return df.agg(F.sum(value).alias(name))


def head(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def range_source(df: DataFrame, upto: Column, name: str = "n") -> DataFrame:
    """A numeric source: each row yields 1 to ``upto``."""
    return df.filter(upto >= 1).withColumn(name, F.explode(F.sequence(F.lit(1), upto)))
