"""The partitioned log: offsets, range scans, resuming and replay protection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder

LOG_SCHEMA = "topic string, partition int, offset bigint, ts timestamp, key string, value string"


def as_log(
    df: DataFrame,
    *,
    topic: str,
    partitions: int,
    partition_key: Column,
    arrival: str,
    key: Column,
    value: Column,
    ts: str = "ts",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number the rows of a table per partition in arrival order, as a broker would on append.

    There are few partitions and each one is long, so the numbering runs over chunks.
    """
    placed = df.withColumn("partition", F.pmod(partition_key, F.lit(partitions)).cast("int"))
    numbered = KeyedOrder.of(
        placed, ["partition"], [arrival], F.col(arrival), rows_per_chunk
    ).number("offset")
    return numbered.result().select(
        F.lit(topic).alias("topic"),
        "partition",
        (F.col("offset") - 1).alias("offset"),
        F.col(ts).alias("ts"),
        key.alias("key"),
        value.alias("value"),
    )


def offset_range_scan(
    log: DataFrame, ranges: Mapping[int, tuple[int, int]], *, expected: set[int] | None = None
) -> DataFrame:
    """Rows with ``start <= offset < stop`` per partition; nothing when ``stop <= start``.

    The ranges become literal predicates, so partition folders and row groups are pruned.
    ``expected`` partitions without a range are an error.
    """
    missing = sorted((expected or set()) - set(ranges))
    if missing:
        raise ValueError(f"missing offsets for partition(s) {missing}")
    wanted = [
        (F.col("partition") == p) & (F.col("offset") >= start) & (F.col("offset") < stop)
        for p, (start, stop) in sorted(ranges.items())
        if start < stop
    ]
    return log.filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def offset_bounds(log: DataFrame) -> DataFrame:
    """Earliest offset and the offset after the latest, per partition."""
    return log.groupBy("partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")
    )


def resume_from_offset(log: DataFrame, saved: DataFrame) -> DataFrame:
    """Rows after the saved offset of their partition, or all rows where none is saved.

    ``saved`` has one row per partition: ``(partition, saved_offset)``.
    """
    return (
        log.join(saved.select("partition", "saved_offset"), "partition", "left")
        .filter(F.col("offset") >= F.coalesce(F.col("saved_offset") + 1, F.lit(0)))
        .drop("saved_offset")
    )


def drop_replayed(
    arrivals: DataFrame,
    *,
    arrival: str = "arrival",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Drop rows whose offset lies below the highest one already seen in their partition."""
    seen = KeyedOrder.of(
        arrivals, ["partition"], [arrival], F.col(arrival), rows_per_chunk
    ).running({"_high": ("max", F.col("offset"))}, inclusive=False)
    fresh = F.col("_high").isNull() | (F.col("offset") >= F.col("_high"))
    return seen.result().filter(fresh).drop("_high")
