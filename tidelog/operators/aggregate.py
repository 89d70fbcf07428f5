"""Keyed aggregation, tables (changelogs) and running values.

Built-in aggregates combine before the shuffle, so a hot key costs one partial row per task.
Order-dependent values go through ``KeyedOrder``, which cuts hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, tiles


def group_count(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_reduce(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Associative reduce; the sum."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def group_aggregate(df: DataFrame, keys: Sequence[str], text: str, name: str) -> DataFrame:
    """Start value plus adder: total length of the texts."""
    return df.groupBy(*keys).agg(F.sum(F.length(text)).cast("bigint").alias(name))


def group_max(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def group_avg_parts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Count, sum and their quotient; parts from several frames merge by adding."""
    parts = df.groupBy(*keys).agg(F.count(value).alias("cnt"), F.sum(value).alias("total"))
    return finish_avg(parts)


def merge_avg_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up ``cnt`` and ``total``; negative parts remove rows again."""
    return finish_avg(
        parts.groupBy(*keys).agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))
    )


def finish_avg(parts: DataFrame) -> DataFrame:
    return parts.withColumn("avg", F.try_divide(F.col("total"), F.col("cnt")))


def word_count(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Count the tokens of all rows; ``tokens`` is an array expression over the frame."""
    return group_count(df.select(F.explode(tokens).alias(name)), [name])


def having_filter(aggregated: DataFrame, predicate: Column) -> DataFrame:
    return aggregated.filter(predicate)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole newest row per key, combined before the shuffle (no sort, no window)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"row.{c}") for c in rest])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole oldest row per key."""
    rest = [c for c in df.columns if c not in keys]
    oldest = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(oldest).select(*keys, *[F.col(f"row.{c}") for c in rest])


latest_reduce = latest_rows
first_reduce = first_rows


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str
) -> DataFrame:
    """Changelog to table: newest row per key, where a null value deletes the key."""
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return latest_rows(present, keys, order).filter(F.col(value).isNotNull())


read_table = latest_by_key


def table_regroup_count(
    changelog: DataFrame, keys: Sequence[str], order: Sequence[str], group: str, name: str = "cnt"
) -> DataFrame:
    """Number of current rows per group; a group all rows have left stays with 0."""
    return table_regroup_aggregate(changelog, keys, order, group, F.lit(1), name)


def table_regroup_aggregate(
    changelog: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    group: str,
    value: Column,
    name: str,
) -> DataFrame:
    """Sum over current rows per group. Groups ever seen enter as 0, current rows as values."""
    seen = changelog.select(group).filter(F.col(group).isNotNull()).distinct()
    current = latest_by_key(changelog, keys, order, group)
    both = seen.withColumn("_v", F.lit(0)).unionByName(current.select(group, value.alias("_v")))
    return both.groupBy(group).agg(F.sum("_v").cast("bigint").alias(name))


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: Column,
    name: str = "cnt",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The count so far, once per input row: every update of the counting table."""
    return KeyedOrder.of(df, keys, order, position, rows_per_chunk).number(name).result()


def punctuate_snapshot(
    df: DataFrame, keys: Sequence[str], ts: str, every_micros: int, name: str = "cnt"
) -> DataFrame:
    """At each tick the whole table of counts so far, from a key's first row to the last tick.

    Rows are counted per key and tick before any ordering, so one key has at most one row per
    tick whatever its volume.
    """
    due = (F.floor(F.unix_micros(ts) / F.lit(every_micros)) + 1) * F.lit(every_micros)
    counts = df.groupBy(*keys, due.alias("_tick")).agg(F.count(F.lit(1)).alias("_n"))
    end = counts.agg(F.max("_tick")).scalar()
    order = Window.partitionBy(*keys).orderBy("_tick")
    until = F.coalesce(F.lead("_tick").over(order) - F.lit(every_micros), end)
    held = counts.select(
        *keys,
        F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(name),
        F.sequence(F.col("_tick"), until, F.lit(every_micros).cast("bigint")).alias("_ticks"),
    )
    return held.select(*keys, name, F.explode("_ticks").alias("_tick")).select(
        *keys, name, F.timestamp_micros("_tick").alias("tick")
    )


def moving_average(
    df: DataFrame,
    n: int,
    keys: Sequence[str],
    order: Sequence[str],
    position: Column,
    number: Column,
    name: str = "avg",
    tile_rows: int = 1_000_000,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Whole-number mean of the last ``n`` valid numbers after each row.

    A row with a null ``number`` repeats the current mean; rows before the first valid one
    yield nothing. Rows are numbered by valid predecessors, then cut into tiles by that number,
    so a frame needs only the ``n - 1`` valid rows before its tile.
    """
    counted = (
        KeyedOrder.of(df.withColumn("_num", number), keys, order, position, rows_per_chunk)
        .running({"_valid": ("count", F.col("_num"))})
        .result()
        .filter(F.col("_valid") > 0)
    )
    cut = tiles(counted, F.col("_valid"), max(tile_rows, n), before=n - 1)
    frame = Window.partitionBy(*keys, "_tile").orderBy("_valid").rangeBetween(-(n - 1), 0)
    mean = F.sum("_num").over(frame)
    return (
        cut.withColumn("_sum", mean)
        .filter("_own")
        .withColumn(name, F.expr(f"_sum div least(_valid, {n})"))
        .drop("_num", "_valid", "_tile", "_own", "_sum")
    )


def message_rate_stats(
    df: DataFrame, ts: str, seconds: int, latency: Column, failed: Column
) -> DataFrame:
    """Per interval: messages per second, mean and largest latency, failures."""
    slot = F.window(ts, f"{seconds} seconds")
    return (
        df.groupBy(slot.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.round(F.avg(latency), 6).alias("avg_latency"),
            F.max(latency).alias("max_latency"),
            F.count_if(failed).alias("failures"),
        )
        .select(
            F.col("w.start").alias("start"),
            "messages",
            F.round(F.col("messages") / seconds, 6).alias("tps"),
            "avg_latency",
            "max_latency",
            "failures",
        )
    )
