"""Charts: exact top-N per group, globally and per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, n: int, groups: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per group. Each task keeps at most ``n`` rows per group to shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_n_global(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_windowed(
    df: DataFrame,
    n: int,
    ts: str,
    duration: str,
    group: str,
    item: str,
    name: str = "top",
) -> DataFrame:
    """Per window and group the ``n`` most frequent items, joined by line breaks.

    Equal counts are ordered by item name.
    """
    counts = df.groupBy(F.window(ts, duration).alias("w"), group, item).agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = top_n_per_group(counts, n, ["w", group], [F.col("_n").desc(), F.col(item).asc()], "_r")
    names = F.sort_array(F.collect_list(F.struct("_r", F.col(item).cast("string").alias("i"))))
    return (
        best.groupBy("w", group)
        .agg(names.alias("names"))
        .select(
            F.col("w.start").alias("start"), group, F.array_join("names.i", "\n").alias(name)
        )
    )


def chart_enrich(chart: DataFrame, items: DataFrame, item: str) -> DataFrame:
    """Attach item attributes to a chart. The chart is the small side and Spark sees its size."""
    return chart.join(items, item)


def chartable_plays(
    plays: DataFrame, catalog: DataFrame, item: str, duration: Column, least: float
) -> DataFrame:
    """Plays of at least ``least`` seconds counted per catalogued item.

    Plays are counted before the join, so the join sees one row per item and no hot key.
    """
    counted = plays.filter(duration >= least).groupBy(item).agg(F.count(F.lit(1)).alias("plays"))
    return counted.join(catalog, item)
