"""Dropping repeated ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, frame_edge, micros, tiles


def dedup_window(
    df: DataFrame,
    ids: Sequence[str],
    ts: str,
    arrival: Sequence[str],
    span: int,
    *,
    in_order: bool = True,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Drop a row when its id arrived before with an instant in ``[t - d/2, t + d - d/2]``.

    Dropped rows are remembered too, so repeats extend the memory. Rows without an id pass.
    With rows in time order only the previous row of the id matters. Otherwise each row asks
    for the earliest arrival inside its frame of time.
    """
    has_id = F.lit(True)
    for c in ids:
        has_id = has_id & F.col(c).isNotNull()
    known, unknown = df.filter(has_id), df.filter(~has_id)
    half = span // 2
    at = micros(ts)
    if in_order:
        seen = KeyedOrder.of(known, ids, [ts, *arrival], at, rows_per_chunk).running(
            {"_last": ("max", at)}, inclusive=False
        )
        repeat = F.coalesce(F.col("_last") >= at - F.lit(half), F.lit(False))
        fresh = seen.result().filter(~repeat).drop("_last")
    else:
        fresh = _first_in_frame(known.withColumn("_at", at), ids, arrival, span, half)
    return fresh.unionByName(unknown)


def _first_in_frame(
    known: DataFrame, ids: Sequence[str], arrival: Sequence[str], span: int, half: int
) -> DataFrame:
    """Rows that arrived first within ``[_at - half, _at + span - half]``.

    The frame is as long as a block of ``span``, so it always ends in the block after the one
    it starts in. Its earliest arrival is the smaller of two running minima: from its first row
    to the end of the first block, and from the start of the second block to its last row.
    """
    rank, rest = F.struct(*arrival), span - half
    cut = tiles(known, F.col("_at"), 4 * span, half, rest)
    cut = cut.withColumn("_block", F.floor(F.col("_at") / F.lit(span)))
    block = Window.partitionBy(*ids, "_tile", "_block")
    # Range frames: rows of one instant all see each other.
    upto = Window.unboundedPreceding, 0
    low = F.min(rank).over(block.orderBy(F.col("_at").desc()).rangeBetween(*upto))
    high = F.min(rank).over(block.orderBy(F.col("_at").asc()).rangeBetween(*upto))
    group = [*ids, "_tile"]
    edges = cut.withColumn("_low", F.struct("_block", low.alias("first"))).withColumn(
        "_high", F.struct("_block", high.alias("first"))
    )
    edges = frame_edge(edges, group, "_at", -half, F.col("_low"), "_from", upward=True)
    edges = frame_edge(edges, group, "_at", rest, F.col("_high"), "_to", upward=False)
    start = F.floor((F.col("_at") - F.lit(half)) / F.lit(span))
    first = F.least(
        F.when(F.col("_from._block") == start, F.col("_from.first")),
        F.when(F.col("_to._block") == start + 1, F.col("_to.first")),
    )
    return edges.filter(F.col("_own") & ~(first < rank)).select(
        *[c for c in known.columns if c != "_at"]
    )


def dedup_watermark(df: DataFrame, ids: Sequence[str], ts: str, span: str) -> DataFrame:
    """Streaming built-in: first row per id within the watermark delay. Unlike
    ``dedup_window`` repeats do not extend the memory."""
    return df.withWatermark(ts, span).dropDuplicatesWithinWatermark(list(ids))
