"""Consecutive batches of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder
from tidelog.sources.scratch import scratch_dir, through

# Rows whose batches one call of the helper finds; results do not depend on it.
ROWS_PER_PIECE = 10_000


def grouped(
    df: DataFrame,
    n: int,
    keys: Sequence[str],
    order: Sequence[str],
    position: Column,
    value: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Consecutive batches of ``n`` rows per key as ordered arrays."""
    numbered = KeyedOrder.of(df, keys, order, position, rows_per_chunk).number("_rn").result()
    rows = F.sort_array(F.collect_list(F.struct("_rn", F.col(value).alias("value"))))
    return (
        numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / n))
        .groupBy(*keys, "batch")
        .agg(rows.alias("rows"))
        .select(*keys, "batch", F.col("rows.value").alias("values"))
    )


def size_batches(
    df: DataFrame,
    limit: int,
    keys: Sequence[str],
    order: Sequence[str],
    position: Column,
    size: Column,
    row_id: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Split each key's rows greedily into batches of at most ``limit`` in total size.

    A row larger than the limit forms a batch alone; a null or negative size counts as 0. Rows
    with a null key are dropped. Returns ``keys, batch, row_id, size``, batches from 0.

    Where a batch begins depends on all rows before it, but only through one number, what the
    open batch holds. So a key is cut into pieces of consecutive rows, and

    1. every piece tells, for each content it may be entered with, what it hands on and how many
       batches begin in it (pieces in parallel);
    2. the numbers are handed from piece to piece in one sorted pass, one row per piece;
    3. every piece places its rows (in parallel).
    """
    counted = F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).cast("bigint")
    narrow = df.select(*dict.fromkeys([*keys, *order, row_id]), position.alias("_place"), counted.alias("_size"))
    numbered = KeyedOrder.of(narrow, keys, order, F.col("_place"), rows_per_chunk).number("_rn")
    row = F.struct("_rn", F.col(row_id).alias("id"), F.col("_size").alias("size"))
    pieces = (
        numbered.result()
        .withColumn("_piece", F.floor((F.col("_rn") - 1) / rows_per_piece))
        .groupBy(*keys, "_piece")
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))
        .select(*keys, "_piece", F.col("_rows.id").alias("_ids"), F.col("_rows.size").alias("_sizes"))
    )
    # Written once: read for what the pieces hand on, and again to place their rows.
    pieces = through(pieces, scratch_dir(df.sparkSession, "batch-pieces"))
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    fixed = [f"`{k}` {kinds[k]}" for k in [*keys, "_piece"]]

    def tabulate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            tables = [_handed_on(np.asarray(s, dtype="int64"), limit) for s in pdf.pop("_sizes")]
            columns = [list(c) for c in zip(*tables)] or [[]] * 4
            yield pdf.assign(_total=columns[0], _from=columns[1], _used=columns[2], _begun=columns[3])

    table = "_total bigint, _from array<bigint>, _used array<bigint>, _begun array<bigint>"
    # Keys travel as text, so that a null or a large number stays what it is.
    name = F.to_json(F.struct(*keys))
    chain = (
        pieces.select(name.alias("_key"), "_piece", "_sizes")
        .mapInPandas(tabulate, f"_key string, _piece bigint, {table}")
        .repartition("_key")
        .sortWithinPartitions("_key", "_piece")
    )

    def hand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, used, batches = None, 0, 0
        for pdf in frames:
            entered = []
            for r in pdf.itertuples(index=False, name=None):
                if r[0] != key:
                    # Nothing is open before the first row: it begins a batch, as after a full one.
                    key, used, batches = r[0], limit + 1, 0
                entered.append((used, batches))
                at = int(np.searchsorted(r[3], used, side="right")) - 1
                used, begun = (used + r[2], 0) if at < 0 else (int(r[4][at]), int(r[5][at]))
                batches += begun
            yield pd.DataFrame(
                {"_key": pdf["_key"], "_piece": pdf["_piece"], "_open": [e[0] for e in entered], "_batches": [e[1] for e in entered]}
            )

    entries = chain.mapInPandas(hand, "_key string, _piece bigint, _open bigint, _batches bigint")

    @F.pandas_udf("array<bigint>")
    def place(sizes: pd.Series, opened: pd.Series, batches: pd.Series) -> pd.Series:
        return pd.Series(
            [_placed(np.asarray(s, dtype="int64"), limit, o, b) for s, o, b in zip(sizes, opened, batches)]
        )

    placed = pieces.withColumn("_key", name).join(entries, ["_key", "_piece"])
    rows = F.arrays_zip("_ids", "_sizes", place("_sizes", "_open", "_batches").alias("_batch"))
    return placed.select(*keys, F.explode(rows).alias("_r")).select(
        *keys, F.col("_r._batch").alias("batch"), F.col("_r._ids").alias(row_id), F.col("_r._sizes").alias("size")
    )


def _next_starts(sizes: np.ndarray, limit: int) -> np.ndarray:
    """For a batch begun at each row, where the next one begins; the length if not among these rows."""
    upto = np.cumsum(sizes)
    following = np.searchsorted(upto, upto - sizes + limit, side="right")
    return np.maximum(following, np.arange(len(sizes)) + 1)


def _handed_on(sizes: np.ndarray, limit: int) -> tuple[int, list, list, list]:
    """Total size, then steps: entered with at least ``from``, the last batch holds ``used`` at the
    end and ``begun`` batches have begun. Below the first step no batch begins.

    Contents above the limit count as ``limit + 1``. The ends of all batches are found at once, by
    doubling the pointers to the next start.
    """
    n = len(sizes)
    upto = np.cumsum(sizes)
    jump = np.append(_next_starts(sizes, limit), n)
    begun = np.append(np.ones(n, dtype="int64"), 0)
    last = np.arange(n + 1)
    while (jump[:n] < n).any():
        last = np.where(jump < n, last[jump], last)
        begun = begun + begun[jump]
        jump = jump[jump]
    used = np.minimum(upto[-1] - upto[last[:n]] + sizes[last[:n]], limit + 1)
    # The first row that does not fit begins a batch; rows of size 0 behind it never do.
    sums, first = np.unique(upto, return_index=True)
    reach = np.searchsorted(sums, limit, side="right") + 1
    sums, first = sums[:reach][::-1], first[:reach][::-1]
    start = np.maximum(limit - sums + 1, 0)
    ends, counts = used[first], begun[first]
    change = np.append(True, (ends[1:] != ends[:-1]) | (counts[1:] != counts[:-1]))
    return int(upto[-1]), start[change].tolist(), ends[change].tolist(), counts[change].tolist()


def _placed(sizes: np.ndarray, limit: int, opened: int, batches: int) -> np.ndarray:
    """Batch of every row, entered with a content and a number of batches begun before."""
    following = _next_starts(sizes, limit)
    begins = np.zeros(len(sizes), dtype="int64")
    at = int(np.searchsorted(np.cumsum(sizes), limit - opened, side="right"))
    while at < len(sizes):
        begins[at] = 1
        at = int(following[at])
    return batches - 1 + np.cumsum(begins)
