"""Benchmark decontamination by winnowing.

Fingerprints are hashes of ``k`` words; of each ``window - k + 1`` neighbouring ones the smallest
is kept, so every span of ``window`` words shared by a document and an item shares a kept
fingerprint. A document's window is looked up only where its kept fingerprint is one of the
benchmark's; the hit is then extended to the whole window, compared by a second hash over all of its
words. Items shorter than a window are one window of their own length.

The benchmark is split into blocks of at most ``block_words`` words (the bound of what is broadcast); the
documents pass through one step per block without a shuffle, so rows stay where they were read and
neither the benchmark's size nor skewed keys matter.

Defined cases: null and empty texts have no words, no hits and are clean. Items without words match
nothing. Rows that repeat an ``item_id`` are one item. A null ``item_id`` counts as the item ``null``. Extra
columns of the documents are carried along. Long texts are hashed in pieces.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import (
    ALNUM,
    buffers,
    hash_grams,
    hash_spans,
    hash_words,
    mix,
    sliding_min,
    text_of,
)

# The contract's words, after lower-casing A-Z: everything but ASCII that is no letter or digit.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM, EXACT = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
COVERED, ITEMS = "__covered", "__items"


class Index:
    """Kept fingerprints and whole windows of one block of the benchmark, by length of window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, k: int):
        self.window, self.k = window, k
        found: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
        for name, text in items:
            data = np.frombuffer(text, np.uint8)
            words, _ = hash_words(data, np.array([0, len(data)]), ALNUM)
            length = min(window, len(words))
            if length:
                kept, whole = self._marks(words, length)
                found[length] += zip(kept.tolist(), whole.tolist(), [name] * len(kept))
        self.lengths = {}
        for length, marks in found.items():
            names: dict[tuple[int, int, int], set[str]] = defaultdict(set)
            for kept, whole, name in marks:
                pair = _paired(np.array([kept], np.uint64), np.array([whole], np.uint64))
                names[int(pair[0]), kept, whole].add(name)
            keys = sorted(names)
            pairs, kept_of, whole_of = (np.array(c, dtype=np.uint64) for c in zip(*keys))
            self.lengths[length] = (
                np.unique(kept_of), pairs, kept_of, whole_of, [sorted(names[key]) for key in keys]
            )

    def _marks(self, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window its kept fingerprint and the hash of all its words."""
        k = min(self.k, length)
        kept = sliding_min(hash_grams(words, k, GRAM), length - k + 1)
        return kept, hash_grams(words, length, EXACT)

    def hits(self, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, list[list[str]]]]:
        """Starts of windows that occur in the benchmark, their length, and where their items are listed.

        ``rows`` gives where each document's words begin; windows do not cross documents.
        """
        for length, (prints, pairs, kept_of, whole_of, names) in self.lengths.items():
            k = min(self.k, length)
            kept = sliding_min(hash_grams(words, k, GRAM), length - k + 1)
            at = _members(kept, prints)
            row = np.searchsorted(rows, at, "right")
            at = at[at + length <= rows[np.minimum(row, len(rows) - 1)]]
            if len(at):
                whole = hash_spans(words, at, length, EXACT)
                near = np.minimum(np.searchsorted(pairs, _paired(kept[at], whole)), len(pairs) - 1)
                good = (kept_of[near] == kept[at]) & (whole_of[near] == whole)
                yield at[good], length, near[good], names


def _paired(kept: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return whole ^ mix(kept + np.uint64(1))


def _members(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Indices of the values that are wanted (a sorted array); a table of bits sorts out most."""
    table = np.zeros(1 << 20, dtype=bool)
    table[(wanted >> np.uint64(44)).astype(np.int64)] = True
    at = np.flatnonzero(table[(values >> np.uint64(44)).astype(np.int64)])
    near = np.minimum(np.searchsorted(wanted, values[at]), len(wanted) - 1)
    return at[wanted[near] == values[at]]


def _pass(index, text_at: int):
    """Add one block's hits: the positions of covered words and the items of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, cuts = buffers(batch.column(text_at))
            words, rows = hash_words(data, cuts, ALNUM)
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            items: dict[int, set[str]] = defaultdict(set)
            for at, length, listed, names in index.value.hits(words, rows):
                np.add.at(covered, at, 1)
                np.add.at(covered, at + length, -1)
                row = np.searchsorted(rows, at, "right") - 1
                for r, n in np.unique(np.stack([row, listed], axis=1), axis=0).tolist():
                    items[r].update(names[n])
            hit = np.cumsum(covered)[:-1] > 0
            earlier, had = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            counts = np.diff(rows)
            spans: list[list[int] | None] = []
            names_out: list[list[str] | None] = []
            for row in range(batch.num_rows):
                before = earlier[row].as_py()
                if not items.get(row) and not before:
                    spans.append(before if before is not None else [])
                    names_out.append(had[row].as_py() or [])
                    continue
                mine = hit[rows[row] : rows[row + 1]].copy()
                if before:
                    mine[before] = True
                spans.append(np.flatnonzero(mine).tolist())
                names_out.append(sorted(items.get(row, set()).union(had[row].as_py() or [])))
            yield pa.record_batch(
                [
                    *batch.columns[:-3], pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.int32())), pa.array(names_out, pa.list_(pa.string())),
                ],
                names=batch.schema.names,
            )

    return run


def measure(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 13, k: int = 5, block_words: int = 2_000_000
) -> DataFrame:
    """The documents with ``__words`` (count), ``__covered`` (positions of hit words), ``__items`` (ids)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), text_of("text").alias("text"))
    size = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, -(-size // block_words))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = docs.withColumns(
        {
            "__words": F.lit(0).cast("long"), COVERED: F.array().cast("array<int>"),
            ITEMS: F.array().cast("array<string>"),
        }
    )
    text_at = docs.columns.index("text")
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("id", "text").collect()  # bounded by block_words
        index = Index([(r["id"], r["text"].encode()) for r in rows], window, k)
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(index), text_at), T.StructType(out.schema.fields))
    return out


def contaminated() -> Column:
    """The rule of the contract: a twentieth of the words, at least one, is covered by benchmark windows."""
    hit = F.size(COVERED).cast("long")
    return (hit > 0) & (20 * hit >= F.col("__words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents that are not contaminated, in all their columns."""
    measured = measure(docs, benchmark, **options)
    return measured.where(~contaminated()).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """Per document the counts and the digest of its items."""
    measured = measure(docs.select("doc_id", "text"), benchmark, **options)
    ids = F.array_join(F.sort_array(ITEMS), ",")
    return measured.select(
        "doc_id", F.col("__words").alias("n_words"), F.size(COVERED).cast("long").alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
        contaminated().alias("contaminated"), F.col(ITEMS).alias("items"),
    )

