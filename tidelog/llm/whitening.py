"""Whitened principal components of embeddings, from exact cross-products of whole numbers.

**Whole numbers.** An entry c becomes x = floor(1024 c) + 100000.

**Bit-sliced scatter.** A task takes blocks of rows, shifts each dimension by its least value in the block and packs
bit plane b of a dimension, across rows, into 64-bit words. The cross-product of two dimensions is the sum over pairs
of planes (a, b) of 2^(a+b) times the set bits of their AND, and the shift is added back. A task hands on one sum per pair of dimensions, so the
shuffle does not grow with the rows; products are kept as whole numbers of any size.

**Components.** The driver gets n, the sums S and the cross-products M: numbers by pairs of dimensions. n M - S S' is exact; divided by n
squared it is the covariance that ``eigh`` decomposes.

Defined cases: a vector that is null or holds nulls or non-finite entries, or an entry whose x no long holds, is left
out. Vectors of different widths have no common covariance: each width is a fit list of its own. An empty vector has
no component and no row. Directions whose variance is below ``FLAT`` of the largest cannot be told from rounding and are no
components, so fewer than eight may come back, and none where all vectors are equal. A deviation that no long holds
is null; ``deviation_text`` always has its digits. Null and repeated ids are rows like others; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ready

# Fixed values of the contract.
SCALE, SHIFT, COMPONENTS = 1024.0, 100_000, 8
# Rows of a block are a multiple of 64; a block is at most so many entries.
BLOCK_ROWS, BLOCK_ENTRIES = 4096, 1 << 20
FLAT = 1e-10
LIMB = 10**18
LONG = 1 << 63

PARTIAL = "width int, j int, k int, high decimal(38,0), low decimal(38,0)"
OUTPUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, deviation_text string, whitened double, explained double"
)


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors that count, by width: their places in the batch, and x as a matrix of rows."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        bad = ~((scaled >= -(2.0**63)) & (scaled < 2.0**63 - 2.0**18))
    before = np.concatenate([[0], np.cumsum(bad)])
    clean = before[offsets[1:]] == before[offsets[:-1]]
    widths = np.diff(offsets)
    counts = lists.is_valid().to_numpy(zero_copy_only=False) & clean & (widths > 0)
    for width in np.unique(widths[counts]):
        places = np.flatnonzero(counts & (widths == width))
        entries = scaled[offsets[places][:, None] + np.arange(width)]
        yield places, entries.astype(np.int64) + SHIFT


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Planes of non-negative columns: [dimension, bit, word], each bit of a word one row."""
    rows, width = y.shape
    padded = np.zeros((width, -(-rows // 64) * 64), dtype=np.uint64)
    padded[:, :rows] = y.T
    planes = np.empty((width, bits, padded.shape[1] // 64), dtype=np.uint64)
    for b in range(bits):
        ones = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        planes[:, b] = np.packbits(ones, axis=1).view(np.uint64)
    return planes


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products (upper triangle) of the columns of whole numbers, as Python ints."""
    rows, width = x.shape
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # right modulo 2**64, whatever the signs
    bits = max(int(y.max()).bit_length(), 1)
    planes = bit_planes(y, bits)
    kind = np.int64 if 2 * bits + rows.bit_length() < 63 else object
    weights = np.array([1 << b for b in range(bits)], dtype=kind)
    sums = np.bitwise_count(planes).sum(axis=-1, dtype=np.int64).astype(kind) @ weights
    cross = np.zeros((width, width), dtype=kind)
    for j in range(width):
        for a in range(bits):
            both = np.bitwise_count(planes[j:] & planes[j, a]).sum(axis=-1, dtype=np.int64)
            cross[j, j:] += (both.astype(kind) @ weights) * weights[a]
    base, sums = low.astype(object), sums.astype(object)
    shifted = np.multiply.outer(base, sums)
    whole = cross.astype(object) + shifted + shifted.T + rows * np.multiply.outer(base, base)
    return sums + rows * base, np.triu(whole)


class _Totals:
    """Sums of one task, by width; rows wait until they fill a block."""

    def __init__(self) -> None:
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.entries = 0
        self.done: dict[int, list] = {}

    def add(self, x: np.ndarray) -> None:
        self.waiting.setdefault(x.shape[1], []).append(x)
        self.entries += x.size
        if self.entries >= BLOCK_ENTRIES or sum(len(w) for w in self.waiting[x.shape[1]]) >= BLOCK_ROWS:
            self.flush()

    def flush(self) -> None:
        for width, parts in self.waiting.items():
            rows = np.concatenate(parts)
            for begin in range(0, len(rows), BLOCK_ROWS):
                block = rows[begin : begin + BLOCK_ROWS]
                sums, cross = scatter(block)
                have = self.done.setdefault(width, [0, 0, 0])
                self.done[width] = [have[0] + len(block), have[1] + sums, have[2] + cross]
        self.waiting, self.entries = {}, 0

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for width, (n, sums, cross) in self.done.items():
            yield width, -1, -1, n
            for j in range(width):
                yield width, -1, j, sums[j]
                for k in range(j, width):
                    yield width, j, k, cross[j, k]


@dataclass(frozen=True)
class Fit:
    """A fit list: its size, sums, and the components it has."""

    n: int
    sums: list[int]
    variances: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray  # one column per component

    @property
    def whiten(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.variances)


def components(n: int, sums: list[int], cross: list[list[int]], most: int = COMPONENTS) -> Fit:
    """Components from exact sums; ``cross`` is the upper triangle."""
    width = len(sums)
    centred = [[0] * width for _ in range(width)]
    for j in range(width):
        for k in range(j, width):
            centred[j][k] = centred[k][j] = n * cross[j][k] - sums[j] * sums[k]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])  # each quotient rounded once
    total = sum(centred[j][j] for j in range(width)) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = [c for c in np.argsort(values)[::-1][:most] if values[c] > FLAT * values[-1]]
    vectors = vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, range(len(order))] < 0, -1.0, 1.0)
    return Fit(n, sums, values[order], values[order] / total if total else values[order], vectors)


def fit(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> dict[int, Fit]:
    """The components of all vectors, by width."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        totals = _Totals()
        for batch in batches:
            for _, x in by_width(batch.column(0)):
                totals.add(x)
        totals.flush()
        rows, number = list(totals.rows()), pa.decimal128(38, 0)
        names = ["width", "j", "k"]
        arrays = [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)]
        arrays += [
            pa.array([Decimal(int(part(r[3]))) for r in rows], number) for part in (lambda v: v // LIMB, lambda v: v % LIMB)
        ]
        yield pa.record_batch(arrays, names=[*names, "high", "low"])

    parts = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(sums, PARTIAL)
    found = parts.groupBy("width", "j", "k").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    whole = {(r.width, r.j, r.k): int(r.high) * LIMB + int(r.low) for r in found.collect()}
    fits = {}
    for width in sorted({w for w, _, _ in whole}):
        cross = [[whole[width, j, k] if k >= j else 0 for k in range(width)] for j in range(width)]
        fits[width] = components(whole[width, -1, -1], [whole[width, -1, j] for j in range(width)], cross, most)
    return fits


def _centre(x: np.ndarray, model: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x - S/n in doubles, and whole numbers y and r with n x - S = n y - r."""
    base = np.array([s // model.n for s in model.sums], dtype=object)
    rest = np.array([s % model.n for s in model.sums], dtype=object)
    y = x.astype(object) - base if np.abs(x).max(initial=0) >= 1 << 62 else x - base.astype(np.int64)
    return y.astype(np.float64) - np.array([r / model.n for r in rest]), y, rest


def deviations(y: np.ndarray, rest: np.ndarray, n: int) -> list[int]:
    """Sum over dimensions of (n y - r)^2 for each row, exact."""
    width, most = y.shape[1], int(np.abs(y).max(initial=1)) + 1
    small = most * most * width < LONG and most * n * width < LONG
    y, r = (y.astype(np.int64), rest.astype(np.int64)) if small else (y.astype(object), rest)
    squares, products = (y * y).sum(axis=1), (y * r).sum(axis=1)
    constant = sum(int(v) * int(v) for v in rest)
    return [n * n * int(s) - 2 * n * int(p) + constant for s, p in zip(squares, products)]


def _identity_error(vectors: DataFrame, fits: dict[int, Fit], column: str) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, measured on all rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_width(batch.column(0)):
                w = _centre(x, fits[x.shape[1]])[0] @ fits[x.shape[1]].whiten
                w = np.column_stack([np.ones(len(w)), w])
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + w.T @ w
        rows = [(w, a, b, float(m[a, b])) for w, m in total.items() for a in range(len(m)) for b in range(a, len(m))]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.record_batch(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["width", "a", "b", "total"]
        )

    parts = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(
        moments, "width int, a int, b int, total double"
    )
    sums = {(r.width, r.a, r.b): r.total for r in parts.groupBy("width", "a", "b").agg(F.sum("total").alias("total")).collect()}
    errors = [
        abs(t / sums[w, 0, 0] - sums[w, 0, a] * sums[w, 0, b] / sums[w, 0, 0] ** 2 - (a == b))
        for (w, a, b), t in sums.items()
        if a > 0
    ]
    return max(errors, default=None)


def whiten(vectors: DataFrame, fits: dict[int, Fit], column: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """Each vector's coordinates on the components, of mean 0 and covariance 1 over the fit list."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in by_width(batch.column(1)):
                model = fits[x.shape[1]]
                count = len(model.variances)
                if not count:
                    continue
                centred, y, rest = _centre(x, model)
                exact = deviations(y, rest, model.n)
                ids = batch.column(0).take(pa.array(places))
                each = pa.array(np.repeat(np.arange(len(x)), count))
                rows = len(x) * count
                yield pa.record_batch(
                    [
                        ids.take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(rows, model.n, dtype=np.int64)),
                        pa.array([d if d < LONG else None for d in exact], pa.int64()).take(each),
                        pa.array([str(d) for d in exact], pa.string()).take(each),
                        pa.array((centred @ model.whiten).ravel()),
                        pa.array(np.tile(model.explained, len(x))),
                    ],
                    names=[c.split()[0] for c in OUTPUT.split(", ")],
                )

    return vectors.select(
        F.col(row_id).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("v")
    ).mapInArrow(project, OUTPUT)


def report(embeddings: DataFrame) -> DataFrame:
    """Fit on all vectors, whiten all, and say how far the result is from white."""
    ready(embeddings.sparkSession)
    fits = fit(embeddings)
    error = _identity_error(embeddings, fits, "embedding")
    return whiten(embeddings, fits).withColumn("identity_error", F.lit(error).cast("double"))
