"""Count-min sketch held as a table of cells ``(depth, bucket, cnt)``.

A sketch has at most ``depth * width`` cells, independent of the data, which is what makes
broadcasting it safe. Sketches merge by adding cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# At most so many cells (8 bytes each) are broadcast.
BROADCAST_CELLS = 4_000_000


@dataclass(frozen=True)
class SketchShape:
    """Estimates exceed the truth by at most ``eps * total`` with probability ``1 - delta``."""

    # The default accuracy, seed and heavy-hitter share.
    delta: float = 1e-10
    eps: float = 0.001
    seed: int = 1
    heavy: float = 0.01

    @property
    def depth(self) -> int:
        return math.ceil(math.log(1 / self.delta))

    @property
    def width(self) -> int:
        return math.ceil(math.e / self.eps)

    def hashes(self, item: Column) -> list[Column]:
        """Three independent numbers of 32 bits that all cells of an item follow from."""
        first, second = (F.xxhash64(item, F.lit(self.seed * 1000 + i)) for i in (0, 1))
        low = F.lit((1 << 32) - 1)
        return [first.bitwiseAND(low), F.shiftrightunsigned(first, 32), second.bitwiseAND(low)]

    def bucket(self, depth, a, b, c):
        """The bucket of an item in a row of the sketch, of columns or arrays. Two items that share a bucket in every row agree in
        three numbers modulo the width, which is less likely than ``delta``."""
        return (a + depth * b + depth * depth * c) % self.width

    def cells(self, item: Column) -> Column:
        """The cell of the item in every row of the sketch."""
        a, b, c = self.hashes(item)
        return F.array(
            *[F.struct(F.lit(d).alias("depth"), self.bucket(F.lit(d), a, b, c).cast("int").alias("bucket")) for d in range(self.depth)]
        )


def cms_build(df: DataFrame, item: str, shape: SketchShape = SketchShape()) -> DataFrame:
    """Sketch of a frame, batch or stream. Each task adds up its rows in one array of ``depth * width`` cells, and only
    cells are shuffled. A shape too large for that is summed row by row."""
    rows = df.filter(F.col(item).isNotNull())
    name = F.col(item).cast("string")
    if shape.depth * shape.width > BROADCAST_CELLS:
        hit = rows.select(F.explode(shape.cells(name)).alias("c")).select("c.depth", "c.bucket", F.lit(1).alias("cnt"))
    else:
        hashes = [h.alias(n) for h, n in zip(shape.hashes(name), "abc")]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grid = np.zeros((shape.depth, shape.width), dtype=np.int64)
            for batch in batches:
                numbers = [column.to_numpy() for column in batch.columns]
                for d in range(shape.depth):
                    grid[d] += np.bincount(shape.bucket(d, *numbers), minlength=shape.width)
            depth, bucket = np.nonzero(grid)
            arrays = [pa.array(depth, pa.int32()), pa.array(bucket, pa.int32()), pa.array(grid[depth, bucket])]
            yield pa.record_batch(arrays, names=["depth", "bucket", "cnt"])

        hit = rows.select(*hashes).mapInArrow(add, "depth int, bucket int, cnt bigint")
    return hit.groupBy("depth", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def cms_merge(*sketches: DataFrame) -> DataFrame:
    merged = sketches[0]
    for sketch in sketches[1:]:
        merged = merged.unionByName(sketch)
    return merged.groupBy("depth", "bucket").agg(F.sum("cnt").alias("cnt"))


def cms_count(
    sketch: DataFrame, items: DataFrame, item: str, shape: SketchShape = SketchShape()
) -> DataFrame:
    """Estimated count of each distinct item: the least of its cells.

    The sketch is handed to every task as one array of its cells, as long as it is small (it is then computed at once); a
    larger one is joined cell by cell.
    """
    wanted = items.select(item).filter(F.col(item).isNotNull()).distinct()
    cells = shape.cells(F.col(item).cast("string"))
    if shape.depth * shape.width > BROADCAST_CELLS:
        asked = wanted.select(item, F.explode(cells).alias("c")).select(item, "c.depth", "c.bucket")
        return (
            asked.join(sketch, ["depth", "bucket"], "left").groupBy(item)
            .agg(F.min(F.coalesce("cnt", F.lit(0))).cast("bigint").alias("estimate"))
        )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros(shape.depth * shape.width, dtype=np.int64)
        for batch in batches:
            depth, bucket, cnt = (column.to_numpy() for column in batch.columns)
            grid[depth * np.int64(shape.width) + bucket] = cnt
        yield pa.record_batch([pa.array([grid], pa.list_(pa.int64()))], names=["_counts"])

    cells_only = sketch.select("depth", "bucket", F.col("cnt").cast("bigint")).repartition(1)
    # At most BROADCAST_CELLS numbers, whatever the data's size.
    dense = np.array(cells_only.mapInArrow(fill, "_counts array<bigint>").first()[0], dtype=np.int64)
    grid = sketch.sparkSession.sparkContext.broadcast(dense.reshape(shape.depth, shape.width))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [column.to_numpy() for column in batch.columns[1:]]
            counts = [grid.value[d][shape.bucket(d, *numbers)] for d in range(shape.depth)]
            yield pa.record_batch([batch.column(0), pa.array(np.min(counts, axis=0), pa.int64())], names=[item, "estimate"])

    hashes = [h.alias(f"_{n}") for h, n in zip(shape.hashes(F.col(item).cast("string")), "abc")]
    kind = wanted.schema[item].dataType.simpleString()
    return wanted.select(item, *hashes).mapInArrow(look, f"`{item}` {kind}, estimate bigint")


def cms_heavy_hitters(
    sketch: DataFrame, items: DataFrame, item: str, shape: SketchShape = SketchShape()
) -> DataFrame:
    """Items whose estimate reaches the heavy-hitter share of all rows."""
    total = sketch.filter("depth = 0").agg(F.sum("cnt")).scalar()
    return cms_count(sketch, items, item, shape).filter(
        F.col("estimate") >= total * F.lit(shape.heavy)
    )
