"""Rows as bytes, on their way into and out of state.

Spark hands rows to a stateful function one column at a time, and takes all that the timers of a partition make as one list. Packed rows make both small.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import batched, chain

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS_PER_PACK, PACKS_PER_BATCH = 256, 16
# Rows, and their bytes, that a task holds on the way into state before it packs them.
ROWS_PACKED, BYTES_PACKED = 50_000, 32 << 20
Packed = Row("rows")


def cells(column: pa.Array) -> list:
    """The values of a column, as ``to_pylist`` gives them. Numbers and UTC instants are converted at once, not one by one."""
    kind = column.type
    if not column.null_count and (pa.types.is_integer(kind) or pa.types.is_floating(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_timestamp(kind) and kind.tz == "UTC" and kind.unit == "us":
        zone = pa.lib.string_to_tzinfo(kind.tz)
        naive = column.cast(pa.timestamp("us")).to_numpy(zero_copy_only=False).astype(object)
        return [v if v is None else v.replace(tzinfo=zone) for v in naive]
    return column.to_pylist()


def blob(value) -> bytes:
    return zlib.compress(pickle.dumps(value), 1)


def unpack(packed_value: bytes):
    return pickle.loads(zlib.decompress(packed_value))


def packed(df: DataFrame, group: str, place: str, names: Sequence[str], groups: int) -> DataFrame:
    """Many rows as one: ``group`` (0 to ``groups`` - 1), the newest ``place`` of the rows (as instant ``_time``), and ``row``, a packed list
    of tuples of the columns ``names``.

    A task also sends each group one row without rows, so that all groups learn of what goes on.
    """
    at = list(names).index(place)
    schema = pa.schema([(group, pa.int32()), ("_time", pa.timestamp("us", "UTC")), ("row", pa.binary())])

    def flushed(held: dict[int, list[tuple]]) -> pa.RecordBatch:
        newest = [max(row[at] for row in rows) for rows in held.values()]
        blobs = [blob(rows) for rows in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(newest, pa.int64()).cast(schema.field("_time").type), pa.array(blobs, pa.binary())],
            schema=schema,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, newest = {}, 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [cells(batch.column(i + 1)) for i in range(len(names))]
            for shard, row in zip(cells(batch.column(0)), zip(*columns)):
                if shard in held:
                    held[shard].append(row)
                else:
                    held[shard] = [row]
            last = max(columns[at])
            newest = last if newest is None else max(newest, last)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= ROWS_PACKED or size >= BYTES_PACKED:
                yield flushed(held)
                held, rows, size = {}, 0, 0
        if held:
            yield flushed(held)
        if newest is not None:
            told = [pa.array(range(groups), pa.int32()), pa.array([newest] * groups, pa.int64()).cast(schema.field("_time").type)]
            yield pa.RecordBatch.from_arrays([*told, pa.nulls(groups, pa.binary())], schema=schema)

    return df.select(F.col(group).cast("int"), *[F.col(f"`{c}`") for c in names]).mapInArrow(
        work, f"{group} int, _time timestamp, row binary"
    )


def packed_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Many rows as one: ``keys``, and ``row``, a packed list of tuples of all columns."""
    names = df.columns
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("row", T.BinaryType())])
    arrow, at = to_arrow_schema(schema), [names.index(k) for k in keys]

    def flushed(held: dict[tuple, list[tuple]]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held), arrow)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([blob(rows) for rows in held.values()], pa.binary())], schema=arrow)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = {}, 0, 0
        for batch in batches:
            for row in zip(*[cells(c) for c in batch.columns]):
                held.setdefault(tuple(row[i] for i in at), []).append(row)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= ROWS_PACKED or size >= BYTES_PACKED:
                yield flushed(held)
                held, rows, size = {}, 0, 0
        if held:
            yield flushed(held)

    return df.mapInArrow(work, schema)


def pack(rows: Iterable[tuple]) -> Iterator[Row]:
    """Tuples as rows of one binary column ``rows``."""
    for some in batched(rows, ROWS_PER_PACK):
        yield Packed(blob(some))


def unpacked(df: DataFrame, schema: str) -> DataFrame:
    """The rows that ``pack`` has packed."""
    kinds = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batched(batch.column(0), PACKS_PER_BATCH):
                columns = zip(*chain.from_iterable(unpack(one.as_py()) for one in some))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(work, kinds)
