"""Exact deduplication with two passes over a Bloom filter.

The first pass fills a filter of two bit planes from the hashes of all texts: cells hit at least
once and cells hit at least twice. A text that occurs twice hits each of its cells twice, so the
second plane never misses a repeated text. The second pass tests every row against that plane
inside the scan's own tasks. Rows that fail are unique and pass straight through; only the rest
are shuffled, grouped by their full digest, and decided.

The filter is cut into pages of 32,768 bits. Tasks send the cells they hit page by page, merged
pages are broadcast. Its size follows the number of rows up to ``max_filter_bytes``, which is the
bound of the broadcast. Beyond it more unique rows are shuffled; results stay the same.

Defined cases: a null text is empty, and empty texts are equal. A null ``doc_id`` loses against
any other. Of rows that repeat ``doc_id`` and text one stays. An empty table gives an empty one.
Other columns are carried along untouched. Groups are only ever aggregated (count, best row), so
their size does not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WHITE_SPACE, one_per_group, text_of, written

PAGE_BITS = 1 << 15
CELLS = 4
KEY, POINTS, BEST, REPEATED = "__key", "__points", "__best", "__repeated"


def normalised(text: str = "text") -> Column:
    """The text without its white space."""
    return F.translate(text_of(text), WHITE_SPACE, "")


def _page(key: Column, pages: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(pages))


def _cells(key: Column) -> Column:
    """60 bits that name four positions inside the page."""
    return F.xxhash64(F.lit(1), key)


def _planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the cells hit once and twice, by page, as compressed bit planes."""
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    shifts = np.arange(CELLS, dtype=np.uint64) * np.uint64(15)
    for batch in batches:
        page, bits = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cells = (bits.view(np.uint64)[:, None] >> shifts) & np.uint64(PAGE_BITS - 1)
        order = np.argsort(page, kind="stable")
        page, cells = page[order], np.sort(cells[order].astype(np.int64), axis=1)
        for rows in np.split(np.arange(len(page)), np.flatnonzero(np.diff(page)) + 1):
            if not len(rows):
                continue
            once, twice = seen.setdefault(
                int(page[rows[0]]), (np.zeros(PAGE_BITS, bool), np.zeros(PAGE_BITS, bool))
            )
            # A row that hits one cell with two of its positions counts once.
            mine = cells[rows]
            fresh = np.ones(mine.shape, bool)
            fresh[:, 1:] = mine[:, 1:] != mine[:, :-1]
            hit, count = np.unique(mine[fresh], return_counts=True)
            twice[hit] |= once[hit] | (count > 1)
            once[hit] = True
        if len(seen) > 512:  # at most 32 MB of planes in a task
            yield _packed(seen)
            seen = {}
    if seen:
        yield _packed(seen)


def _packed(seen: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    pages = sorted(seen)
    planes = [[zlib.compress(np.packbits(seen[p][i], bitorder="little").tobytes(), 1) for p in pages] for i in (0, 1)]
    return pa.record_batch(
        [pa.array(pages, pa.int64()), pa.array(planes[0], pa.binary()), pa.array(planes[1], pa.binary())],
        names=["page", "once", "twice"],
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the planes of each page; rows arrive sorted by page, so one page is in memory."""
    words = PAGE_BITS // 64
    page, once, twice = None, None, None

    def done():
        return pa.record_batch(
            [pa.array([page], pa.int64()), pa.array([twice.view(np.int64).tolist()], pa.list_(pa.int64()))],
            names=["page", "bits"],
        )

    for batch in batches:
        for p, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if p != page:
                if page is not None:
                    yield done()
                page, once, twice = p, np.zeros(words, np.uint64), np.zeros(words, np.uint64)
            a, b = (np.frombuffer(zlib.decompress(x), np.uint64) for x in (a, b))
            twice = twice | b | (once & a)
            once = once | a
    if page is not None:
        yield done()


def repeated_filter(
    keys: DataFrame, key: str, rows: int, bits_per_row: int = 16, max_filter_bytes: int = 64 << 20
) -> tuple[DataFrame, int]:
    """First pass: the pages of the plane of cells hit twice, and how many pages there are."""
    pages = max(1, min(-(-rows * bits_per_row // PAGE_BITS), max_filter_bytes * 8 // PAGE_BITS))
    cells = keys.select(_page(F.col(key), pages).alias("page"), _cells(F.col(key)).alias("cells"))
    planes = cells.mapInArrow(_planes, "page bigint, once binary, twice binary")
    merged = planes.repartition("page").sortWithinPartitions("page")
    return written(merged.mapInArrow(_merge, "page bigint, bits array<bigint>"), "filter"), pages


def flag_repeated(df: DataFrame, key: str, bloom: DataFrame, pages: int, flag: str) -> DataFrame:
    """Second pass: add a flag that is true for every row whose key occurs more than once.

    The pages are broadcast (their total size is bounded) and tested with built-in functions.
    """
    side = bloom.select(F.col("page").alias("__page"), F.col("bits").alias("__bits"))
    tested = df.withColumn("__cells", _cells(F.col(key))).withColumn("__page", _page(F.col(key), pages))
    joined = tested.join(F.broadcast(side), "__page", "left")
    hit = F.lit(True)
    for i in range(CELLS):
        cell = F.shiftrightunsigned("__cells", 15 * i).bitwiseAND(F.lit(PAGE_BITS - 1)).cast("int")
        word = F.col("__bits")[F.shiftright(cell, 6)]
        hit = hit & (F.getbit(word, cell.bitwiseAND(F.lit(63))) == 1)
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__page", "__bits", "__cells")


def _groups(repeated: DataFrame) -> DataFrame:
    """Size and best row of each group of possibly repeated rows: most code points, smallest id."""
    best = F.min(F.struct((-F.col(POINTS)).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    return written(repeated.groupBy(KEY).agg(best.alias(BEST), F.count("*").alias("__size")), "groups")


def _is_best() -> Column:
    return (F.col(f"{BEST}.less") == -F.col(POINTS)) & F.col(f"{BEST}.doc_id").eqNullSafe(F.col("doc_id"))


def mark_copies(docs: DataFrame, **filter_options: int) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    keyed = written(
        docs.select("doc_id", F.sha2(normalised(), 256).alias(KEY), F.length(text_of("text")).alias(POINTS)), "digests"
    )
    bloom, pages = repeated_filter(keyed, KEY, keyed.count(), **filter_options)
    flagged = flag_repeated(keyed, KEY, bloom, pages, REPEATED)
    alone, repeated = flagged.where(~F.col(REPEATED)), flagged.where(REPEATED)
    straight = alone.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col(KEY).alias("text_sha256"),
    )
    joined = repeated.join(_groups(repeated), KEY)
    columns = [
        "doc_id", F.col(f"{BEST}.doc_id").alias("keep_id"), F.col("__size").alias("group_size"),
    ]
    best = joined.where(_is_best())
    # Rows that repeat a best row's id and text: one of them stays.
    extra = best.groupBy(KEY, "doc_id", BEST, "__size").count()
    decided = extra.select(
        *columns, F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("n"), F.col(KEY)
    ).select("doc_id", "keep_id", "group_size", (F.col("n") == 1).alias("kept"), F.col(KEY).alias("text_sha256"))
    dropped = joined.where(~_is_best()).select(*columns, F.lit(False).alias("kept"), F.col(KEY).alias("text_sha256"))
    return straight.unionByName(decided).unionByName(dropped)


def drop_copies(docs: DataFrame, **filter_options: int) -> DataFrame:
    """The documents without exact copies, in all their columns. Unique rows are not shuffled."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(KEY, F.sha2(normalised(), 256)).withColumn(POINTS, F.length(text_of("text")))
    narrow = written(keyed.select("doc_id", KEY, POINTS), "digests")
    bloom, pages = repeated_filter(narrow, KEY, narrow.count(), **filter_options)
    groups = _groups(flag_repeated(narrow, KEY, bloom, pages, REPEATED).where(REPEATED))
    flagged = flag_repeated(keyed, KEY, bloom, pages, REPEATED)
    kept = flagged.where(REPEATED).join(groups, KEY).where(_is_best())
    single = one_per_group(kept.select(*columns, KEY), KEY)
    return flagged.where(~F.col(REPEATED)).select(*columns).unionByName(single.select(*columns))
