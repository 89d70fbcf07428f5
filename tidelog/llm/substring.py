"""Repeated passages, removed by a relative Lempel-Ziv parse of documents against indexed reference blocks.

**Reference blocks.** The index of the corpus is cut into blocks by anchor: the anchor of a window of
``window`` words is the smallest hash of its runs of ``k`` words, so equal windows, wherever they stand, meet in
one block. A block knows, for each window, the smallest document that has it. Neighbouring windows with
one anchor travel together; of windows that repeat within a batch only the smallest document's is
sent, which bounds what a passage shared by many documents brings to its block. A short phrase that stands between
different words gives many different windows with one anchor. Anchors that a sample of the documents finds in more
than a quarter of a block's share of windows are cut into parts by the hash of the whole window, each part in a block
of its own; equal windows still meet, so results do not depend on the sample.

**Factors.** In each block the windows of a document are matched with the reference. Consecutive windows that are
found in one reference document make up a factor, at least ``window`` words long. A greedy parse would miss a
window across the border of two factors, so each of these is looked up like any other; every
window of the text belongs to exactly one block. A document's factors from all blocks are then united into the
spans to remove.

Windows are compared by the 64 bits of their anchor and 48 more over all their words.

Defined cases: null and empty texts have no words and keep none. Only a smaller ``doc_id`` counts as reference, so
repeats inside a document, or between rows that share an id, stay. A null ``doc_id`` is larger than any other.
Rows that repeat an id keep spans of their own (they are told apart by the hash of the text). Extra columns
are carried along by ``remove_repeats``. Long texts are hashed in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import WHITE, buffers, hash_grams, hash_words, mix, sliding_min, written

GRAM, EXACT = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
TEXT_HASH = "__text_hash"
LAST = np.iinfo(np.int64).max
FLUSH_WORDS = 1_000_000
NARROW = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("text", "<i4"), ("at", "<i4")])
EXACT_BYTES = 6
SAMPLED, MOST_HOT = 20_000, 1_000_000


def _firsts(anchor: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window the smallest document that has it."""
    order = np.lexsort((doc, whole, anchor))
    a, w = anchor[order], whole[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
    first = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.empty_like(doc)
    out[order] = first
    return out


def _factors(doc: np.ndarray, text: np.ndarray, at: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join consecutive windows of a document found in one reference: (doc, text, start, windows, ref)."""
    order = np.lexsort((at, text, doc))
    doc, text, at, ref = doc[order], text[order], at[order], ref[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1) | (ref[1:] != ref[:-1])
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(at)))
    return doc[starts], text[starts], at[starts], count, ref[starts]


def _bytes(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _blocks(anchor: np.ndarray, whole: np.ndarray, blocks: int, hot: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The block of each window; those of hot anchors (sorted) are dealt over the anchor's parts."""
    key = anchor
    if len(hot):
        at = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
        part = np.where(hot[at] == anchor, mix(whole) % parts[at], np.uint64(0))
        key = np.where(part > 0, mix(anchor + part * np.uint64(EXACT)), anchor)
    return (key % np.uint64(blocks)).astype(np.int64)


def _hot_anchors(docs: DataFrame, rows: int, window: int, k: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors above a quarter of a block's share of the windows, sorted, and into how many parts each is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, cuts = hash_words(*buffers(batch.column(0)), WHITE)
            anchor = sliding_min(hash_grams(words, k, GRAM), window - k + 1)
            row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[: len(anchor)]
            inside = np.arange(len(anchor)) + window <= cuts[1:][row]
            found, counts = np.unique(anchor[inside], return_counts=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(counts)], names=["anchor", "n"])

    every = max(1, rows // SAMPLED)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")
    counted = written(
        sample.mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")), "anchors"
    )
    share = (counted.agg(F.sum("n")).first()[0] or 0) / blocks / 4
    large = counted.where(F.col("n") > share).orderBy(F.desc("n"), "anchor").limit(MOST_HOT).collect()
    hot = np.array([r[0] for r in large], dtype=np.int64).view(np.uint64)
    parts = np.array([-(-r[1] // max(share, 1)) for r in large]).astype(np.uint64)
    order = np.argsort(hot)
    return hot[order], parts[order]


def _index(window: int, k: int, blocks: int, hot: np.ndarray, parts: np.ndarray):
    """Windows of the batch's documents by block, and factors that the batch itself shows."""

    def pack(ids, texts, words, rows) -> pa.RecordBatch:
        lengths = np.diff(rows)
        grams = hash_grams(words, k, GRAM)
        anchor = sliding_min(grams, window - k + 1)
        whole = hash_grams(words, window, EXACT)
        row = np.repeat(np.arange(len(lengths)), lengths)[: len(whole)]
        at = np.arange(len(whole))
        inside = at + window <= rows[1:][row]
        at, row = at[inside], row[inside]
        anchor, whole = anchor[inside], whole[inside]
        place = (at - rows[:-1][row]).astype(np.int32)
        doc, text = ids[row], texts[row]
        first = _firsts(anchor, whole, doc)
        known = doc > first
        # Known repeats go along as factors; the rest is sorted by block and anchor.
        block = _blocks(anchor, whole & np.uint64((1 << 8 * EXACT_BYTES) - 1), blocks, hot, parts)
        out: dict[str, list] = {"block": [], "head": [], "counts": [], "whole": [], "known": []}
        free = np.flatnonzero(~known)
        order = free[np.lexsort((place[free], row[free], block[free]))]
        run = np.ones(len(order), dtype=bool)
        run[1:] = (
            (anchor[order][1:] != anchor[order][:-1]) | (row[order][1:] != row[order][:-1])
            | (place[order][1:] != place[order][:-1] + 1)
        )
        heads = np.flatnonzero(run)
        # Repetitive text makes long runs; their lengths are sent as single bytes.
        within = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
        heads = np.flatnonzero(within % 255 == 0)
        counts = np.diff(np.append(heads, len(order)))
        head = np.empty(len(heads), dtype=NARROW)
        for name, column in (("anchor", anchor), ("doc", doc), ("text", text), ("at", place)):
            head[name] = column[order[heads]]
        in_block = block[order]
        used = np.unique(in_block)
        first_of = np.searchsorted(in_block[heads], np.append(used, blocks))
        windows_of = np.searchsorted(in_block, np.append(used, blocks))
        repeats = np.flatnonzero(known)
        factors = _factors(doc[repeats], text[repeats], place[repeats], first[repeats])
        carrier = len(repeats) % max(1, len(used))  # any block will do
        for i, b in enumerate(used.tolist()):
            lo, hi = first_of[i], first_of[i + 1]
            out["block"].append(b)
            out["head"].append(b"".join(_bytes(head[name][lo:hi]) for name in NARROW.names))
            out["counts"].append(_bytes(counts[lo:hi].astype(np.uint8)))
            exact = whole[order[windows_of[i] : windows_of[i + 1]]]
            out["whole"].append(_bytes(exact.view(np.uint8).reshape(-1, 8)[:, :EXACT_BYTES]))
            out["known"].append(b"".join(_bytes(f.astype(np.int64)) for f in factors) if i == carrier else b"")
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            data, cuts = buffers(batch.column(2))
            words, rows = hash_words(data, cuts, WHITE)
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_numpy(zero_copy_only=False)
            waiting.append((ids, texts, words, rows))
            size += len(words)
            if size >= FLUSH_WORDS:
                yield pack(*_joined(waiting))
                waiting, size = [], 0
        if waiting:
            yield pack(*_joined(waiting))

    return run


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    ids, texts, words = (np.concatenate([p[i] for p in parts]) for i in range(3))
    offsets = np.cumsum([0, *(len(p[2]) for p in parts)])
    rows = np.concatenate([p[3][:-1] + o for p, o in zip(parts, offsets)] + [[offsets[-1]]])
    return ids, texts, words, rows.astype(np.int64)


def _match(window: int):
    """All windows of a block against each other: factors of documents that are not the first."""

    def matched(heads, counts, wholes, known) -> pa.RecordBatch:
        columns, before = [], 0
        for name in NARROW.names:
            kind = NARROW[name]
            sizes = [len(h) // NARROW.itemsize for h in heads]
            columns.append(np.concatenate([np.frombuffer(h, kind, n, before * n) for h, n in zip(heads, sizes)]))
            before += kind.itemsize
        anchor, doc, text, at = columns
        times = np.concatenate([np.frombuffer(c, np.uint8) for c in counts]).astype(np.int64)
        sent = np.frombuffer(b"".join(wholes), np.uint8).reshape(-1, EXACT_BYTES)
        whole = np.zeros((len(sent), 8), dtype=np.uint8)
        whole[:, :EXACT_BYTES] = sent
        whole = whole.view("<u8")[:, 0]
        step = np.arange(len(whole)) - np.repeat(np.cumsum(times) - times, times)
        anchor, doc, text = (np.repeat(c, times) for c in (anchor, doc, text))
        at = np.repeat(at, times) + step.astype(np.int32)
        first = _firsts(anchor, whole, doc)
        late = np.flatnonzero(doc > first)
        factors = _factors(doc[late], text[late], at[late], first[late])
        earlier = [np.frombuffer(f, np.int64).reshape(5, -1) for f in known if f]
        merged = [np.concatenate([f.astype(np.int64), *(e[i] for e in earlier)]) for i, f in enumerate(factors)]
        merged[3] = merged[3] + window - 1  # from windows to words
        names = ["doc", "text", "start", "length", "reference"]
        return pa.record_batch([pa.array(m) for m in merged], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, ([], [], [], [])
        for batch in batches:
            for b, *values in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if b != block and parts[0]:
                    yield matched(*parts)
                    parts = ([], [], [], [])
                block = b
                for part, value in zip(parts, values):
                    part.append(value)
        if parts[0]:
            yield matched(*parts)

    return run


def indexed(docs: DataFrame, *, window: int = 13, k: int = 6, docs_per_block: int = 2_000) -> DataFrame:
    """(block, head, counts, whole, known): windows of the documents, packed by block."""
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.hash("text").alias("t"), "text")
    rows = docs.count()
    blocks = max(16, -(-rows // docs_per_block))
    hot, parts = _hot_anchors(keyed, rows, window, k, blocks)
    return keyed.mapInArrow(
        _index(window, k, blocks, hot, parts), "block bigint, head binary, counts binary, whole binary, known binary"
    )


def find_factors(docs: DataFrame, *, window: int = 13, k: int = 6, docs_per_block: int = 2_000) -> DataFrame:
    """(doc, text, start, length, reference): factors of at least ``window`` words, in words.

    ``doc`` is the id (the largest bigint for null), ``text`` the hash that tells rows with one id apart.
    A block has about ``docs_per_block`` documents' share of the windows, however large the corpus is; larger
    blocks need more memory and fewer messages.
    """
    packed = indexed(docs, window=window, k=k, docs_per_block=docs_per_block)
    return packed.repartition("block").sortWithinPartitions("block").mapInArrow(
        _match(window), "doc bigint, text bigint, start bigint, length bigint, reference bigint"
    )


def _with_spans(docs: DataFrame, window: int, k: int) -> DataFrame:
    """The documents with the factors found in them (``__spans``, null if none)."""
    factors = find_factors(docs, window=window, k=k)
    # A document has fewer factors than words.
    spans = factors.groupBy("doc", "text").agg(
        F.collect_list(F.struct(F.col("start").cast("int"), F.col("length").cast("int"), "reference")).alias("__spans")
    ).select(F.col("doc").alias("__doc"), F.col("text").alias("__text"), "__spans")
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)))
    keyed = keyed.withColumn(TEXT_HASH, F.hash("text").cast("bigint"))
    joined = keyed.join(spans, (keyed["__id"] == spans["__doc"]) & (keyed[TEXT_HASH] == spans["__text"]), "left")
    return joined.drop("__id", TEXT_HASH, "__doc", "__text")


def keep_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The words outside the spans joined by one space, the number of words and of removed ones."""
    words = text.split()
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length in spans:
        gone[start] += 1
        gone[min(start + length, len(words))] -= 1
    covered = np.cumsum(gone)[:-1] > 0
    if not covered.any():
        return b" ".join(words), len(words), 0
    kept = [words[i] for i in np.flatnonzero(~covered).tolist()]
    return b" ".join(kept), len(words), int(covered.sum())


def _rewrite(text_at: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist()
            column = batch.column(batch.num_columns - 1)
            starts = pc.list_flatten(column)
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))]).astype(int)
            fields = [starts.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            done = [
                keep_words(t or b"", list(zip(*(f[lo:hi].tolist() for f in fields))))
                for t, lo, hi in zip(texts, at, at[1:])
            ]
            kept = [hashlib.sha256(d[0]).hexdigest() if digest else d[0].decode() for d in done]
            if digest:
                columns = [batch.column(0)]
            else:
                columns = list(batch.columns[:-1])
            yield pa.record_batch(
                [*columns, pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()), pa.array(kept, pa.string())],
                names=[*batch.schema.names[: len(columns)], "__n", "__gone", "__kept"],
            )

    return run


def _added(schema: T.StructType) -> T.StructType:
    counts = [T.StructField(n, T.LongType()) for n in ("__n", "__gone")]
    return T.StructType([*schema.fields, *counts, T.StructField("__kept", T.StringType())])


def remove_repeats(docs: DataFrame, *, window: int = 13, k: int = 6) -> DataFrame:
    """The documents with repeated passages removed from ``text`` (words joined by one space)."""
    spans = _with_spans(docs, window, k).select(*[docs[c] for c in docs.columns], "__spans")
    out = spans.mapInArrow(_rewrite(docs.columns.index("text"), False), _added(docs.schema))
    kept = [F.col("__kept").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept)


def report(docs: DataFrame, *, window: int = 13, k: int = 6) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``."""
    narrow = docs.select("doc_id", "text")
    spans = _with_spans(narrow, window, k).select("doc_id", "text", "__spans")
    out = spans.mapInArrow(_rewrite(1, True), _added(T.StructType([narrow.schema["doc_id"]])))
    return out.select(
        "doc_id", F.col("__n").alias("n_words"), F.col("__gone").alias("n_removed"), F.col("__kept").alias("kept_sha256")
    )
