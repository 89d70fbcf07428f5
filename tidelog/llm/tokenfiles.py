"""Token ids in files of shuffled bit planes.

**File.** Ids are cut into blocks of ``BLOCK`` numbers. A block is transposed into planes (plane b holds bit, or byte, b of every number),
and each plane is compressed with zstandard on its own; planes above the largest number's are not stored. Document ids and lengths
are two further streams of blocks, so a file says which ids belong to which document. An index at the end gives every
block's place, size, check sum and plane lengths: a reader can fetch any range of ids without reading what lies before it.

    header   magic, kind of planes (1 bits, 8 bytes), block size
    blocks   planes one after another, in the order they were written
    index    one entry a block, compressed
    footer   place, length and entries of the index, magic

**Writing.** Documents are dealt by ranges of their id, as many as the text needs, and sorted inside. A task encodes its documents
and writes files of its own under temporary names, so a repeated task replaces them; ``start`` follows from the sizes of the files before.

**Encoding.** A byte-level tokenizer cuts a text before a single space between characters that are not white space, whatever
surrounds it, so the pieces between such spaces are encoded by the library once a worker and remembered (``MEMORY`` pieces at
most). A batch is cut at its spaces, and each of its distinct words is looked up once; only texts with other white space beside a space are
cut one by one. Plain words of new pieces go straight to the merges. Other kinds of tokenizers get whole texts.

Defined cases: a null text is empty and has the end id alone. Null ids come last. Rows that share an id are ordered by their text. An
empty table gives no files. Strings that look like special tokens are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import ready, text_of, written
from tidelog.sources.scratch import scratch_dir

# Fixed values of the format.
MAGIC = b"TIDEIDS1"
HEADER, FOOTER = struct.Struct("<8sII"), struct.Struct("<QQQ8s")
IDS, DOCS, LENGTHS = 0, 1, 2
TYPES = {IDS: np.dtype("<u4"), DOCS: np.dtype("<u8"), LENGTHS: np.dtype("<u8")}
# Fixed value of the contract: the id that ends a document.
END_ID = 0

BLOCK = 1 << 16
FILE_IDS = 1 << 28
RANGE_BYTES = 64 << 20
MEMORY = 1 << 20
SOLID = r"[^\s\u180e\u200b\ufeff]"
PIECE_BORDER = re.compile(f"(?<={SOLID}) (?={SOLID})")
# What lies between two spaces, if both are borders of pieces.
EVEN = re.compile(f"{SOLID}(?:.*{SOLID})?", re.DOTALL)
# A line of parts that a byte-level tokenizer never joins: letters or digits, then punctuation.
PLAIN_LINE = re.compile("([0-9]+|[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")
# Byte-level vocabularies write printable bytes as themselves and number the others from 256.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
SPACE, LINE_END = chr(BYTE_NAMES[32]), chr(BYTE_NAMES[10])


def to_planes(numbers: np.ndarray, unit: int) -> list[bytes]:
    """Planes of a block, lowest first, up to the highest that is not empty."""
    octets = numbers.view(np.uint8).reshape(len(numbers), -1)
    used = int(numbers.max()).bit_length() if len(numbers) else 0
    octets = octets[:, : -(-used // 8)]
    if unit == 8:
        return [column.tobytes() for column in octets.T]
    bits = np.unpackbits(octets, axis=1, bitorder="little")[:, :used]
    return [column.tobytes() for column in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], numbers: int, unit: int, kind: np.dtype) -> np.ndarray:
    """The block that ``to_planes`` took apart."""
    octets = np.zeros((numbers, kind.itemsize), dtype=np.uint8)
    if planes:
        stacked = np.frombuffer(b"".join(planes), dtype=np.uint8).reshape(len(planes), -1)
        if unit == 1:
            bits = np.unpackbits(stacked, axis=1, count=numbers, bitorder="little")
            stacked = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
        octets[:, : len(stacked)] = stacked.T
    return octets.reshape(-1).view(kind)


class IdWriter:
    """Streams of numbers into one file."""

    def __init__(self, out, unit: int = 8, block: int = BLOCK, level: int = 3):
        if unit not in (1, 8) or block % 8:
            raise ValueError("planes hold bits (1) or bytes (8); a block is a multiple of eight numbers")
        self.out, self.unit, self.block = out, unit, block
        self.packer = zstandard.ZstdCompressor(level=level)
        self.waiting: dict[int, list[np.ndarray]] = {s: [] for s in TYPES}
        self.rest = dict.fromkeys(TYPES, 0)
        self.index: list[tuple] = []
        self.at = self._put(HEADER.pack(MAGIC, unit, block))
        self.written = dict.fromkeys(TYPES, 0)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def add(self, stream: int, numbers: np.ndarray) -> None:
        waiting = self.waiting[stream]
        waiting.append(numbers.astype(TYPES[stream], copy=False))
        self.written[stream] += len(numbers)
        self.rest[stream] += len(numbers)
        if self.rest[stream] >= self.block:
            whole = np.concatenate(waiting)
            full = len(whole) // self.block * self.block
            for begin in range(0, full, self.block):
                self._block(stream, whole[begin : begin + self.block])
            self.waiting[stream], self.rest[stream] = [whole[full:]], len(whole) - full

    def _block(self, stream: int, numbers: np.ndarray) -> None:
        planes = [self.packer.compress(p) for p in to_planes(np.ascontiguousarray(numbers), self.unit)]
        self.index.append((stream, len(numbers), self.at, zlib.crc32(numbers.tobytes()), [len(p) for p in planes]))
        self.at += self._put(b"".join(planes))

    def close(self) -> int:
        """Write what waits and the index; returns the file's bytes."""
        for stream, waiting in self.waiting.items():
            rest = np.concatenate(waiting) if waiting else np.zeros(0, TYPES[stream])
            if len(rest):
                self._block(stream, rest)
        index = self.packer.compress(json.dumps(self.index).encode())
        self.out.write(index + FOOTER.pack(self.at, len(index), len(self.index), MAGIC))
        self.out.close()
        return self.at + len(index) + FOOTER.size


@dataclass(frozen=True)
class Block:
    begin: int
    numbers: int
    at: int
    crc: int
    planes: list[int]


class IdFile:
    """Random and sequential reads of a file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        magic, self.unit, self.block = HEADER.unpack(self._read(0, HEADER.size))
        at, length, entries, end = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        index = json.loads(zstandard.ZstdDecompressor().decompress(self._read(at, length)))
        if magic != MAGIC or end != MAGIC or len(index) != entries:
            raise ValueError("not a file of token ids, or cut short")
        self.blocks: dict[int, list[Block]] = {s: [] for s in TYPES}
        self.counts = dict.fromkeys(TYPES, 0)
        for stream, numbers, place, crc, planes in index:
            self.blocks[stream].append(Block(self.counts[stream], numbers, place, crc, planes))
            self.counts[stream] += numbers

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def decode(self, stream: int, block: Block) -> np.ndarray:
        data, unpack, planes, at = self._read(block.at, sum(block.planes)), zstandard.ZstdDecompressor(), [], 0
        for size in block.planes:
            planes.append(unpack.decompress(data[at : at + size]))
            at += size
        numbers = from_planes(planes, block.numbers, self.unit, TYPES[stream])
        if zlib.crc32(numbers.tobytes()) != block.crc:
            raise ValueError(f"block of stream {stream} at {block.at} is damaged")
        return numbers

    def stream(self, stream: int) -> Iterator[np.ndarray]:
        for block in self.blocks[stream]:
            yield self.decode(stream, block)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids [begin, end) of the file; only the blocks they lie in are read."""
        parts = [
            self.decode(IDS, b)[max(begin - b.begin, 0) : end - b.begin]
            for b in self.blocks[IDS][begin // self.block : -(-end // self.block)]
        ]
        return np.concatenate(parts) if parts else np.zeros(0, TYPES[IDS])

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """Document id, number of ids and its ids piece by piece, which must be used up before the next document."""
        blocks, rest = self.stream(IDS), np.zeros(0, TYPES[IDS])

        def take(wanted: int) -> Iterator[np.ndarray]:
            nonlocal rest
            while wanted:
                if not len(rest):
                    rest = next(blocks)
                piece, rest = rest[:wanted], rest[wanted:]
                wanted -= len(piece)
                yield piece

        for names, lengths in zip(self.stream(DOCS), self.stream(LENGTHS)):
            for name, length in zip(names.view("<i8").tolist(), lengths.tolist()):
                yield (None if length & 1 else name), length >> 1, take(length >> 1)


def _joined(lists) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids one after another, and their lengths."""
    flat, sizes = [], []
    for ids in lists:
        flat += ids
        sizes.append(len(ids))
    return np.array(flat, dtype=np.uint32), np.array(sizes, dtype=np.int64)


class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library."""

    def __init__(self, definition: str, memory: int = MEMORY):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.by_piece = separable(definition)
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        # Pieces at the start of a text and pieces after a space: their place in the tables of ids.
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        begin = 0
        while begin < len(texts):  # by about a megabyte, as the library's results are far larger than the texts
            end, chars = begin, 0
            while end < len(texts) and (end == begin or chars + len(texts[end]) < 1 << 20):
                chars, end = chars + len(texts[end]), end + 1
            for found in self.tokenizer.encode_batch_fast(texts[begin:end], add_special_tokens=False):
                yield found.ids
            begin = end

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of a part that the tokenizer does not cut, straight from its merges."""
        ids = self.parts.get(part)
        if ids is None:
            if part.isascii():
                named = part.replace(" ", SPACE).replace("\n", LINE_END)
            else:
                named = part.encode().decode("latin-1").translate(BYTE_NAMES)
            ids = self.parts[part] = tuple([t.id for t in self.tokenizer.model.tokenize(named)])
        return ids

    def _learn(self, codes: dict[str, int], pieces: list[str], prefix: str) -> None:
        """Remember the ids of new pieces: word by word where they are plain lines, by the whole tokenizer otherwise."""
        plain, others, found, part, match = [], [], [], self._part, PLAIN_LINE.fullmatch
        for piece in pieces:
            lines = [match(line) for line in piece.split("\n")]
            if None in lines:
                others.append(piece)
                continue
            word, marks = lines[0].groups()
            ids = part(prefix + word)
            if marks:
                ids += part(marks)
            for line in lines[1:]:
                ids += part("\n") + part(line[1]) + part(line[2])
            plain.append(piece)
            found.append(ids)
        # An uneven piece has the space before it in its name.
        found += self._encode([p if p[:1] == " " and prefix else prefix + p for p in others])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        codes.update(zip(chain(plain, others), range(len(self.sizes), len(self.sizes) + len(found))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and how many each has."""
        if not self.by_piece:
            return _joined(self._encode(texts.to_pylist() if isinstance(texts, pa.Array) else texts))
        if len(self.sizes) > self.memory:
            self._forget()
        array = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(array, " ")
        begins = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        words = split.flatten()
        heads = words.take(pa.array(begins[:-1])).to_pylist()
        coded = words.dictionary_encode()
        # Each word of the batch is looked up once. Words beside other white space than one space are not pieces.
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.later.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(places < 0)
        new = [names[i] for i in missing.tolist()]
        self._learn(self.later, [n for n in new if EVEN.fullmatch(n)], " ")
        places[missing] = [self.later.get(n, -1) for n in new]
        at = places[coded.indices.to_numpy(zero_copy_only=False)]
        odd = np.unique(np.searchsorted(begins, np.flatnonzero(at < 0), "right") - 1)
        if len(odd):
            split = [PIECE_BORDER.split(array[i].as_py()) for i in odd.tolist()]
            named = [[p if EVEN.fullmatch(p) else " " + p for p in pieces] for pieces in split]
            self._learn(self.later, list(set(chain.from_iterable(named)).difference(self.later)), " ")
            parts, counts, last = [], np.diff(begins), 0
            for i, pieces, keys in zip(odd.tolist(), split, named):
                parts += [at[last : begins[i]], np.array([self.later[k] for k in keys], np.int64)]
                heads[i], counts[i], last = pieces[0], len(pieces), begins[i + 1]
            at, begins = np.concatenate([*parts, at[last:]]), np.concatenate([[0], np.cumsum(counts)])
        self._learn(self.first, list(set(heads).difference(self.first)), "")
        at[begins[:-1]] = [self.first[h] for h in heads]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)]
        borders = np.concatenate([[0], ends])[begins]
        return ids, np.diff(borders)


_encoders: dict[str, Encoder] = {}


def encoder_of(definition: str) -> Encoder:
    """One encoder per Python worker: what it has learned serves later tasks as well."""
    if definition not in _encoders:
        _encoders.clear()
        _encoders[definition] = Encoder(definition)
    return _encoders[definition]


def separable(definition: str) -> bool:
    """Whether a text may be encoded piece by piece: byte-level splitting, nothing before or after it."""
    parts = json.loads(definition)
    splitter = parts.get("pre_tokenizer") or {}
    return (
        splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", False)
        and not splitter.get("add_prefix_space", True)
        and not parts.get("normalizer")
        and not parts.get("truncation")
    )


def _target(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if ":" in root.split("/")[0] else f"file://{root}")


FILES = "path string, part int, piece int, docs bigint, ids bigint, bytes bigint"


def write_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, *, unit: int = 8, block: int = BLOCK,
    range_bytes: int = RANGE_BYTES, file_ids: int = FILE_IDS, end_id: int = END_ID,
) -> DataFrame:
    """Encode the documents (``doc_id``, ``text``) by the tokenizer file at the path ``tokenizer`` and return the
    files, in the order of their ids: ``path``, ``part``, ``piece``, ``docs``, ``ids``, ``bytes``."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-ids")
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Small tables are cut finer, so that all cores have work.
    cores = spark.sparkContext.defaultParallelism
    ranges = max(-(-size // range_bytes), min(4 * cores, -(-size // (1 << 20))), 1)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), text_of("text").alias("text"), F.xxhash64("text").alias("tie"),
        F.rand(7).alias("deal"),  # rows equal in id and text may lie in several ranges
    )
    ordered = [F.col("doc_id").asc_nulls_last(), "tie", "deal"]
    dealt = rows.repartitionByRange(ranges, *ordered).sortWithinPartitions(*ordered[:2], "text").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, base = _target(folder)
        store.create_dir(base, recursive=True)
        encoder, done, out = encoder_of(definition.value), [], None

        def close() -> None:
            size = out.close()
            path = f"{base}/part-{context.partitionId():06d}-{len(done):04d}.ids"
            store.move(temporary, path)
            done.append((path, context.partitionId(), len(done), out.written[DOCS], out.written[IDS], size))

        for batch in batches:
            if out is None:
                temporary = f"{base}/.part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}"
                out = IdWriter(store.open_output_stream(temporary), unit, block)
            ids, sizes = encoder.encode(batch.column(1))
            # The end id is placed behind the last id of each document.
            out.add(IDS, np.insert(ids, np.cumsum(sizes), np.uint32(end_id)))
            names = batch.column(0)
            out.add(DOCS, names.fill_null(0).to_numpy().view(np.uint64))
            none = names.is_null().to_numpy(zero_copy_only=False)
            out.add(LENGTHS, ((sizes + 1) << 1 | none).astype(np.uint64))
            if out.written[IDS] >= file_ids:
                close()
                out = None
        if out is not None:
            close()
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in FILES.split(", ")]
        yield pa.record_batch([pa.array([d[i] for d in done], t) for i, t in enumerate(kinds)], names=names)

    # Written at once: a later action must not write the files again.
    return written(dealt.mapInArrow(write, FILES), "token-files")


def with_start(files: DataFrame, group: int = 1000) -> DataFrame:
    """``base``: ids in all files before. Sums run inside groups of parts, then over the groups' totals."""
    rows = files.withColumn("parts", F.floor(F.col("part") / group))
    inside = Window.partitionBy("parts").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy("parts").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("parts").agg(F.sum("ids").alias("total"))
    totals = totals.select("parts", F.coalesce(F.sum("total").over(above), F.lit(0)).alias("before"))
    base = F.coalesce(F.sum("ids").over(inside), F.lit(0)) + F.col("before")
    return rows.join(totals, "parts").withColumn("base", base).drop("parts", "before")


DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_documents(files: DataFrame) -> DataFrame:
    """One row per document of the files: where its ids start, how many they are, and their check sum."""
    rows = with_start(files).select("path", "base", "part", "piece")
    # By a number of its own, so that files are not merged into few tasks because their rows are small.
    rows = rows.repartitionByRange(max(files.count(), 1), "part", "piece").select("path", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            names = [c.split()[0] for c in DOCUMENTS.split(", ")]
            return pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], names=names)

        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = _target(path)
                with store.open_input_file(name) as file:
                    found = []
                    for doc, length, pieces in IdFile(file).documents():
                        crc = 0
                        for piece in pieces:
                            crc = zlib.crc32(piece, crc)
                        found.append((doc, start, length, crc))
                        start += length
                        if len(found) == BLOCK:
                            yield batch_of(found)
                            found = []
                    yield batch_of(found)

    return rows.mapInArrow(read, DOCUMENTS)


def report(docs: DataFrame, tokenizer: str, **options: int) -> DataFrame:
    """Write all documents and return what the files say."""
    ready(docs.sparkSession)
    return read_documents(write_files(docs, tokenizer, **options))
