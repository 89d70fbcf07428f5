"""Helpers shared by the operators: reading, written intermediates, word hashing in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import prepare
from tidelog.sources.scratch import scratch_dir, through

# Rows carry whole texts, so a batch is bounded by bytes as well as by rows.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# The white space of the contracts, space and U+0009 to U+000D.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """A session that ships this package to workers and hands them small batches."""
    prepare(spark)
    for name, value in ARROW_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Continue from a copy in the shared folder: computed once, and safe from lost executors."""
    return through(df, scratch_dir(df.sparkSession, label))


def text_of(column: str):
    return F.coalesce(F.col(column), F.lit(""))


def one_per_group(kept: DataFrame, key: str) -> DataFrame:
    """Drop repeated rows of a group that should have one row left.

    Groups with one row, which are nearly all, are not shuffled: only their keys are counted.
    """
    repeated = written(kept.groupBy(key).count().where("count > 1").select(key), "repeated")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, key, "left_anti")
    return single.unionByName(kept.join(repeated, key, "left_semi").dropDuplicates([key]))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows, without a copy per row. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = column.cast(pa.large_binary())
    if filled.null_count:
        filled = filled.fill_null(b"")
    _, offsets, data = filled.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if data is None or not len(filled):
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``n`` of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = _powers[base] = (both[0], both[1])
    return have


class Alphabet:
    """Which bytes belong to words, and a 64-bit value for each byte after lower-casing."""

    def __init__(self, separators: bytes, lower: bool, seed: int = 7):
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        folded = np.arange(256)
        if lower:
            folded[ord("A") : ord("Z") + 1] += 32
        values = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.value = values[folded] | np.uint64(1)


WHITE = Alphabet(WHITE_SPACE.encode(), lower=False)
ALNUM = Alphabet(
    bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)),
    lower=True,
)

PIECE = 1 << 20


def _pieces(data: np.ndarray, cuts: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about a megabyte that do not end inside a word."""
    begin, total = 0, len(data)
    while begin < total:
        end = min(begin + PIECE, total)
        if end < total:
            later = np.searchsorted(cuts, end, "right") - 1
            gaps = np.flatnonzero(~is_word[data[begin:end]])
            best = max(int(cuts[later]), begin + int(gaps[-1]) + 1 if len(gaps) else begin)
            if best > begin:
                end = best
            else:  # a word longer than a piece
                while end < total and is_word[data[end]]:
                    more = ~is_word[data[end : end + PIECE]]
                    end += int(np.argmax(more)) if more.any() else len(more)
                following = np.searchsorted(cuts, begin, "right")
                end = min(end, int(cuts[following])) if following < len(cuts) else end
        yield begin, end
        begin = end


def word_bounds(data: np.ndarray, cuts: np.ndarray, begin: int, end: int, is_word: np.ndarray):
    """Starts and ends of the words in a range; words do not cross rows."""
    inside = is_word[data[begin:end]]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    lo, hi = np.searchsorted(cuts, [begin, end])
    borders = cuts[lo:hi] - begin
    borders = borders[(borders > 0) & (borders < end - begin)]
    first[borders] |= inside[borders]
    last[borders - 1] |= inside[borders - 1]
    return np.flatnonzero(first) + begin, np.flatnonzero(last) + begin + 1


def hash_words(data: np.ndarray, cuts: np.ndarray, alphabet: Alphabet):
    """64-bit hashes of all words of a batch, and for each row where its words begin."""
    hashes, starts = [], []
    for begin, end in _pieces(data, cuts, alphabet.is_word):
        s, e = word_bounds(data, cuts, begin, end, alphabet.is_word)
        up, down = powers(end - begin + 1)
        sums = np.zeros(end - begin + 1, dtype=np.uint64)
        np.cumsum(alphabet.value[data[begin:end]] * up[: end - begin], out=sums[1:])
        raw = (sums[e - begin] - sums[s - begin]) * down[s - begin]
        hashes.append(mix(raw + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(cuts), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), cuts)


def hash_grams(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of each run of ``n`` words (``len(words) - n + 1`` of them, none if there are fewer)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    factor = np.uint64(base | 1)
    for i in range(n):
        total = total * factor + words[i : i + count]
    return mix(total + np.uint64(n))


def hash_spans(words: np.ndarray, starts: np.ndarray, n: int, base: int) -> np.ndarray:
    """The same hash as ``hash_grams``, of the runs at the given starts only."""
    total = np.zeros(len(starts), dtype=np.uint64)
    factor = np.uint64(base | 1)
    for i in range(n):
        total = total * factor + words[starts + i]
    return mix(total + np.uint64(n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        if len(out) <= step:
            return out[:0]
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
