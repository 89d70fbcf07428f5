"""Quality classifier: hashed word n-grams, logistic regression with follow-the-regularised-leader updates.

Features of a text are its words and word pairs, and the shapes of both: runs of capitals, small letters,
digits and each punctuation mark count once (``Word.`` is capital, small, full stop), and a pair notes
whether its words are equal. They are hashed into ``1 << BITS`` weights; a text's value for a feature is the
share of its words that have it, so a score is a sparse dot product, computed over whole batches.

Training rows are the labelled rows with the smallest hash of their id, at most ``max_rows`` (the bound of
what is fitted). They are hashed in parallel and dealt to a fixed number of learners; each makes
follow-the-regularised-leader passes over its rows, and their weights are averaged. The order is that of the
id hashes, so reruns agree.

Defined cases: null and empty texts have no features and get the intercept's score. Labels that are null, or
of documents that do not exist, are not used; a document with several labels is learned with each. Without labels all
scores are 0.5. Extra columns are carried along. Long texts are hashed in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import WHITE, buffers, hash_words, mix, powers, word_bounds, _pieces

BITS = 18
LEARNERS = 8
SCALE = 4.0
# Fixed values of the contract.
HELD_OUT_OF, THRESHOLD = 5, 0.3


def _classes() -> np.ndarray:
    """Class of each byte: small letters, capitals, digits, bytes above ASCII, other bytes themselves."""
    kind = np.arange(256)
    kind[ord("a") : ord("z") + 1] = ord("a")
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("0") : ord("9") + 1] = ord("0")
    kind[128:] = ord("a")
    return kind


CLASS = _classes()
CLASS_VALUE = np.random.Generator(np.random.PCG64(3)).integers(0, 1 << 64, 256, dtype=np.uint64)


def hash_shapes(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One hash for each word's sequence of classes, repeats left out."""
    out = [np.zeros(0, np.uint64)]
    for begin, end in _pieces(data, cuts, WHITE.is_word):
        s, e = word_bounds(data, cuts, begin, end, WHITE.is_word)
        kind = CLASS[data[begin:end]]
        fresh = np.ones(len(kind), dtype=bool)
        fresh[1:] = kind[1:] != kind[:-1]
        fresh[s - begin] = True
        rank = np.cumsum(fresh)
        up, down = powers(end - begin + 2)
        sums = np.zeros(end - begin + 1, dtype=np.uint64)
        np.cumsum(np.where(fresh, CLASS_VALUE[kind] * up[rank], np.uint64(0)), out=sums[1:])
        out.append(mix((sums[e - begin] - sums[s - begin]) * down[rank[s - begin]]))
    return np.concatenate(out)


def features(data: np.ndarray, cuts: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each kind of feature its weights' numbers and rows, for all words of a batch; words per row."""
    words, rows = hash_words(data, cuts, WHITE)
    shapes = hash_shapes(data, cuts)
    row = np.repeat(np.arange(len(cuts) - 1), np.diff(rows))
    kinds = [(words, row), (shapes + np.uint64(1), row)]
    if len(words) > 1:
        pair = row[1:] == row[:-1]
        again = (words[1:] == words[:-1]).astype(np.uint64)
        both = mix(words[:-1] * np.uint64(3) + words[1:])
        looks = mix(shapes[:-1] * np.uint64(5) + shapes[1:] + again)
        kinds += [(both[pair], row[1:][pair]), (looks[pair], row[1:][pair])]
    numbered = [((mix(h + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64), r) for n, (h, r) in enumerate(kinds)]
    return numbered, np.diff(rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows: hash of the id, label, and the text's features with their values."""
    for batch in batches:
        data, cuts = buffers(batch.column(2))
        kinds, counts = features(data, cuts)
        flat = np.concatenate([r * (1 << BITS) + f for f, r in kinds])
        unique, times = np.unique(flat, return_counts=True)
        row = unique >> BITS
        value = (times / np.maximum(counts[row], 1) * SCALE).astype(np.float32)
        borders = np.searchsorted(row, np.arange(len(counts) + 1)).astype(np.int32)
        index = (unique & ((1 << BITS) - 1)).astype(np.int32)
        yield pa.record_batch(
            [
                batch.column(0), batch.column(1),
                pa.ListArray.from_arrays(pa.array(borders), pa.array(index)),
                pa.ListArray.from_arrays(pa.array(borders), pa.array(value)),
            ],
            names=["place", "label", "index", "value"],
        )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _learn(passes: int, alpha: float, beta: float, l1: float, l2: float):
    """Follow-the-regularised-leader over one learner's rows (proximal form, rates per weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for label, index, value in zip(*(batch.column(i) for i in (2, 3, 4))):
                examples.append((label.as_py(), index.values.to_numpy(), value.values.to_numpy().astype(float)))
        if not examples:
            return
        z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

        def weights(at):
            part, square = z[at], n[at]
            shrunk = part - np.sign(part) * l1
            return np.where(np.abs(part) <= l1, 0.0, -shrunk / ((beta + np.sqrt(square)) / alpha + l2))

        for _ in range(passes):
            for label, index, value in examples:
                at = np.append(index, 1 << BITS)  # the last weight is the intercept
                x = np.append(value, 1.0)
                w = weights(at)
                g = (_sigmoid(w @ x) - label) * x
                square = n[at]
                z[at] += g - (np.sqrt(square + g * g) - np.sqrt(square)) / alpha * w
                n[at] = square + g * g
        model = weights(np.arange(len(z))).astype(np.float32)
        yield pa.record_batch([pa.array([model.tobytes()], pa.binary())], names=["model"])

    return run


def held_out(of: int = HELD_OUT_OF) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(of)) == 0


def train(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 16_000, passes: int = 3,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4,
) -> np.ndarray:
    """Weights and intercept, learned from labelled rows that are not held out, ``max_rows`` at most."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col("quality").cast("double").alias("label"), F.xxhash64("doc_id").alias("place"))
        .orderBy("place", "label").limit(max_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("place", "label", "text")
    hashed = sample.mapInArrow(_hashed, "place bigint, label double, index array<int>, value array<float>")
    dealt = hashed.withColumn("learner", F.pmod("place", F.lit(LEARNERS))).select("learner", "place", "label", "index", "value")
    learned = (
        dealt.repartition(LEARNERS, "learner").sortWithinPartitions("learner", "place", "label")
        .mapInArrow(_by_learner(_learn(passes, alpha, beta, l1, l2)), "model binary")
    )
    models = [np.frombuffer(r["model"], np.float32) for r in learned.collect()]  # LEARNERS rows
    return np.mean(models, axis=0, dtype=np.float64) if models else np.zeros((1 << BITS) + 1)


def _by_learner(learn):
    """Run a learner on its rows alone, also where one task has several learners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting = None, []
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if ids[lo] != current and waiting:
                    yield from learn(iter(waiting))
                    waiting = []
                current = ids[lo]
                waiting.append(batch.slice(lo, hi - lo))
        yield from learn(iter(waiting))

    return run


def score(docs: DataFrame, model: np.ndarray, column: str = "score") -> DataFrame:
    """The documents with a score in [0, 1] as their last column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 << BITS numbers
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            data, cuts = buffers(batch.column(at))
            kinds, counts = features(data, cuts)
            dots = sum(np.bincount(r, weights=weights[f], minlength=len(counts)) for f, r in kinds)
            scores = _sigmoid(dots / np.maximum(counts, 1) * SCALE + weights[-1])
            yield pa.record_batch([*batch.columns, pa.array(scores)], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, **options))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject, in all their columns."""
    scored = score(docs, train(docs, labels, **options), "__score")
    return scored.where(F.col("__score") >= THRESHOLD).drop("__score")
