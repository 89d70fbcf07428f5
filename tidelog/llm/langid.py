"""Language identification with n-gram presence kernels.

The kernel of two texts is the blended spectrum: for n from 1 to 4, the number of byte n-grams (after
lower-casing) that are present in both, weighted by n and normalised, so that a text has kernel 1 with
itself. n-grams are hashed into ``FEATURES`` positions. A bounded number of landmark texts spans a
Nyström approximation of the kernel, in which kernel ridge regression is fitted one language
against the rest; the linear systems have the size of the landmarks, and Spark sums them up from
the training rows. Texts are scored in batches: presence times landmarks, kernel times weights.

Training rows are labelled rows that are not held out, those with the smallest hash of their id, at most
``max_rows``, and of these for each language the first ``landmarks / languages`` are landmarks.

Defined cases: a text that is null or has no letter is ``und`` with score 0. Null labels are not learned from.
Ties go to the first language by name. Without training rows every text is ``und``. Long texts are read
in pieces, so that memory does not grow with them. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import buffers, mix, written

FEATURES = 1 << 13
ORDERS = (1, 2, 3, 4)
PIECE = 1 << 19
ROWS = 128
# Fixed values of the contract.
HELD_OUT_OF, HELD_OUT = 4, 2

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _weights() -> np.ndarray:
    """Root of the weight of each position; positions are split among the orders."""
    return np.repeat(np.sqrt(np.array(ORDERS, dtype=np.float32)), FEATURES // len(ORDERS))


def presence(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Normalised presence vectors of a batch of texts, one row each."""
    share = FEATURES // len(ORDERS)
    rows = len(cuts) - 1
    found = np.zeros(rows * FEATURES, dtype=bool)
    for begin in range(0, len(data), PIECE):
        end = min(begin + PIECE + max(ORDERS) - 1, len(data))
        text = LOWER[data[begin:end]].astype(np.uint64)
        row = np.repeat(np.arange(rows), np.diff(np.clip(cuts, begin, end)))
        code = np.zeros(len(text), dtype=np.uint64)
        for i, n in enumerate(ORDERS):
            # The code of n bytes is that of the first n - 1 and one more.
            code = code[: len(text) - n + 1] * np.uint64(256) + text[n - 1 :]
            same = row[: len(code)] == row[n - 1 :]
            place = mix(code + np.uint64(n)) & np.uint64(share - 1)
            found[(row[: len(code)] * FEATURES + i * share + place.astype(np.int64))[same]] = True
    vectors = found.reshape(rows, FEATURES).astype(np.float32) * _weights()
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.maximum(norms, 1e-9)


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(column), ROWS):
        yield buffers(column.slice(at, ROWS))


def held_out() -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(name), F.lit(HELD_OUT_OF)) == HELD_OUT


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


class Model:
    """Languages, landmark vectors, and the weights of each language over the landmark kernel."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors @ self.landmarks.T) @ self.weights


def train(docs: DataFrame, *, max_rows: int = 8_000, landmarks: int = 128, ridge: float = 1e-2) -> Model | None:
    """Fit on at most ``max_rows`` labelled rows; None without any."""
    place = F.xxhash64("doc_id")
    pool = docs.where(F.col("lang").isNotNull() & ~held_out() & _has_letter()).select("text", "lang", place.alias("place"))
    narrow = docs.where(F.col("lang").isNotNull() & ~held_out() & _has_letter()).select(place.alias("place"))
    border = narrow.orderBy("place").limit(max_rows).agg(F.max("place")).first()[0]
    if border is None:
        return None

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for data, cuts in _chunks(batch.column(0)):
                packed += [np.packbits(v > 0).tobytes() for v in presence(data, cuts)]
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array(packed, pa.binary())], names=["lang", "place", "bits"])

    # Rows that repeat an id share a place: the limit holds for them as well, on short vectors.
    drawn = pool.where(F.col("place") <= border).mapInArrow(vectors, "lang string, place bigint, bits binary")
    sample = written(drawn.orderBy("place", "bits", "lang").limit(max_rows), "sample")
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    first = Window.partitionBy("lang").orderBy("place", "bits")
    each = max(1, landmarks // len(languages))
    rows = sample.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).orderBy("lang", "n").collect()
    marks = _unpacked([r["bits"] for r in rows])
    # Nyström: features are kernel values with the landmarks times the inverse root of their own kernel.
    values, basis = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = basis[:, good] / np.sqrt(values[good])
    shared = docs.sparkSession.sparkContext.broadcast((languages, marks, root))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, marks, root = shared.value
        square = np.zeros((root.shape[1] + 1, root.shape[1] + 1))
        answer = np.zeros((root.shape[1] + 1, len(languages)))
        for batch in batches:
            x = (_unpacked(batch.column(2).to_pylist()) @ marks.T) @ root
            x = np.hstack([x, np.ones((len(x), 1))])
            y = np.where(np.array(batch.column(0).to_pylist())[:, None] == np.array(languages)[None, :], 1.0, -1.0)
            square += x.T @ x
            answer += x.T @ y
        yield pa.record_batch([pa.array([square.tobytes()]), pa.array([answer.tobytes()])], names=["square", "answer"])

    # One pair of matrices per task, a few megabytes in all.
    parts = sample.repartition(LEARN_TASKS, "place").mapInArrow(sums, "square binary, answer binary").collect()
    size = root.shape[1] + 1
    square = sum(np.frombuffer(p["square"]).reshape(size, size) for p in parts)
    answer = sum(np.frombuffer(p["answer"]).reshape(size, len(languages)) for p in parts)
    penalty = np.eye(size) * ridge * square[-1, -1] / size
    penalty[-1, -1] = 0
    solved = np.linalg.solve(square + penalty, answer)
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    return Model(languages, marks.astype(np.float32), weights.astype(np.float32))


LEARN_TASKS = 8


def _unpacked(bits: list[bytes]) -> np.ndarray:
    found = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1)
    vectors = found.astype(np.float32) * _weights()
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every document."""
    letters = docs.select("doc_id", "text", _has_letter().alias("known"))
    if model is None:
        return letters.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks times FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            best, sure = [], []
            for data, cuts in _chunks(batch.column(1)):
                kernel = presence(data, cuts) @ m.landmarks.T
                scores = kernel @ m.weights[:-1] + m.weights[-1]
                parts = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
                best += scores.argmax(axis=1).tolist()
                sure += (parts.max(axis=1) / parts.sum(axis=1)).tolist()
            known = batch.column(2).to_pylist()
            names = [m.languages[b] if k else "und" for b, k in zip(best, known)]
            yield pa.record_batch(
                [batch.column(0), pa.array(names, pa.string()), pa.array([s if k else 0.0 for s, k in zip(sure, known)], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = T.StructType(
        [letters.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return letters.mapInArrow(run, schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    labelled = docs.select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), train(labelled, **options))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
