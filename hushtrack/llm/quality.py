"""Quality scores from random-indexing word vectors (operator 6).

Random indexing: every token has a sparse random index vector, and the vector of a token is the sum of
the index vectors of its neighbours over all documents. Tokens share ``BUCKETS`` rows by their hash, so
the table has a fixed size. Vectors of a text are pooled to their mean, and a network of two layers
(numpy) turns the pooled vector into a logit. A part of the labelled sample that the network has not
seen sets the temperature that calibrates it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.llm.common import text_of
from hushtrack.llm.labelled import TRAIN_DOCS, fold, sigmoid, temperature, training_sample

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BUCKETS, DIMENSIONS, NONZEROS = 8192, 32, 2
WINDOW = 2
HIDDEN = 32
EPOCHS = 60
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_HASH_MEMORY = 300_000
#: The last buckets are for words in capitals, numbers and runs of signs.
_SHAPES = BUCKETS - 256


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    rng = np.random.default_rng(6)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZEROS]
    return places, rng.choice([-1, 1], (BUCKETS, NONZEROS))


def buckets(text: str, memory: dict[str, int]) -> np.ndarray:
    """Buckets of the tokens of a text: words, numbers, runs of signs, and the case of words."""
    tokens = _TOKEN.findall(text)
    get = memory.get
    out = [get(t) for t in tokens]
    if None in out:
        if len(memory) > _HASH_MEMORY:
            memory.clear()
        for k, b in enumerate(out):
            if b is None:
                t = tokens[k]
                # Hash of the word as written; capital words, rare otherwise, share one part of the rows.
                if t.isalpha() and len(t) > 1 and t.isupper():
                    b = _SHAPES + crc32(t[:1].encode()) % 64
                elif t.isalpha():
                    b = crc32(t.lower().encode()) % _SHAPES
                elif t.isdigit():
                    b = _SHAPES + 64 + min(len(t), 31)
                else:
                    b = _SHAPES + 96 + crc32(t[:4].encode()) % 160
                memory[t] = out[k] = b
    return np.array(out, np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Sums of the index vectors of neighbours, for each bucket, over all documents; unit length."""
    names = [f"v{k}" for k in range(DIMENSIONS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total, memory = np.zeros(BUCKETS * DIMENSIONS), {}
        ats, nears, held = [], [], 0

        def add() -> None:
            nonlocal total, held
            if held:
                at, near = np.concatenate(ats), np.concatenate(nears)
                for e in range(NONZEROS):
                    total += np.bincount(at * DIMENSIONS + places[near, e], signs[near, e], minlength=len(total))
            ats.clear(), nears.clear()
            held = 0

        for batch in batches:
            for text in batch.column("text").to_pylist():
                b = buckets(text, memory)
                for k in range(1, min(WINDOW, len(b) - 1) + 1):
                    ats.extend((b[:-k], b[k:]))
                    nears.extend((b[k:], b[:-k]))
                    held += 2 * (len(b) - k)
                # The table is gone through once for many texts.
                if held > 1_000_000:
                    add()
        add()
        grid = total.reshape(BUCKETS, DIMENSIONS).astype(np.int64)
        seen = np.flatnonzero(grid.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(grid[seen, k]) for k in range(DIMENSIONS)]], ["bucket", *names])

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "bucket long, " + ", ".join(f"{n} long" for n in names))
    rows = rows.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    for r in rows.collect():  # at most BUCKETS rows
        vectors[r.bucket] = r[1:]
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(text: str, vectors: np.ndarray, memory: dict[str, int]) -> np.ndarray:
    """Mean and spread of a text's vectors, its share of different tokens and pairs, its length."""
    b = buckets(text, memory)
    if not len(b):
        return np.zeros(2 * DIMENSIONS + 4)
    n = len(b)
    rows, counts = np.unique(b, return_counts=True)
    own = vectors[rows]
    mean = counts @ own / n
    spread = np.sqrt(np.maximum(counts @ own**2 / n - mean**2, 0))
    pairs = len(np.unique(b[:-1] * BUCKETS + b[1:])) / max(n - 1, 1) if n > 1 else 1.0
    return np.concatenate((mean, spread, [len(rows) / n, pairs, counts.max() / n, np.log1p(n) / 10]))


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def _train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> QualityModel:
    rng = np.random.default_rng(6)
    width = x.shape[1] if len(x) else 2 * DIMENSIONS + 4
    centre = x.mean(axis=0) if len(x) else np.zeros(width)
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(width)
    share = float(y.mean()) if len(y) else 0.5
    p = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    p[3][0] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if not len(y) or not 0 < share < 1:
        p[2][:] = 0
        return QualityModel(vectors, centre, scale, *p[:3], float(p[3][0]))
    order = rng.permutation(len(y))
    test, fit = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - centre) / scale
    first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for k in range(0, len(fit), 256):
            rows = fit[k : k + 256]
            h = np.tanh(z[rows] @ p[0] + p[1])
            error = (sigmoid(h @ p[2] + p[3]) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - h**2)
            slopes = [z[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            step += 1
            for a, g, m, v in zip(p, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = QualityModel(vectors, centre, scale, *p[:3], float(p[3][0]))
    model.temperature = temperature(model.logits(x[test]), y[test])
    return model


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> QualityModel:
    """A model from the vectors of all documents and labelled ones outside the held-out fold (at most
    ``most``). Without both classes every text scores the share of label 1, one half without labels."""
    vectors = word_vectors(docs)
    shipped = spark.sparkContext.broadcast(vectors)
    sample = training_sample(docs, labels, "quality", FOLDS, HELD_OUT, most)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        for batch in batches:
            x = [pooled(t, shipped.value, memory) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([v.tobytes() for v in x], pa.binary()), batch.column("label")], ["doc_id", "x", "label"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Bounded by ``most`` rows of a few hundred bytes.
    rows = sample.mapInArrow(read, f"doc_id {kind}, x binary, label int").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    x = np.array([np.frombuffer(r.x) for r in rows], float).reshape(len(rows), 2 * DIMENSIONS + 4)
    return _train(x, np.array([r.label for r in rows], float), vectors)


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A null text counts as empty and is scored like any other. held_out is null for a null doc_id.
    Repeated rows get equal rows; an empty table gives an empty result; other columns are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memory = QualityModel(**shipped.value), {}
        for batch in batches:
            x = [pooled(t, m.vectors, memory) for t in batch.column("text").to_pylist()]
            scores = m.scores(np.array(x)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
    return out.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
