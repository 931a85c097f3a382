"""Embedding whitening by weighted multiplicity covariance (operator 11).

Equal vectors are grouped first and from then on each distinct vector is one row with a weight. Sums
are exact integers; the covariance is a sum of weighted, centred matrix products, one per task, of which
only d x d numbers leave the task. Each distinct vector is whitened once and joined back to its rows;
vectors so frequent that their rows would crowd one task are joined by broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import shared

#: Components that are returned, at most.
COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: A vector with more than one in so many rows is frequent; there are fewer such vectors than this.
FREQUENT = 1000
#: Variance below this part of the largest counts as none.
_NONE = 1e-12
_LARGEST = 1 << 62


def fixed_point(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the entries as integers; rows whose vector is null or has null or non-finite entries go.

    Of vectors of several lengths those of the commonest one stay (of equals, the longest). Entries whose
    integer would not fit 62 bits are cut to that range.
    """
    entry = "(v is not null and not isnan(v) and abs(cast(v as double)) < double('infinity'))"
    good = embeddings.where(f"embedding is not null and forall(embedding, v -> {entry})")
    scaled = f"floor(greatest(least(cast(v as double) * {SCALE}.0d, {_LARGEST >> 1}.0d), -{_LARGEST >> 1}.0d))"
    rows = good.select("vec_id", F.expr(f"transform(embedding, v -> cast({scaled} as bigint) + {SHIFT}L)").alias("x"))
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("x") == (sizes[0]["size"] if sizes else 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean, each entry from one exact integer (n x - S) where that fits 64 bits."""
    s = [int(v) for v in sums]
    if n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, s), default=0) < 1 << 63:
        return (n * x - np.array(s, np.int64)) / n
    return np.array([[(n * int(v) - s[k]) / n for k, v in enumerate(row)] for row in x]).reshape(x.shape)


def _added(parts: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray], columns: int) -> np.ndarray:
    """Sum over all batches of a matrix with so many columns.

    Each task adds up its own and sends one row per row of the matrix; those of equal place are added
    by Spark in order of the tasks, and only the sum comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = make(batch)
                total = part if total is None else total + part
        if total is not None:
            cells = pa.array(list(total.astype(np.float64)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), cells], ["i", "cells"])

    if columns == 0:
        return np.zeros((0, 0))
    cells = parts.mapInArrow(run, "i long, cells array<double>")
    sums = cells.groupBy("i").agg(*[F.sum(F.element_at("cells", k + 1)).alias(f"c{k}") for k in range(columns)])
    return np.array([list(r)[1:] for r in sums.orderBy("i").collect()]).reshape(-1, columns)


def _exact_sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """Weight of all vectors and the sum of each dimension, as exact integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, [0] * size
        for batch in batches:
            if not len(batch):
                continue
            x, w = _matrix(batch), batch.column("w").to_numpy()
            if int(np.abs(x).max(initial=0)) * int(w.sum()) < 1 << 62:
                part = (w @ x).tolist()
            else:
                part = [sum(int(a) * int(b) for a, b in zip(w, column)) for column in x.T]
            total += int(w.sum())
            sums = [a + b for a, b in zip(sums, part)]
        rows = [(-1, str(total)), *[(k, str(s)) for k, s in enumerate(sums)]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["i", "s"])

    each = distinct.mapInArrow(run, "i long, s string")
    # One row per dimension comes to the driver.
    got = {r[0]: int(r[1]) for r in each.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string")).collect()}
    return got.get(-1, 0), [got.get(k, 0) for k in range(size)]


class Whitening:
    """Principal components of integer vectors, ready to be applied."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int) -> None:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(values)[::-1][:components]
        self.n, self.sums = n, sums
        self.vectors, self.values = vectors[:, order], values[order]
        self.trace = float(np.trace(covariance))
        self.none = self.values <= max(float(values.max(initial=0)), 0.0) * _NONE

    def apply(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.none, 0.0, 1 / np.sqrt(np.where(self.none, 1.0, self.values)))
        return (_centred(x, self.n, self.sums) @ self.vectors) * scale

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace if self.trace > 0 else 0.0 for v in self.values]


def fit(distinct: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """Fit to distinct vectors ``x`` of one length with weights ``w``."""
    n, sums = _exact_sums(distinct, size)

    def product(batch: pa.RecordBatch) -> np.ndarray:
        c = _centred(_matrix(batch), n, sums)
        return (c * batch.column("w").to_numpy()[:, None]).T @ c / n

    return Whitening(n, sums, _added(distinct, product, size), components)


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened vectors less the identity, without empty components."""
    live = np.flatnonzero(~model.none)
    if not len(live):
        return 0.0

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w, y = batch.column("w").to_numpy()[:, None], model.apply(_matrix(batch))[:, live]
        return (w * y).sum(axis=0, keepdims=True) / model.n

    mean = _added(distinct, moments, len(live))

    def product(batch: pa.RecordBatch) -> np.ndarray:
        y = model.apply(_matrix(batch))[:, live] - mean
        return (batch.column("w").to_numpy()[:, None] * y).T @ y / model.n

    return float(np.abs(_added(distinct, product, len(live)) - np.eye(len(live))).max())


def whitened(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """One row per remaining row of ``embeddings`` and component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n (weight of the fit), deviation (sum over
    dimensions of (n x - S)^2, null if it does not fit 64 bits), whitened, explained (share of the trace),
    identity_error. ``weights``: ``"counts"`` fits to all rows, ``"one"`` to each distinct vector once.

    Rows with a null vector, or null or non-finite entries, are left out, and so are vectors of a length that
    is not the commonest. Repeated rows stay repeated; a null vec_id stays null. A component without
    variance has whitened 0 and does not count in identity_error; with fewer dimensions than ``components``
    there are fewer components. No remaining rows give no rows. Other columns are ignored.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are 'counts' or 'one', not {weights!r}")
    rows = fixed_point(embeddings)
    distinct = shared(rows.groupBy("x").agg(F.count(F.lit(1)).alias("count")), "vectors")
    weight = F.col("count") if weights == "counts" else F.lit(1).cast("long")
    distinct = distinct.withColumn("w", weight)
    first = distinct.select(F.size("x")).first()
    model = fit(distinct, first[0] if first else 0, components)
    error = _identity_error(distinct, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            y = model.apply(x)
            deviations = [_deviation(row, model) for row in x]
            columns = [batch.column("x"), batch.column("count"), pa.array(deviations, pa.int64()), pa.array(list(y), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["x", "count", "deviation", "y"])

    done = shared(distinct.select("x", "count").mapInArrow(run, "x array<bigint>, count long, deviation long, y array<double>"), "whitened")
    each = _joined_back(rows, done)
    out = each.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
    shares = F.array(*[F.lit(v) for v in model.explained]) if model.explained else F.array(F.lit(0.0))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _deviation(x: np.ndarray, model: Whitening) -> int | None:
    exact = sum((model.n * int(v) - s) ** 2 for v, s in zip(x, model.sums))
    return exact if exact < 1 << 63 else None


def _joined_back(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows with what was computed for their vector. The rows of one vector may be a large part of all."""
    total = done.agg(F.sum("count")).first()[0] or 0
    often = F.col("count") > max(1, total // FREQUENT)
    # Fewer than FREQUENT + 1 vectors have that many rows, so this side is small whatever the table holds.
    hot = F.broadcast(done.where(often).select("x", F.col("deviation").alias("hot_deviation"), F.col("y").alias("hot_y")))
    rows = rows.join(hot, "x", "left")
    known = rows.where("hot_y is not null").select("vec_id", F.col("hot_deviation").alias("deviation"), F.col("hot_y").alias("y"))
    rest = rows.where("hot_y is null").select("vec_id", "x").join(done.where(~often).select("x", "deviation", "y"), "x")
    return known.unionByName(rest.select("vec_id", "deviation", "y"))
