"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import text_of

#: Labelled documents that a classifier is fitted on, at most.
TRAIN_DOCS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text and label (0 or 1) of labelled documents outside the held-out fold.

    Rows without id or label are left out, of several labels of one id the largest counts, and of
    more rows than ``most`` those with the smallest hashes of their ids stay.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    share = min(1.0, most / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about TRAIN_DOCS rows of 12 bytes by the line above, so a copy for each executor is small.
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(known), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest."""
    if len(labels) == 0 or labels.min() == labels.max():
        return 1.0
    choices = np.geomspace(0.1, 10, 81)

    def loss(t: float) -> float:
        p = np.clip(sigmoid(logits / t), 1e-6, 1 - 1e-6)
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    return float(min(choices, key=loss))
