"""Toxicity scores of restored text (operator 7).

A token that may be disguised (letters mixed with digits or signs that resemble letters, letters set
apart by blanks or dots, letters repeated three times or more) spans a lattice: each character may
stand for itself or a letter it resembles, a separator may be dropped or end a word, a repetition may
be one or two letters. The Viterbi path under a character trigram model, mixed from all documents and from the
words that mark toxic ones, and these words as wholes, is the restored word or words. Ordinary words have one path and stay as they are.

The score is a logistic regression on words and beginnings of words in the restored text, fitted on
a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.llm.common import text_of
from hushtrack.llm.labelled import TRAIN_DOCS, fold, sigmoid, training_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Words and beginnings of words that the model uses, at most.
FEATURES = 512
#: A feature must be in so many toxic documents of the sample, and weigh so many times more in them.
LEAST_DOCS, LEAST_RATIO = 4, 5.0
PREFIXES = (3, 4, 5, 6, 7, 8)
#: The weight of n occurrences among so many words is n / (1 + words * DAMPING), at most MOST_WEIGHT.
DAMPING, MOST_WEIGHT = 0.01, 4.0
#: Tokens whose features are remembered, and the longest of them in characters; longer ones are read anew.
WORD_MEMORY, LONGEST_KNOWN = 300_000, 200
#: Letters that signs and digits resemble.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~'·"
_SIGNS = "".join(LOOKALIKES)
_EDGE = ".,;:!?\"'()[]{}<>%*&#$@+|~-_=/\\"
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Classes of the character model: letters, 26 any other letter, 27 the edge of a word.
_OTHER, _BOUNDARY = 26, 27
_CLASSES = 28
#: Costs of the channel, in nats: a lookalike, a dropped separator, a dropped repetition.
COST_SIGN, COST_DROP, COST_REPEAT = 1.0, 0.2, 0.7
#: The cost of a separator that ends a word.
COST_SPLIT = 0.7


def _class(c: str) -> int:
    k = ord(c) - 97
    return k if 0 <= k < 26 else _OTHER if c.isalpha() else _BOUNDARY


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte; bytes that continue a character have none (-1)."""
    table = np.full(256, _BOUNDARY, np.int16)
    for k in range(26):
        table[97 + k] = table[65 + k] = k
    table[0x80:0xC0] = -1
    table[0xC0:] = _OTHER
    return table


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each triple of character classes occurs in all documents."""
    size = _CLASSES**3

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _byte_classes(), np.zeros(size, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                c = table[np.frombuffer(f" {text} ".encode(), np.uint8)]
                c = c[c >= 0].astype(np.int64)
                total += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(size)
    for code, n in rows.collect():  # at most 28 ** 3 rows
        counts[code] = n
    return counts


@dataclass
class CharacterModel:
    """Costs -log P(c | a, b) as an array [a, b, c], and the known words, which are equally likely."""

    costs: np.ndarray
    words: tuple[str, ...] = ()

    @staticmethod
    def mixed(counts: np.ndarray, words: list[str]) -> CharacterModel:
        def shares(n: np.ndarray) -> np.ndarray:
            n = n.reshape(_CLASSES, _CLASSES, _CLASSES) + 0.02
            return n / n.sum(axis=2, keepdims=True)

        own = np.zeros(_CLASSES**3)
        for w in words:
            c = [_BOUNDARY, _BOUNDARY, *map(_class, w), _BOUNDARY]
            for a, b, d in zip(c, c[1:], c[2:]):
                own[(a * _CLASSES + b) * _CLASSES + d] += 1
        return CharacterModel(-np.log(0.5 * shares(counts) + 0.5 * shares(own)), tuple(words))


class Restorer:
    """Finds the likeliest words behind a disguised token."""

    def __init__(self, model: CharacterModel):
        self.costs = model.costs.tolist()
        self.ends = set(model.words)
        #: Beginnings of the words that count besides, and the letters that go on from them.
        self.onward = {w[:k] for w in self.ends for k in range(1, len(w) + 1)}
        self.enter = math.log(max(1, len(self.ends)))

    def restore(self, token: str) -> str:
        """Viterbi over (two classes before, letter before, beginning of a known word); ties go to the
        first letter listed.

        A separator is dropped or ends a word: words of the path are set apart by blanks. A word is
        spelled by the character model or is one of the known words. Paths are chains of (path
        before, letter), so that work grows with the length of the token only.
        """
        start = (_BOUNDARY, _BOUNDARY, "", "")
        states: dict[tuple[int, int, str, str], tuple[float, tuple | None]] = {start: (0.0, None)}
        for c in token:
            after: dict[tuple[int, int, str, str], tuple[float, tuple | None]] = {}

            def reach(key, cost, path, letter=""):
                if key not in after or cost < after[key][0]:
                    after[key] = (cost, (path, letter) if letter else path)

            choices = [(c, 0.0)] if c.isalpha() else [(x, COST_SIGN) for x in LOOKALIKES.get(c, "")]
            drops = c in SEPARATORS or c in " " or not choices
            for key, (cost, path) in states.items():
                a, b, before, known = key
                for letter, price in choices:
                    k = _class(letter)
                    if not known:
                        reach((b, k, letter, ""), cost + price + self.costs[a][b][k], path, letter)
                    if (known or not before) and known + letter in self.onward:
                        reach((b, k, letter, known + letter), cost + price + (0.0 if known else self.enter), path, letter)
                    if letter == before:
                        reach(key, cost + price + COST_REPEAT, path)
                if drops:
                    reach(key, cost + COST_DROP, path)
                    if before and (not known or known in self.ends):
                        reach(start, cost + COST_SPLIT + self._end(key), path, " ")
            states = after
        ends = [(cost + self._end(key), path) for key, (cost, path) in states.items() if not key[3] or key[3] in self.ends]
        least = min((cost for cost, _ in ends), default=None)
        return min((_spelled(path) for cost, path in ends if cost == least), default="")

    def _end(self, key: tuple[int, int, str, str]) -> float:
        """The cost of ending a word here; a known word has its end, and nothing needs none."""
        a, b, before, known = key
        return self.costs[a][b][_BOUNDARY] if before and not known else 0.0


def _spelled(path: tuple | None) -> str:
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters)).strip()


def _disguised(core: str) -> bool:
    if len(core) < 3:
        return False
    letters = sum(c.isalpha() for c in core)
    if letters == len(core):
        return _REPEATED.search(core) is not None
    return letters >= 1 and all(c.isalpha() or c in _SIGNS or c in SEPARATORS for c in core)


class Reader:
    """The features of texts: words and beginnings of words, after restoring disguised tokens."""

    def __init__(self, restorer: Restorer | None, wanted: dict[str, int] | None):
        self.restorer, self.wanted = restorer, wanted
        self.known: dict[str, tuple] = {}

    def forms(self, token: str) -> list[str]:
        """The words that a token without blanks stands for."""
        core = token.strip(_EDGE)
        words = [core] if core.isalpha() else [w for w in re.split(r"[\W\d_]+", core) if w]
        if self.restorer is not None:
            for shape in {core, token.rstrip(".,;:?\"'")}:
                if _disguised(shape):
                    words.extend(self.restorer.restore(shape).split())
        return words

    def _features(self, token: str) -> tuple:
        found = set()
        for word in self.forms(token):
            found.add("=" + word)
            found.update("^" + word[:n] for n in PREFIXES if len(word) >= n)
        if self.wanted is None:
            return tuple(found)
        return tuple(sorted(self.wanted[f] for f in found if f in self.wanted))

    def read(self, text: str) -> dict:
        """Features and their weights in a text."""
        low = text.lower()
        tokens = low.split()
        damp = 1 / (1 + DAMPING * len(tokens))
        counts = Counter(tokens)
        if self.restorer is not None:
            counts.update(m[0].replace(" ", ".") for m in _APART.finditer(low))
        out: dict = {}
        known = self.known
        for token, n in counts.items():
            got = known.get(token)
            if got is None:
                got = self._features(token)
                if len(known) >= WORD_MEMORY:
                    known.clear()
                if len(token) <= LONGEST_KNOWN:
                    known[token] = got
            for f in got:
                out[f] = out.get(f, 0) + n
        return {f: min(MOST_WEIGHT, n * damp) for f, n in out.items()}


@dataclass
class ToxicityModel:
    characters: CharacterModel
    features: dict[str, int]
    weights: np.ndarray
    bias: float

    def parts(self) -> tuple:
        """Plain values: executors need not have the package to read them."""
        return (self.characters.costs, self.characters.words), self.features, self.weights, self.bias

    @staticmethod
    def of(parts: tuple) -> ToxicityModel:
        return ToxicityModel(CharacterModel(*parts[0]), *parts[1:])

    def score(self, found: dict) -> float:
        """Each feature counts by its presence and by its weight."""
        if not found:
            return float(sigmoid(np.float64(self.bias)))
        rows, size = list(found), len(self.features)
        return float(sigmoid(self.bias + self.weights[rows].sum() + self.weights[size:][rows] @ list(found.values())))


def _marks(sample: DataFrame) -> list[str]:
    """The features that mark toxic documents of the sample, strongest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, toxic, clean, docs = Reader(None, None), Counter(), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                weights = reader.read(text)
                (toxic if label else clean).update(weights)
                if label:
                    docs.update(weights.keys())
            if len(toxic) + len(clean) > WORD_MEMORY:
                yield rows(toxic, clean, docs)
                toxic.clear(), clean.clear(), docs.clear()
        yield rows(toxic, clean, docs)

    def rows(toxic: Counter, clean: Counter, docs: Counter) -> pa.RecordBatch:
        names = list(toxic.keys() | clean.keys())
        # Whole numbers, so that sums do not depend on their order.
        columns = [pa.array([round(c[n] * 1000) for n in names], pa.int64()) for c in (toxic, clean, docs)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["feature", "toxic", "clean", "docs"])

    sizes = dict(sample.groupBy("label").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return []
    ratio = ((F.col("toxic") + 50) / (n_toxic + 1)) / ((F.col("clean") + 50) / (n_clean + 1))
    counts = sample.select("text", "label").mapInArrow(count, "feature string, toxic long, clean long, docs long")
    counts = counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "docs")])
    counts = counts.where((F.col("docs") >= 1000 * LEAST_DOCS) & (ratio >= LEAST_RATIO))
    strength = F.log(ratio) * F.sqrt("docs")
    return [r.feature for r in counts.orderBy(F.desc(F.round(strength, 6)), "feature").limit(FEATURES).select("feature").collect()]


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> ToxicityModel:
    """A model from labelled documents outside the held-out fold (at most ``most``) and the character
    counts of all documents. Without both classes every text scores the share of toxic labels, 0
    where there are none."""
    sample = training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, most).drop("doc_id")
    features = _marks(sample)
    words = [f[1:] for f in features if f[0] == "="]
    model = ToxicityModel(CharacterModel.mixed(trigram_counts(docs), words), {f: k for k, f in enumerate(features)}, np.zeros(2 * len(features)), 0.0)
    shipped = spark.sparkContext.broadcast((model.characters.costs, model.characters.words, model.features))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, words, wanted = shipped.value
        reader = Reader(Restorer(CharacterModel(costs, words)), wanted)
        for batch in batches:
            found = [sorted(reader.read(t).items()) for t in batch.column("text").to_pylist()]
            rows = [pa.array([[f for f, _ in x] for x in found], pa.list_(pa.int32())), pa.array([[round(w, 3) for _, w in x] for x in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*rows, batch.column("label")], ["found", "weight", "label"])

    # Documents of equal features count together: no more rows than the sample has.
    rows = sample.mapInArrow(read, "found array<int>, weight array<double>, label int").groupBy("found", "weight", "label").count().collect()
    rows.sort(key=lambda r: (list(r.found), list(r.weight), r.label))
    total = sum(r["count"] for r in rows)
    share = sum(r["count"] for r in rows if r.label) / total if total else 0.0
    if not features:
        model.bias = math.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share else -40.0)
        return model
    x = np.zeros((len(rows), 2 * len(features)))
    for k, r in enumerate(rows):
        x[k, list(r.found)] = 1
        x[k, len(features) + np.array(r.found, int)] = r.weight
    y = np.array([r.label for r in rows], float)
    n = np.array([r["count"] for r in rows], float)
    weights, bias = np.zeros(x.shape[1]), math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    state = np.zeros((2, x.shape[1] + 1))
    for step in range(1, 501):
        error = n * (sigmoid(x @ weights + bias) - y) / total
        slope = np.append(x.T @ error + 1e-4 * weights, error.sum())
        state[0] += 0.1 * (slope - state[0])
        state[1] += 0.001 * (slope**2 - state[1])
        move = 0.1 * state[0] / (1 - 0.9**step) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
        # Marks of toxic documents only add to a score.
        weights, bias = np.maximum(0, weights - move[:-1]), bias - move[-1]
    model.weights, model.bias = weights, float(bias)
    return model


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A null text counts as empty; a text without marks has the model's base score. held_out is null
    for a null doc_id. Repeated rows get equal rows; an empty table gives an empty result; other columns
    are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ToxicityModel.of(shipped.value)
        reader = Reader(Restorer(m.characters), m.features)
        for batch in batches:
            scores = [m.score(reader.read(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
    return out.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        m = ToxicityModel.of(shipped.value)
        reader = Reader(Restorer(m.characters), m.features)
        return pd.Series([m.score(reader.read(t)) for t in texts], dtype="float64")

    return docs.where(score(text_of()) < THRESHOLD)
