import zlib

import numpy as np
import pytest

from hushtrack.llm import quality, toxicity
from hushtrack.llm.toxicity import CharacterModel, Reader, Restorer, trigram_counts

SF = "/root/testdata/sf0.01"


def restorer(spark):
    words = ["idiot", "stupid", "moron", "loser", "disgusting"]
    docs = spark.createDataFrame([(1, "the plain words of an ordinary text " * 20)], "doc_id long, text string")
    return Restorer(CharacterModel.mixed(trigram_counts(docs), words))


@pytest.mark.parametrize(
    "token, word",
    [("1d10t", "idiot"), ("st0pid", "stopid"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"), ("idiooot", "idiot"), ("d1sgu5t1ng", "disgusting"), ("$tup1d", "stupid"), ("l-0-5-3-r", "loser")],
)
def test_viterbi(spark, token, word):
    assert restorer(spark).restore(token) == word


def test_reader(spark):
    reader = Reader(restorer(spark), {"=idiot": 0, "=loser": 1, "^mor": 2})
    assert set(reader.read("you 1d10t! L 0 s e r and M0R0NS")) == {0, 1, 2}
    assert reader.read("an ordinary text, with 12 words and aaaa1 :-)") == {}
    assert reader.read("") == {}


@pytest.mark.parametrize(
    "run, words",
    [("a s t u p i d", "a stupid"), ("I m o r o n", "i moron"), ("a l o s e r a n d", "loser"), ("y o u a r e a s t u p i d", "stupid"), ("i d i o t l o s e r", "idiot loser"), ("a 1 d 1 0 t", "a idiot")],
)
def test_runs_of_several_words(spark, run, words):
    reader = Reader(restorer(spark), {"=" + w: k for k, w in enumerate(words.split())})
    assert set(reader.read(f"you are {run}  fool")) == set(range(len(words.split())))
    assert reader.restorer.restore("w-o-r-d") == "word"


def test_long_runs(spark):
    reader = Reader(restorer(spark), {"=idiot": 0, "=disgusting": 1, "^plai": 2})
    apart = " ".join("theplainwordsofanordinarytextidiot")  # 67 characters: over 40
    assert set(reader.read(apart)) >= {0}
    assert set(reader.read(" ".join("theplainwordsofanordinarytext" * 9 + "idiot"))) >= {0}
    assert set(reader.read("-".join("disgusting" + "ordinarytext" * 3))) >= {1}
    assert reader.read("0a" * 30_000) == {}


def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


def accuracy(rows, labels, label, share):
    known = {r.doc_id: r[label] for r in labels.collect()}
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert held and sum(p == y for p, y in held) / len(held) >= share
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity(spark, messy, messy_rows, nothing):
    docs, labels = tables(spark)
    model = toxicity.fit(spark, docs, labels)
    rows = toxicity.scored(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    accuracy(rows, labels, "toxic", 0.93)
    assert toxicity.scored(messy, model).count() == len(messy_rows)
    kept = toxicity.clean(messy, model)
    assert kept.columns == messy.columns and kept.count() == len(messy_rows)
    assert toxicity.scored(nothing, model).count() == 0
    blank = toxicity.fit(spark, nothing, labels.where("false"))
    assert {r.score for r in toxicity.scored(messy, blank).collect()} == {float(toxicity.sigmoid(np.float64(-40)))}


def test_quality(spark, messy, messy_rows, nothing):
    docs, labels = tables(spark)
    model = quality.fit(spark, docs, labels)
    rows = quality.scored(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    accuracy(rows, labels, "quality", 0.95)
    assert quality.scored(messy, model).count() == len(messy_rows)
    assert quality.scored(nothing, model).count() == 0
    blank = quality.fit(spark, nothing, labels.where("false"))
    assert {round(r.score, 6) for r in quality.scored(messy, blank).collect()} == {0.5}
