import random
import re

import pytest
from pyspark.sql import functions as F

from hushtrack.llm import decontaminate
from hushtrack.llm.queries import op12_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow(docs, items, window):
    """(n_words, covered words, items, text without spans) of each document."""
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + window]), set()).add(item)
    out = []
    for _, text in docs:
        found = list(WORD.finditer(lower(text)))
        words = [m.group() for m in found]
        hit, names = set(), set()
        for k in range(len(words)):
            for m in range(1, window + 1):
                if tuple(words[k : k + m]) in windows and k + m <= len(words):
                    hit |= set(range(k, k + m))
                    names |= windows[tuple(words[k : k + m])]
        cut, text = set(), text or ""
        for k in hit:
            cut |= set(range(found[k].start(), found[k + 1].start() if k + 1 in hit else found[k].end()))
        rest = "".join(c for i, c in enumerate(text) if i not in cut)
        out.append((len(words), hit, sorted(str(n) for n in names if n is not None), rest))
    return out


def table(rng, size):
    say = lambda n: " ".join(rng.choice(["ab", "Cd", "é", "ÉÀ", "x9", "ß", "the", "😀"]) for _ in range(n))
    items = [(k, say(rng.randint(1, 14))) for k in range(12)] + [(3, say(5)), (None, say(9)), (50, None), (51, " .,"), (52, "ZZ top")]
    docs = []
    for k in range(size):
        parts = [say(rng.randint(0, 30)), rng.choice(items)[1] or "", say(rng.randint(0, 9)), (rng.choice(items)[1] or "").upper().replace(" ", "\n-")]
        docs.append((k, rng.choice([" ", ", ", "\t"]).join(parts)))
    docs += [(900, None), (901, ""), (902, "..."), (903, say(4000)), (904, "the " * 500), (905, "q" * 5000 + " " + say(40)), docs[0], docs[0], (None, docs[1][1])]
    return docs, items


def spans_of(words):
    return [list(range(a, b)) for a, b in words]


@pytest.mark.parametrize("window,options", [(4, {}), (4, {"phrase_bytes": 300, "shard_bytes": 600}), (1, {"shard_bytes": 300}), (10, {"shard_bytes": 200})])
def test_brute_force(spark, window, options):
    docs, items = table(random.Random(window), 60)
    left = spark.createDataFrame([(*d, "?", "?") for d in docs], "doc_id long, text string, row string, shard string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contaminated_spans(left, right, window=window, **options)
    assert out.columns == ["doc_id", "n_words", "spans", "items"]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, tuple((s.first_word, s.end_word) for s in r.spans), tuple(r.items)) for r in out.collect())
    want = []
    for (doc_id, _), (n, hit, names, _) in zip(docs, slow(docs, items, window)):
        edges = sorted(hit)
        spans, at = [], 0
        while at < len(edges):
            end = at
            while end + 1 < len(edges) and edges[end + 1] == edges[end] + 1:
                end += 1
            spans.append((edges[at], edges[end] + 1))
            at = end + 1
        want.append((doc_id is not None, doc_id or 0, n, tuple(spans), tuple(names)))
    assert got == sorted(want)


def test_cleaned(spark):
    docs, items = table(random.Random(9), 40)
    docs = [d for d in dict((d[0], d) for d in docs).values() if d[0] is not None]
    left = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_chars long")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.cleaned(left, right, window=4).collect()}
    for (doc_id, text), (_, hit, _, rest) in zip(docs, slow(docs, items, 4)):
        assert got[doc_id] == (rest if hit else text)
    with pytest.raises(ValueError, match="unique"):
        decontaminate.cleaned(left.union(left), right, window=4)


def test_nothing(spark, messy, nothing):
    items = spark.createDataFrame([(1, "the of erth")], "item_id long, text string")
    assert decontaminate.contaminated_spans(nothing, items).count() == 0
    out = decontaminate.contaminated_spans(messy, items.limit(0))
    assert out.count() == messy.count() and out.where(F.size("spans") > 0).count() == 0
    assert decontaminate.contaminated_spans(messy, items).where(F.size("items") > 0).count() > 0


def test_query(spark):
    out = op12_decontaminate(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
