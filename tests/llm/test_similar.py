import random

import numpy as np

import corpus_pipeline
from hushtrack.llm import similar


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def slow_kept(rows):
    """doc_ids that stay, by comparing all pairs."""
    sets = [slow_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for k, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(doc_id)
    return sorted(min(d for d in g if d is not None) for g in groups.values() if any(d is not None for d in g))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_stage_is_brute_force_jaccard(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    passage, texts = say(40), []
    for n in (5, 6, 14, 60, 120, 300):
        for _ in range(6):
            base = say(n)
            texts += [base, base.upper(), *[edited(rng, base, rng.randint(1, max(2, n // 25))) for _ in range(4)]]
    texts += [f"{passage} {say(k % 12)}" for k in range(60)]  # a passage that is most of each text
    chain = say(100)
    for _ in range(12):  # each is near the one before only
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += ["", " \n", None, "a b"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string").repartition(5)
    for got in (corpus_pipeline.drop_near_copies(spark, docs, ""), similar.one_of_each(docs, sample=0)):
        assert got.columns == docs.columns
        assert sorted(r.doc_id for r in got.collect()) == slow_kept(rows)


def test_boundary(spark):
    """8 of 10 shingles in common are enough, 7 of 9 are not."""
    words = [f"w{k}" for k in range(12)]
    at = [(1, " ".join(words[:12])), (2, " ".join(words[:12] + ["x", "y"]))]  # 8 of 10
    under = [(3, " ".join("u" + w for w in words[:11])), (4, " ".join(["u" + w for w in words[:11]] + ["x", "y"]))]  # 7 of 9
    docs = spark.createDataFrame(at + under, "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.one_of_each(docs).collect()) == [1, 3, 4]


def test_messy_rows(messy, messy_rows, nothing):
    kept = similar.one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == slow_kept([r[:2] for r in messy_rows])
    assert similar.one_of_each(nothing).count() == 0


def test_near_fingerprints_are_paired_by_the_trees(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(200)) for _ in range(12)]
    texts += [edited(rng, t, k % 3) for k in range(6) for t in texts[:12]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {similar._node(h): h for h in map(similar.shingle_set, texts)}
    prints = {np.uint64(node).astype(np.int64).item(): similar.simhash(h) for node, h in sets.items()}

    def components(links):
        root = {n: n for n in prints}
        for a, b in links:
            old, new = root[b], root[a]
            root = {n: new if r == old else r for n, r in root.items()}
        groups = {}
        for n, r in root.items():
            groups.setdefault(r, set()).add(n)
        return sorted(map(sorted, groups.values()))

    near = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= 3
    want = components((a, b) for a in prints for b in prints if near(prints[a], prints[b]))
    assert len(want) < len(prints)
    for most in (similar.SAME_PRINT, 0):  # fingerprints of many nodes, and of few
        monkeypatch.setattr(similar, "SAME_PRINT", most)
        with similar.Scratch(spark) as keep:
            pairs = similar.near_prints(keep(similar.nodes_of(docs), "nodes"), keep).collect()
        assert components((r.a, r.b) for r in pairs) == want


def test_stage_takes_what_the_trees_find(spark, monkeypatch):
    rng = random.Random(6)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(1500))
    texts = [base, edited(rng, base, 1), edited(rng, base, 2), "quite another text of some words"]
    assert bin((similar.simhash(similar.shingle_set(texts[0])) ^ similar.simhash(similar.shingle_set(texts[1]))) & (1 << 64) - 1).count("1") <= 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    none = similar._prefixes
    monkeypatch.setattr(similar, "_prefixes", lambda *a: none(*a).where("false"))  # no other candidates
    assert 1 not in [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
