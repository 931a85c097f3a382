import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from hushtrack.llm import neighbours
from hushtrack.llm.common import lowest_per_component, shared
from hushtrack.llm.neighbours import fingerprint, near_duplicates, near_links, one_of_each


def slow_print(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius):
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(k) for k in range(len(values))]


def test_fingerprints(messy_rows):
    for _, text, *_ in messy_rows:
        assert fingerprint(text or "") & (1 << 64) - 1 == slow_print(text)


def test_near_duplicates(messy, messy_rows):
    rows = sorted(messy_rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [slow_print(r[1]) for r in rows]
    want = [(r[0], f"{p:016x}", rows[c][0]) for r, p, c in zip(rows, prints, components(prints, 3))]
    got = near_duplicates(messy, shard=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, near_duplicates(messy).collect()), key=str) == sorted(want, key=str)
    kept = one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({c for *_, c in want if c is not None})


def test_dense_groups_and_small_shards(spark):
    """Chains and balls of close fingerprints, however the tree cuts them."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for centre in list(values)[:6]:
        for _ in range(40):
            near = centre
            for _ in range(rng.randint(1, 4)):
                near ^= 1 << rng.randrange(64)
            values.add(near)
    values = sorted(values)
    table = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "bits long").repartition(3)
    root = components(values, 3)
    for options in ({}, {"shard": 8}, {"shard": 2, "sample": 40}):
        links = near_links(table, 3, **options)
        found = {r.node: r.root for r in lowest_per_component(links).collect()}
        signed = [int(np.uint64(v).view(np.int64)) for v in values]
        groups = {}
        for k, v in enumerate(signed):
            groups.setdefault(found.get(v, v), set()).add(root[k])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(root))


def test_rows_dealt_grow_with_the_table(spark, monkeypatch):
    """Each fingerprint goes to four shards, however many there are."""
    dealt = []
    monkeypatch.setattr(neighbours, "shared", lambda df, name: dealt.append((name, kept := shared(df, name))) or kept)
    rng = random.Random(4)
    for n in (400, 2000):
        table = spark.createDataFrame([(rng.getrandbits(64) - (1 << 63),) for _ in range(n)], "bits long")
        near_links(table, 3, shard=16).collect()
    sums = [df.select([F.sum(c) for c in df.columns if c != "leaf"]).first() for name, df in dealt if name == "shards"]
    assert [max(r) / n for r, n in zip(sums, (400, 2000))] == [4, 4]


def test_empty(nothing):
    assert near_duplicates(nothing).count() == 0
    assert one_of_each(nothing).count() == 0
