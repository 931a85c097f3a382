import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from hushtrack.llm.prints import MAX_WEIGHT, document_fingerprints, near_counts


def slow_print(text):
    ones, total = [0] * 64, 0
    for term in re.split(r"[ \t\n\x0b\f\r]+", text):
        weight, h = min(len(term), MAX_WEIGHT), xxhash.xxh64_intdigest(term.encode(), 42)
        total += weight
        for b in range(64):
            ones[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > total)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints(messy, messy_rows):
    same = {(d, t or "") for d, t, *_ in messy_rows}
    order = sorted(same, key=lambda r: (r[0] is None, -(r[0] or 0), -signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    want, prints = {}, {}
    for k, (doc_id, text) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + follower[:n]
        p, e, q = slow_print(text), slow_print(edited), slow_print(follower)
        alike = lambda a, b: 1 - bin(a ^ b).count("1") / 64
        prints[doc_id, text] = p
        want[doc_id, text] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{p:016x}", f"{e:016x}", alike(p, e), alike(p, q))
    rows = [(d, t or "") for d, t, *_ in messy_rows]
    near = lambda p: sum(bin(p ^ prints[r]).count("1") <= 3 for r in rows)
    expected = [(r[0], *want[r], near(prints[r]) if r[0] is not None and r[0] % 20 == 0 else None) for r in rows]
    got = document_fingerprints(messy).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_tables_find_all_within_radius(spark):
    base = 0x0123456789ABCDEF
    values = [base, base ^ 1, base ^ 0b111, base ^ 0b1111, base ^ (1 << 63 | 1 << 40 | 1 << 20), base ^ (1 << 63 | 1 << 40 | 1 << 20 | 1)]
    prints = spark.createDataFrame([(signed(v), 2) for v in values], "bits long, n long")
    got = {r.bits: r.near_docs for r in near_counts(prints, prints).collect()}
    for v in values:
        assert got[signed(v)] == 2 * sum(bin(v ^ w).count("1") <= 3 for w in values)


def test_one_and_none(messy, nothing):
    one = messy.where("doc_id = 1")
    row = document_fingerprints(one).first()
    assert row.near_next == 1.0
    assert document_fingerprints(nothing).count() == 0
    assert document_fingerprints(one.withColumn("text", F.lit(None).cast("string"))).first().fingerprint == "0" * 16
