import hashlib
import re

import pytest
from pyspark.sql import functions as F

from hushtrack.llm.exact import drop_exact_duplicates, exact_groups


def expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        flat = re.sub(r"[\x20\x09-\x0d]", "", text or "")
        groups.setdefault(flat, []).append((doc_id, len(text or "")))
    out = []
    for flat, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        sha = hashlib.sha256(flat.encode()).hexdigest()
        out += [(d, best[0], len(members), sha) for d, _ in members]
    return sorted(out, key=str), len(groups)


# Blocks of a few characters take many levels; a hash of few values makes blocks collide.
@pytest.mark.parametrize("options", [{}, {"block_chars": 3}, {"block_chars": 4, "block_hash": lambda c: F.pmod(F.xxhash64(c), F.lit(5))}])
def test_groups(messy, messy_rows, options):
    got = exact_groups(messy, **options).collect()
    want, n_groups = expected(messy_rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    assert sum(r.kept for r in got) == n_groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop(messy, messy_rows):
    kept = drop_exact_duplicates(messy)
    assert kept.columns == messy.columns
    flat = [re.sub(r"[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()]
    assert len(flat) == len(set(flat)) == expected(messy_rows)[1]


def test_empty(nothing):
    assert exact_groups(nothing).count() == 0
    assert drop_exact_duplicates(nothing).count() == 0
