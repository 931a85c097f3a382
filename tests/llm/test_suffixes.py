import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hushtrack.llm import suffixes
from hushtrack.llm.loser_tree import merge, prefixes
from hushtrack.llm.suffixes import GRAM, LENGTH, anchors, front_coded, front_decoded, without_repeats


def expected(rows):
    """rows: (order, key, bytes) with order None last; strings of equal orders do not count."""
    first = {}
    for order, data in rows:
        for k in range(len(data) - LENGTH + 1):
            s = data[k : k + LENGTH]
            first[s] = min(first.get(s, order), order)
    out = []
    for order, data in rows:
        mark = bytearray(len(data))
        for k in range(len(data) - LENGTH + 1):
            if first[data[k : k + LENGTH]] < order:
                mark[k : k + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for k, m in enumerate(mark) if m and (k == 0 or not mark[k - 1]))
        out.append((len(data), sum(mark), spans, bytes(b for b, m in zip(data, mark) if not m)))
    return out


def test_against_brute_force(messy, messy_rows):
    rows = [(10**9 if r[0] is None else r[0], (r[1] or "").encode()) for r in messy_rows]
    want = sorted(expected(rows))
    got = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in without_repeats(messy).collect()]
    assert sorted(got) == want
    assert sum(w[1] for w in want) > 1000


def test_overlaps_shifted_and_periodic(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcd é") for _ in range(400))
    docs = [(5, text), (4, text[100:160]), (9, text[:55] + text[90:300]), (3, "ab" * 90), (8, "xab" + "ab" * 40), (7, text[30:79]), (6, text[30:80])]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = [(d, t.encode()) for d, t in docs]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in without_repeats(table).collect()}
    assert got == {d: w for (d, _), w in zip(rows, expected(rows))}


def test_empty(nothing):
    assert without_repeats(nothing).count() == 0


@pytest.mark.parametrize("runs", [2, 5, 300])
def test_merge_in_many_lanes(runs):
    rng = np.random.default_rng(runs)
    keys = np.zeros((20_000, 32), np.uint8)
    keys[:, :GRAM] = rng.integers(0, 3, (20_000, GRAM)) * (rng.random((20_000, GRAM)) < 0.2)
    keys[::7] = keys[0]
    words = np.ascontiguousarray(keys).view(">u8").astype(np.uint64).T
    owner = rng.integers(0, runs, len(keys))
    parts = []
    for r in range(runs):
        own = words[:, owner == r]
        parts.append(own[:, np.lexsort(own[::-1])])
    starts = np.concatenate(([0], np.cumsum([p.shape[1] for p in parts])))
    order, common = merge(np.concatenate(parts, axis=1), np.concatenate([prefixes(p, GRAM) for p in parts]), starts, GRAM)
    merged = np.concatenate(parts, axis=1)[:, order]
    assert sorted(order.tolist()) == list(range(len(keys)))
    assert (merged == words[:, np.lexsort(words[::-1])]).all()
    assert (common == prefixes(merged, GRAM)).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=0, max_size=4), max_size=60), min_size=1, max_size=9))
def test_merge(runs):
    columns = []
    for run in runs:
        raw = np.zeros((len(run), 32), np.uint8)
        for k, key in enumerate(run):
            raw[k, 10 : 10 + len(key)] = list(key)
        words = np.ascontiguousarray(raw.view(">u8").astype(np.uint64).T)
        columns.append(words[:, np.lexsort(words[::-1])])
    words = np.concatenate(columns, axis=1)
    starts = np.cumsum([0] + [c.shape[1] for c in columns])
    lcp = np.concatenate([prefixes(c, GRAM) for c in columns])
    order, common = merge(words, lcp, starts, GRAM)
    want = words[:, np.lexsort(words[::-1])]
    assert (words[:, order] == want).all()
    assert (common == prefixes(want, GRAM)).all() and sorted(order) == list(range(words.shape[1]))
    for c in columns:
        own = prefixes(c, GRAM)
        assert (front_decoded(own, front_coded(c, own)) == c).all()


@pytest.mark.parametrize("text", [b"a" * 200, bytes(range(256)) * 2, b"abc " * 40, b"x" * 49])
def test_every_string_has_one_anchor_inside(text):
    raw = np.frombuffer(text, np.uint8)
    at, lo, hi = anchors(raw, np.array([0]), np.array([len(raw)]))
    starts = [s for a, b in zip(lo, hi) for s in range(a, b + 1)]
    assert starts == list(range(len(text) - LENGTH + 1))
    assert all(b <= a and a + GRAM <= lo_ + LENGTH for a, lo_, b in zip(at, lo, hi))


def test_only_keys_of_equal_first_words_are_sorted_by_all_words(monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 100, 5_000, dtype=np.uint8)
    at = rng.integers(0, len(raw) - suffixes.GRAM + 1, 20_000)
    words = suffixes._words(raw, at)
    assert words[0, 0].item().to_bytes(8) + words[3, 0].item().to_bytes(8) == raw[at[0] :][:8].tobytes() + raw[at[0] + 24 :][:4].tobytes() + bytes(4)
    assert (suffixes._in_order(words) == np.lexsort(words[::-1])).all()
    apart = np.stack([rng.permutation(1_000).astype(np.uint64)] * 4)
    lexsort, sizes = np.lexsort, []
    monkeypatch.setattr(np, "lexsort", lambda keys: sizes.append(np.shape(keys)[1]) or lexsort(keys))
    assert (suffixes._in_order(apart) == np.argsort(apart[0])).all() and sizes == [0]
