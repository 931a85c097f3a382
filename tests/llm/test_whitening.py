import math

import numpy as np
import pytest

from hushtrack.llm import whitening
from hushtrack.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, x string, w string, count string, y string"


def table(spark, vectors, parts=4):
    return spark.createDataFrame([(k, v, "?", "?", "?", "?") for k, v in vectors], SCHEMA).repartition(parts)


def slow(vectors, weights="counts", components=8):
    """Rows (vec_id, component): exact deviation and the direct transformation of every row."""
    good = [(k, v) for k, v in vectors if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    x = np.array([[math.floor(1024 * float(np.float32(e))) + 100000 for e in v] for _, v in good])
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(values)[::-1][:components]
    y = (x - s / n) @ vectors[:, order] / np.sqrt(values[order])
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return [k for k, _ in good], n, deviation, y, values[order] / values.sum()


def check(out, vectors, **options):
    ids, n, deviation, y, explained = slow(vectors, **options)
    rows = sorted(out.collect(), key=lambda r: (r.vec_id is not None, r.vec_id, r.whitened))
    assert len(rows) == len(ids) * y.shape[1]
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, []).append(r)
    sign = None
    for k, d, row in zip(ids, deviation, y):
        mine = {r.component: r for r in got[k]}
        assert all(r.n == n and r.deviation == d and r.identity_error < 1e-4 for r in got[k])
        values = np.array([mine[c + 1].whitened for c in range(len(row))])
        big = np.abs(row) > 1e-3
        if sign is None and big.all():
            sign = np.sign(values * row)
        if sign is not None:
            assert np.allclose(values, sign * row, atol=1e-6)
        assert np.allclose([mine[c + 1].explained for c in range(len(row))], explained, rtol=1e-9)
    assert sign is not None


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    scale = np.geomspace(1, 0.05, 12)
    rows = [(k, (rng.normal(size=12) * scale).astype(np.float32).tolist()) for k in range(300)]
    hot = rows[7][1]
    rows += [(1000 + k, hot) for k in range(150)]  # a third of the rows have one vector
    bad = rows[0][1]
    rows += [(2000, None), (2001, [None, *bad[1:]]), (2002, [float("nan"), *bad[1:]]), (2003, [float("inf"), *bad[1:]]), (2004, [-float("inf"), *bad[1:]])]
    return rows


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_brute_force(spark, vectors, weights):
    check(whitening.whitened(table(spark, vectors), weights=weights), vectors, weights=weights)


def test_hot_vectors_are_broadcast(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "FREQUENT", 10)
    out = whitening.whitened(table(spark, vectors))
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    check(out, vectors)


def test_repeated_rows_and_null_ids(spark, vectors):
    rows = [*vectors[:40], vectors[3], vectors[3], (None, vectors[5][1])]
    out = whitening.whitened(table(spark, rows))
    assert out.where("vec_id = 3").count() == 3 * 8 and out.where("vec_id is null").count() == 8
    assert out.select("n").distinct().collect() == [(43,)]


def test_degenerate(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, None)])).count() == 0
    one = whitening.whitened(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(2, 0, 0.0, 0.0, 0.0)} and len(one) == 4
    mixed = whitening.whitened(table(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0]), (4, [])]))
    assert sorted({r.vec_id for r in mixed.collect()}) == [1, 2]
    huge = whitening.whitened(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])]))
    assert {r.vec_id: r.deviation for r in huge.collect()}.keys() == {1, 2, 3} and huge.where("vec_id < 3 and deviation is null").count() == 4
    with pytest.raises(ValueError, match="weights"):
        whitening.whitened(table(spark, []), weights="some")


def test_query(spark):
    out = op11_whitening(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(out, rows)
