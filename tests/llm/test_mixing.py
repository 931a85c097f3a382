import duckdb

from hushtrack.llm.mixing import MARGINS, Targets, described, mixed, mixture, mixture_sql


def test_marginals_and_calibration(messy, messy_rows):
    targets = Targets(rounds=40)
    rows = mixture(messy, targets).collect()
    assert len(rows) == len(messy_rows)
    cells = {(r.source, r.lang, r.topic): r.weight for r in rows}
    total = sum(r.n_tokens for r in rows)
    for m in MARGINS:
        share = {}
        for r in rows:
            share[r[m]] = share.get(r[m], 0) + r.n_tokens / total
        scale = sum(s**0.7 for s in share.values())
        for value, s in share.items():
            got = sum(w for c, w in cells.items() if c[MARGINS.index(m)] == value)
            assert abs(got - s**0.7 / scale) < 2e-3, (m, value)
    kept = sum(r.n_tokens * r.probability for r in rows) / total
    assert abs(kept - targets.keep) < 1e-6
    assert all(0 <= r.probability <= 1 for r in rows)


def test_against_sql(messy, messy_rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", messy_rows)
    want = db.execute(mixture_sql() + " SELECT doc_id, m_source, m_lang, m_topic, m_n_tokens, round(m_weight, 6), round(m_probability, 6), m_kept FROM drawn").fetchall()
    got = [(*tuple(r)[:5], round(r.weight, 6), round(r.probability, 6), r.kept) for r in mixture(messy).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = mixed(messy)
    assert kept.columns == messy.columns
    assert kept.count() == sum(r[-1] for r in want)


def test_empty(nothing):
    assert mixture(nothing).count() == 0
    assert mixed(nothing).count() == 0
    assert described(nothing).count() == 0
