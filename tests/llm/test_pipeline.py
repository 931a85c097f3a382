import hashlib

import corpus_pipeline
from hushtrack.llm import queries


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = corpus_pipeline.shared(stage(spark, docs, sf_dir), name)
        assert docs.columns == names
        after = [r.doc_id for r in docs.collect()]
        assert len(after) == len(set(after)) and set(after) <= before
        if name == "toxicity":
            clean = {d for d in before if labels.get(d) == 0}
            assert len(clean - set(after)) <= 0.05 * len(clean)
        if name == "exact_dedup":
            flat = ["".join(texts[d].split()) for d in before]
            assert len(after) == len(set(flat))
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(after)
    assert all(len(r.ids_sha256) == len(hashlib.sha256().hexdigest()) for r in out)


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)
