"""Registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.llm import bpe, chat, decontaminate, exact, mixing, neighbours, prints, quality, repair, secret_scan, suffixes, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encoded(_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"))


def op4_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(table.unionByName(more))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(spark, docs, _table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(spark, docs, _table(spark, sf_dir, "labels")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.document_fingerprints(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(_table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damaged(_table(spark, sf_dir, "conversations"))
    return repair.repaired(damaged).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (op1_bpe_chunks, op2_exact_dedup, op3_secret_scan, op4_simhash_vantage, op5_chat_format, op6_quality, op7_toxicity, op8_suffix_dedup, op9_document_fingerprints, op10_mix_sources, op11_whitening, op12_decontaminate, op13_repair)
}

_FLAT = r"regexp_replace(coalesce(text, ''), '[ \x09-\x0d]', '', 'g')"
_CHAT = """
    (SELECT conv_id, turn, role, text FROM conversations
     UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
     UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')"""

ORACLES = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, {_FLAT} AS flat FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY flat) AS group_size,
          doc_id = first_value(doc_id) OVER w AS kept, sha256(flat) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY flat ORDER BY n DESC, doc_id)""",
    "op5_chat_format": chat.conversation_digests_sql(_CHAT),
    "op10_mix_sources": f"""
        {mixing.mixture_sql()}
        SELECT doc_id, m_source AS source, m_lang AS lang, m_topic AS topic, m_n_tokens AS n_tokens,
          round(m_weight, 9) AS weight, m_probability AS probability, m_kept AS kept FROM drawn""",
    "op12_decontaminate": decontaminate.contaminated_sql(),
    "op13_repair": repair.repaired_sql(),
}
