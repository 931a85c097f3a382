"""A corpus prepared for training: five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a
DataFrame; ``run`` writes each as Parquet to the shared folder and rereads it as the next one's docs.

In all stages a null text counts as empty, texts of any length are taken whole, an empty table gives an
empty one, and columns beside doc_id, text, lang and source are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushtrack.llm import bpe, exact, mixing, similar, toxicity
from hushtrack.llm.common import shared
from hushtrack.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; labels come from the labels table.

    A row is judged by its text alone, so repeated rows stay or go together, and rows without a doc_id
    are judged like others. Without any labels nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(spark, docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays: the longest, then the one with the smallest doc_id (null last)."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Links join texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8. Of rows
    that repeat a doc_id one stays; a row without a doc_id stays only if nothing in its group has one.
    """
    return similar.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics have their target weights.

    A null source or language is a group of its own. A document is drawn by its doc_id, so repeated rows
    stay or go together.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the decoded text; one row per row."""
    out = bpe.encoded(docs, tokenizer_path())
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: A model is fitted in the first stage and similar texts are linked in the third: SQL cannot express
#: them; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared(stage(spark, docs, sf_dir), name)
    return docs
