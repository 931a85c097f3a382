"""Mixing sources to target weights (operator 10), DataFrame operations only.

Iterative proportional fitting: token weights of the cells (source, language, topic) are raked to the
target marginals in turn until they meet all of them, and documents are then sampled with the
probabilities that turn the present weights into those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.llm.common import BLANKS, shared, text_of, unit_hash, without_blanks

MARGINS = ("source", "lang", "topic")
#: A text has the topic of the first rule one of whose strings it contains, else the last topic.
TOPICS = (("license", ("icensed under", "ll rights reserved")), ("contact", ("@",)), ("table", (" | ",)), ("shouting", ("!!",)))
OTHER_TOPIC = "prose"
NO_VALUE = "(none)"
_ROUNDS_PER_WRITE = 3
_CALIBRATIONS = 12


@dataclass(frozen=True)
class Targets:
    """Target share of a value: its present share to this power, rescaled to sum to one.

    1 keeps a marginal as it is, 0 makes its values equal; between, large sources are damped.
    """

    source: float = 0.7
    lang: float = 0.7
    topic: float = 0.7
    rounds: int = 12
    #: Expected share of all tokens that is kept.
    keep: float = 0.8


def topic_of(text: Column) -> Column:
    topic = F.lit(OTHER_TOPIC)
    for name, strings in reversed(TOPICS):
        found = F.contains(text, F.lit(strings[0]))
        for s in strings[1:]:
            found = found | F.contains(text, F.lit(s))
        topic = F.when(found, F.lit(name)).otherwise(topic)
    return topic


def described(docs: DataFrame, prefix: str = "") -> DataFrame:
    """docs with source, lang, topic (a null as "(none)") and n_tokens: blanks in the text plus one."""
    text = text_of()
    return docs.withColumns(
        {
            f"{prefix}source": F.coalesce(F.col("source"), F.lit(NO_VALUE)),
            f"{prefix}lang": F.coalesce(F.col("lang"), F.lit(NO_VALUE)),
            f"{prefix}topic": topic_of(text),
            f"{prefix}n_tokens": (F.length(text) - F.length(without_blanks(text)) + 1).cast("long"),
        }
    )


def raked(cells: DataFrame, targets: Targets) -> DataFrame:
    """Cells (source, lang, topic, tokens) with share, weight (both sum to one) and probability.

    Probabilities are in proportion to weight / share, cut at one, and calibrated so that the
    expected share of the tokens kept is the target: what the cut loses the other cells make up for.
    """
    total = _first(cells.agg(F.sum("tokens")))
    cells = cells.withColumn("share", F.col("tokens") / F.lit(total))
    for m in MARGINS:
        power = getattr(targets, m)
        values = cells.groupBy(m).agg(F.pow(F.sum("share"), F.lit(power)).alias("_t"))
        scale = _first(values.agg(F.sum("_t")))
        cells = cells.join(values.withColumn(f"t_{m}", F.col("_t") / F.lit(scale)).drop("_t"), m)
    cells = shared(cells.withColumn("weight", F.col("share")), "cells")
    for k in range(targets.rounds):
        for m in MARGINS:
            now = F.sum("weight").over(Window.partitionBy(m))
            cells = cells.withColumn("weight", F.col("weight") * F.col(f"t_{m}") / now)
        if (k + 1) % _ROUNDS_PER_WRITE == 0 or k + 1 == targets.rounds:
            cells = shared(cells, "raked")
    ratio = F.col("weight") / F.col("share")
    factor = targets.keep
    for _ in range(_CALIBRATIONS):
        sure = ratio * factor >= 1
        parts = cells.agg(F.sum(F.when(sure, F.col("share"))), F.sum(F.when(~sure, F.col("weight")))).first()
        if not parts or not parts[1]:
            break
        factor = max(targets.keep - float(parts[0] or 0.0), 0.0) / float(parts[1])
    return cells.withColumn("probability", F.round(F.least(F.lit(1.0), ratio * factor), 9))


def _first(df: DataFrame) -> float:
    return float(df.first()[0] or 1.0)


def _drawn(docs: DataFrame, targets: Targets, prefix: str) -> DataFrame:
    docs = described(docs, prefix)
    names = [prefix + m for m in MARGINS]
    cells = docs.groupBy(*names).agg(F.sum(f"{prefix}n_tokens").alias("tokens"))
    # Written first: everything below reads the cells, and none of it the documents again.
    cells = shared(cells.select(*[F.col(prefix + m).alias(m) for m in MARGINS], "tokens"), "counted")
    cells = raked(cells, targets)
    cells = cells.select(
        *[F.col(m).alias(prefix + m) for m in MARGINS],
        F.col("weight").alias(f"{prefix}weight"),
        F.col("probability").alias(f"{prefix}probability"),
    )
    draw = unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_VALUE)))
    return docs.join(cells, names).withColumn(f"{prefix}kept", draw < F.col(f"{prefix}probability"))


def mixture(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, kept.

    weight is the raked share of the document's cell in all tokens; a document is kept if a number
    in [0, 1) derived from its doc_id is below the cell's probability, which is in proportion to the
    raked over the present weight. Rows that repeat a doc_id in one cell are
    kept or dropped together, null doc_ids likewise. A null source or language is a value of its
    own, a null text is empty (one token). An empty table gives an empty result.
    """
    # Only these columns matter, so others may have any name.
    docs = docs.select("doc_id", "text", "source", "lang")
    out = _drawn(docs, targets, "m_")
    return out.select(
        "doc_id",
        *[F.col(f"m_{m}").alias(m) for m in MARGINS],
        F.col("m_n_tokens").alias("n_tokens"),
        F.round("m_weight", 9).alias("weight"),
        F.col("m_probability").alias("probability"),
        F.col("m_kept").alias("kept"),
    )


def mixed(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps, with all their columns."""
    return _drawn(docs, targets, "_mixing_").where("_mixing_kept").select(*docs.columns)


def mixture_sql(documents: str = "documents", targets: Targets = Targets()) -> str:
    """The same in DuckDB's SQL, as WITH clauses ending in ``drawn`` (all columns of documents too)."""
    blanks = "[" + "".join({" ": " "}.get(c, f"\\x{ord(c):02x}") for c in BLANKS) + "]"
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(x, '{s}')" for s in strings) + f" THEN '{name}'" for name, strings in TOPICS
    )
    steps = [
        f"described AS (SELECT *, coalesce(source, '{NO_VALUE}') AS m_source, coalesce(lang, '{NO_VALUE}') AS m_lang, "
        f"CASE {cases} ELSE '{OTHER_TOPIC}' END AS m_topic, "
        f"length(x) - length(regexp_replace(x, '{blanks}', '', 'g')) + 1 AS m_n_tokens "
        f"FROM (SELECT *, coalesce(text, '') AS x FROM {documents}))",
        "counted AS (SELECT m_source, m_lang, m_topic, sum(m_n_tokens) AS tokens FROM described GROUP BY ALL)",
        "shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM counted) AS share FROM counted)",
    ]
    for m in MARGINS:
        steps.append(f"p_{m} AS (SELECT m_{m}, power(sum(share), {getattr(targets, m)}) AS t FROM shares GROUP BY ALL)")
    steps.append(
        "w0 AS (SELECT s.*, share AS weight"
        + "".join(f", p_{m}.t / (SELECT sum(t) FROM p_{m}) AS t_{m}" for m in MARGINS)
        + " FROM shares s"
        + "".join(f" JOIN p_{m} USING (m_{m})" for m in MARGINS)
        + ")"
    )
    n = 0
    for _ in range(targets.rounds):
        for m in MARGINS:
            steps.append(
                f"w{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (weight), weight * t_{m} / sum(weight) OVER (PARTITION BY m_{m}) AS weight FROM w{n})"
            )
            n += 1
    steps.append(f"f0 AS (SELECT {targets.keep!r}::DOUBLE AS f)")
    for k in range(_CALIBRATIONS):
        steps.append(
            f"f{k + 1} AS MATERIALIZED (SELECT coalesce(greatest({targets.keep!r} - coalesce(sum(share) FILTER (weight / share * f >= 1), 0), 0)"
            f" / nullif(sum(weight) FILTER (weight / share * f < 1), 0), any_value(f)) AS f FROM w{n}, f{k})"
        )
    steps.append(f"cells AS (SELECT w.*, round(least(1.0, weight / share * f), 9) AS probability FROM w{n} w, f{_CALIBRATIONS})")
    steps.append(
        f"drawn AS (SELECT d.*, c.weight AS m_weight, c.probability AS m_probability, "
        f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '{NO_VALUE}')), 1, 8) AS BIGINT) / 4294967296.0 < c.probability AS m_kept "
        f"FROM described d JOIN cells c USING (m_source, m_lang, m_topic))"
    )
    return "WITH " + ", ".join(steps)
