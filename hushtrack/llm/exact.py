"""Exact duplicates by deterministic block naming (operator 2), DataFrame operations only.

Texts are cut into blocks of a fixed size. All distinct blocks are sorted and get integers as names,
then adjacent pairs of names are sorted and named, and so on, until one name is left for each
document. Equal names at equal numbers of blocks mean equal texts: nothing rests on a hash. Hashes
only come first in the order of the blocks, so that whole texts are compared solely where hashes are
equal, and block texts cross the network once, after a map-side distinct.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.llm.common import shared, text_of, without_blanks

BLOCK_CHARS = 4096


def exact_groups(
    docs: DataFrame,
    block_chars: int = BLOCK_CHARS,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, text_sha256, keep_id, group_size, kept.

    Texts are equal if they are identical without the characters ``[\\x20\\x09-\\x0D]``. A null text
    counts as empty, and empty texts form one group. Of a group the row with the most code points
    stays, then the one with the smallest doc_id (null last); of rows that agree in that too, one.
    An empty table gives an empty result; other columns are ignored.
    """
    cut = f"regexp_extract_all(flat, '(?s).{{1,{block_chars}}}', 0)"
    flat = docs.select(
        F.col("doc_id").alias("doc_id"), F.length(text_of()).cast("long").alias("n_chars"), without_blanks(text_of()).alias("flat")
    )
    rows = shared(
        flat.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_chars",
            F.sha2("flat", 256).alias("text_sha256"),
            F.transform(F.expr(cut), lambda c: block_hash(c)).alias("hashes"),
        ),
        "rows",
    )
    blocks = flat.select(F.explode(F.expr(cut)).alias("block"))
    blocks = blocks.select(block_hash(F.col("block")).alias("hash"), "block").distinct()
    shared_hashes = shared(
        blocks.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "collisions"
    )
    level = rows.select("row", F.size("hashes").alias("size"), F.posexplode("hashes").alias("pos", "hash"))
    if shared_hashes.isEmpty():
        level = level.withColumn("rank", F.lit(0))
    else:
        level = _ranked(docs, flat, rows, cut, block_hash, blocks, shared_hashes)
    level = _named(level, ["hash", "rank"])
    done = rows.where(F.size("hashes") == 0).select(
        "row", F.lit(-1).alias("depth"), F.lit(0).cast("long").alias("name")
    )
    for depth in count():
        done = done.unionByName(level.where("size = 1").select("row", F.lit(depth).alias("depth"), "name"))
        level = level.where("size > 1")
        if level.isEmpty():
            break
        pairs = level.groupBy("row", "size", F.shiftright("pos", 1).alias("half")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"),
        )
        pairs = pairs.select(
            "row", ((F.col("size") + 1) / 2).cast("int").alias("size"), F.col("half").alias("pos"),
            "left", F.coalesce("right", F.lit(-1)).alias("right"),
        )
        level = _named(pairs, ["left", "right"])
    return _grouped(rows, shared(done, "names"))


def _named(level: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the keys by integers, given in the order of the sorted distinct keys."""
    names = level.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = shared(names.withColumn("name", F.monotonically_increasing_id()), "names")
    return shared(level.join(names, keys).select("row", "size", "pos", "name"), "level")


def _ranked(docs, flat, rows, cut, block_hash, blocks, hashes) -> DataFrame:
    """Where different blocks share a hash, their rank in sorted order tells them apart."""
    order = Window.partitionBy("hash").orderBy("block")
    ranks = blocks.join(hashes, "hash", "left_semi").withColumn("rank", F.row_number().over(order))
    texts = shared(
        docs.select("doc_id", without_blanks(text_of()).alias("flat")).select(
            "doc_id", F.sha2("flat", 256).alias("text_sha256"), F.posexplode(F.expr(cut)).alias("pos", "block")
        )
        .withColumn("hash", block_hash(F.col("block")))
        .join(ranks, ["hash", "block"])
        .select("doc_id", "text_sha256", "pos", "rank")
        .distinct(),
        "ranks",
    )
    level = rows.select(
        "row", "doc_id", "text_sha256", F.size("hashes").alias("size"), F.posexplode("hashes").alias("pos", "hash")
    )
    same = (
        level.doc_id.eqNullSafe(texts.doc_id)
        & (level.text_sha256 == texts.text_sha256)
        & (level.pos == texts.pos)
    )
    return level.join(texts, same, "left").select(
        "row", "size", level.pos, "hash", F.coalesce("rank", F.lit(0)).alias("rank")
    )


def _grouped(rows: DataFrame, names: DataFrame) -> DataFrame:
    members = rows.drop("hashes").join(names, "row")
    best = members.groupBy("depth", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(
            F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("low"),
                     (-F.col("row")).alias("first"))
        ).alias("best"),
    )
    best = best.select(
        "depth", "name", "group_size",
        (-F.col("best.low")).alias("keep_id"), (-F.col("best.first")).alias("keep_row"),
    )
    # Written, so that the join has exchanges of its own, whose large partitions can be split.
    best = shared(best, "best")
    return members.join(best, ["depth", "name"]).select(
        "doc_id", "n_chars", "text_sha256", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that agree in doc_id and text are one document: one of them stays.
    """
    groups = exact_groups(docs, **options)
    kept = groups.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_chars").alias("_n"))
    sha = F.sha2(without_blanks(text_of()), 256)
    tagged = docs.withColumn("_own_sha", sha).withColumn("_own_n", F.length(text_of()).cast("long"))
    same = tagged.doc_id.eqNullSafe(F.col("_id")) & (F.col("_own_sha") == F.col("_sha")) & (F.col("_own_n") == F.col("_n"))
    out = tagged.join(kept, same, "left_semi")
    repeats = groups.groupBy("doc_id", "text_sha256", "n_chars").count().where("count > 1")
    if not repeats.isEmpty():
        out = out.dropDuplicates(["doc_id", "_own_sha", "_own_n"])
    return out.drop("_own_sha", "_own_n")
