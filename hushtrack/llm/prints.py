"""Document fingerprints: weighted SimHash and permuted block tables (operator 9), DataFrame only.

Each term of a text (a run of characters other than ``[\\x20\\x09-\\x0D]``) votes with its hash: for
bit i with plus or minus its weight. The weight of a term is its number of occurrences times its
length (at most ``MAX_WEIGHT``), so frequent short words do not outvote the rest. Votes of two bits
share one 64-bit sum, in lanes of 32 bits; votes of a document are summed where its text lies, and
only the sums cross the network.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushtrack.llm.common import shared, text_of

BITS = 64
RADIUS = 3
#: Blocks that a fingerprint is cut in; any BLOCKS - RADIUS of them are the key of one table.
BLOCKS = 5
MAX_WEIGHT = 20
_LANES = 0x0000000100000001
_SPLIT = "[ \\t\\n\\x0b\\f\\r]+"


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and the fingerprint ``bits`` of all terms of the rows that share them; no term: zero."""
    terms = texts.select(*keys, F.explode(F.split(F.col(text), _SPLIT)).alias("term"))
    terms = terms.select(
        *keys,
        F.xxhash64("term").alias("vote"),
        F.least(F.length("term"), F.lit(MAX_WEIGHT)).cast("long").alias("weight"),
    )
    votes = [
        F.sum(F.shiftrightunsigned("vote", i).bitwiseAND(F.lit(_LANES)) * F.col("weight")).alias(f"v{i}")
        for i in range(BITS // 2)
    ]
    sums = terms.groupBy(*keys).agg(F.sum("weight").alias("all"), *votes)
    low = [F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(BITS // 2)]
    high = [F.shiftrightunsigned(f"v{i}", 32) for i in range(BITS // 2)]
    one = F.lit(1).cast("long")
    bits = [
        F.when(2 * ones > F.col("all"), F.shiftleft(one, i)).otherwise(F.lit(0).cast("long"))
        for i, ones in enumerate(low + high)
    ]
    return sums.select(*keys, reduce(Column.bitwiseOR, bits).alias("bits"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def near_counts(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each of the query fingerprints (distinct ``bits``), the weight of all within radius.

    prints: distinct ``bits`` with a weight ``n``. Two fingerprints within radius agree in at least
    blocks - radius whole blocks, so they meet in the table keyed by those; where they meet in
    several, the first counts.
    """
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    chosen = list(combinations(range(blocks), blocks - radius))
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    keys = [signed(sum(masks[k] for k in c)) for c in chosen]

    def tabled(df: DataFrame) -> DataFrame:
        rows = F.explode(
            F.array(*[F.struct(F.lit(t).alias("table"), F.col("bits").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(keys)])
        )
        return df.withColumn("t", rows).select("t.table", "t.key", *df.columns)

    differ = F.col("q").bitwiseXOR(F.col("bits"))
    first = reduce(
        lambda rest, tm: F.when(differ.bitwiseAND(F.lit(tm[1])) == 0, F.lit(tm[0])).otherwise(rest),
        reversed(list(enumerate(keys))),
        F.lit(-1),
    )
    meet = tabled(queries.select("bits")).withColumnRenamed("bits", "q").join(tabled(prints.select("bits", "n")), ["table", "key"])
    near = meet.where((F.bit_count(differ) <= radius) & (first == F.col("table")))
    return near.groupBy(F.col("q").alias("bits")).agg(F.sum("n").alias("near_docs"))


def _in_order(docs: DataFrame) -> DataFrame:
    """Distinct documents with the one that follows: by descending doc_id (null last), then hash."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").desc()]
    rows = docs.groupBy("doc_id", "hash", "n_chars").agg(F.count(F.lit(1)).alias("copies")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = shared(rows.withColumn("at", F.monotonically_increasing_id()), "order")
    # monotonically_increasing_id: the partition above bit 33, the place in it below.
    rows = rows.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    rows = shared(rows.join(parts, "part").select("doc_id", "hash", "n_chars", "copies", (F.col("offset") + F.col("place")).alias("at")), "places")
    total = rows.count()
    follow = rows.select(
        F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"),
        ((F.col("at") + (total - 1)) % F.lit(max(total, 1))).alias("at"),
    )
    return rows.join(follow, "at").select("doc_id", "hash", "n_chars", "copies", "next_id", "next_hash")


def document_fingerprints(docs: DataFrame, radius: int = RADIUS, query_every: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, near_docs.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or
    all) of the next document's. near_docs, for every doc_id divisible by query_every and null
    elsewhere, is the number of documents whose fingerprint is within radius, itself included. A null text
    counts as empty and has fingerprint zero. Rows that agree in doc_id and text are one document in
    the order and get equal rows; documents of one doc_id follow each other by hash. A sole document
    follows itself; an empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select("doc_id", text_of().alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text")).withColumn("n_chars", F.length("text").cast("long"))
    order = shared(_in_order(docs), "next")
    asks = order.select(
        F.col("next_id").alias("from_id"), F.col("next_hash").alias("from_hash"),
        F.col("doc_id").alias("to_id"), F.col("hash").alias("to_hash"),
        "n_chars", F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
    )
    # Both joins read the same columns, so that one exchange of the texts serves them.
    texts = docs.select("doc_id", "hash", "text")
    given = texts.dropDuplicates(["doc_id", "hash"]) if not order.where("copies > 1").isEmpty() else texts
    given = given.join(asks, given.doc_id.eqNullSafe(asks.from_id) & (given.hash == asks.from_hash))
    given = given.select("to_id", "to_hash", "n_chars", "wanted", F.substring("text", F.lit(1), F.col("wanted")).alias("piece"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.col("wanted")).cast("int"))
    both = texts.join(given, texts.doc_id.eqNullSafe(given.to_id) & (texts.hash == given.to_hash)).select(
        "doc_id", "hash", "n_chars", "text", F.concat(kept, F.col("piece")).alias("edited")
    )
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    # One pass over the words of both texts; a repeated row multiplies all votes alike.
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), "text"), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"))))
    sides = both.select("doc_id", "hash", "n_chars", "edited_sha256", sides.alias("s")).select(
        "doc_id", "hash", "n_chars", "edited_sha256", "s.side", "s.text"
    )
    prints = simhash(sides, ["doc_id", "hash", "n_chars", "edited_sha256", "side"])
    prints = prints.groupBy("doc_id", "hash", "n_chars").agg(
        F.max(F.when(F.col("side") == 0, F.col("bits"))).alias("bits"),
        F.max(F.when(F.col("side") == 1, F.col("bits"))).alias("edited_bits"),
        F.max_by("edited_sha256", "side").alias("edited_sha256"),
    )
    prints = shared(prints, "prints")
    after = prints.select(F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("bits").alias("next_bits"))
    out = prints.join(
        order.select(F.col("doc_id").alias("own_id"), F.col("hash").alias("own_hash"), "next_id", "next_hash", "copies"),
        F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash")),
    )
    out = out.alias("o").join(
        after.alias("n"), F.col("o.next_id").eqNullSafe(F.col("n.next_id")) & (F.col("o.next_hash") == F.col("n.next_hash"))
    ).drop("next_id", "next_hash", "own_id", "own_hash")
    asked = prints.where(F.col("doc_id") % query_every == 0).select("bits").distinct()
    out = shared(out, "followed")
    near = near_counts(asked, out.groupBy("bits").agg(F.sum("copies").alias("n")), radius)
    out = out.join(near, "bits", "left")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex16(F.col("bits")).alias("fingerprint"),
        hex16(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        F.when(F.col("doc_id") % query_every == 0, F.col("near_docs")).alias("near_docs"),
    )
