"""Near copies by the likeness of their texts (the near-duplicate stage of the pipeline).

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least
0.8. Candidates come from SimHash fingerprints of the sets, searched with the vantage-point trees of
operator 4 at its radius; whole sets confirm them. No tree prunes the larger distances that fingerprints
of less alike sets have, so the rest comes from a prefix filter, which loses none: put the shingles of every set in one order; sets that are similar enough then
share one of the first n - ceil(0.8 n) + 1 of their n shingles. The order starts with the shingles
that are rare in a bounded sample, so passages that many documents share are hardly ever among the
first; the sample decides only how many candidates there are, the result is the same for any.

Candidates are compared shingle by shingle. First what the trees found is compared, and each document meets the smallest and the largest
member of its groups; a group of copies is one component then and needs no more pairs. What is
left in different components meets pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import Scratch, lowest_per_component, shared, text_of
from hushtrack.llm.neighbours import RADIUS, first_of_components, near_links

SHINGLE_WORDS = 5
#: Least similarity of linked texts, as a fraction.
ALIKE, OF = 4, 5
#: Documents whose shingles tell which ones are common, and shingles that are told, at most.
SAMPLE, COMMON = 20_000, 1_000_000
#: Rows of an Arrow batch that a set or a prefix is unfolded into, about.
ROWS = 200_000
#: Bits of a sketch of a set.
SKETCH_BITS = 1024
#: Nodes whose sets are compared that are broadcast at once, at most.
BROADCAST_NODES = 1 << 20
#: Nodes of one fingerprint that are exchanged together, at most; those of others meet it where they lie.
SAME_PRINT = 4_096
_SEED = 42


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; a shorter text is one shingle.

    Words are separated by ASCII white space, A-Z lower-cased; all texts without words are equal.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= SHINGLE_WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), _SEED)], np.uint64)
    flat = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_intdigest
    n = len(words) - SHINGLE_WORDS + 1
    return np.unique(np.fromiter((digest(flat[i:j], _SEED) for i, j in zip(starts, ends[SHINGLE_WORDS - 1 :])), np.uint64, n))


def _node(hashes: np.ndarray) -> int:
    """The name of a set: a hash of all its shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), _SEED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text"))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Bits that tell for each slot whether an odd number of shingles falls into it.

    Two sketches differ in no more bits than the sets differ in shingles.
    """
    return np.packbits((np.bincount((hashes % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(bool))


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash of a set as a signed number: the bits that over half of its shingles have."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def nodes_of(docs: DataFrame) -> DataFrame:
    """doc_id, node, n (size of the set), bits (its SimHash) and sketch, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, prints, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_set(text)
                nodes.append(_node(hashes))
                sizes.append(len(hashes))
                prints.append(simhash(hashes))
                sketches.append(sketch(hashes).tobytes())
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "node", "n", "bits", "sketch"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, node long, n long, bits long, sketch binary")


def near_prints(nodes: DataFrame, keep: Scratch, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of nodes that connect all whose fingerprints differ in at most radius bits.

    Vantage-point trees link the distinct fingerprints; each is stood for by its smallest node, which the
    other nodes of that fingerprint are paired with.
    """
    prints = nodes.groupBy("bits").agg(F.min("node").alias("first"), F.count_distinct("node").alias("size"))
    prints = keep(prints, "prints")
    ends = [prints.select(F.col("bits").alias(x), F.col("first").alias(f"first_{x}")) for x in "ab"]
    links = near_links(prints.select("bits"), radius)
    across = links.join(ends[0], "a").join(ends[1], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    several = prints.where("size > 1").select("bits", "first", "size")
    many = several.where(F.col("size") > SAME_PRINT).select("bits", "first")
    told = nodes.select("node", "bits").join(F.broadcast(many), "bits", "left")  # few: each stands for over 4,096 nodes
    few = told.where("first is null").drop("first").join(several.where(F.col("size") <= SAME_PRINT), "bits")
    same = [rows.select(F.col("first").alias("a"), F.col("node").alias("b")).where("a <> b") for rows in (told.where("first is not null"), few)]
    return reduce(DataFrame.union, [across, *same])


def _not_too_far(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule them out: similar sets differ in at most a ninth of both sizes."""
    known = nodes.select("node", "n", "sketch").dropDuplicates(["node"])
    one, two = (known.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(f"sketch_{c}").to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64) for c in "ab")
            apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((ALIKE + OF) * apart <= (2 * OF - ALIKE - OF) * sizes))

    return pairs.join(one, "a").join(two, "b").mapInArrow(compare, "a long, b long")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and set (as bytes) of the given nodes. Sets are made from the texts where they are needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            names = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "set"])

    if nodes.count() <= BROADCAST_NODES:  # 8 bytes each; more of them meet their sets by an exchange
        nodes = F.broadcast(nodes)
    made = _texts(docs).mapInArrow(run, "node long, set binary")
    return made.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _common(docs: DataFrame, count: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample share, sorted, and how many do."""
    share = min(1.0, sample / max(count, 1))
    picked = _texts(docs).where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text).view(np.int64))], ["shingle"])

    counts = picked.mapInArrow(unfold, "shingle long").groupBy("shingle").count().where("count > 2")
    counts = counts.orderBy(F.desc("count"), "shingle").limit(COMMON).toPandas()
    shingles = counts["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], counts["count"].to_numpy(np.int64)[order]


def prefix(hashes: np.ndarray, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set: rarest first, then by their hashes."""
    n = len(hashes)
    size = n - -(-ALIKE * n // OF) + 1
    if not len(shingles):
        return hashes[:size]
    at = np.minimum(np.searchsorted(shingles, hashes), len(shingles) - 1)
    known = np.where(shingles[at] == hashes, counts[at], 0)
    return hashes[np.argsort(known, kind="stable")[:size]]


def _prefixes(docs: DataFrame, count: int, sample: int) -> DataFrame:
    """shingle, node, and size of the set and place of the shingle in the order in one number."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, count, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(parts: list) -> pa.RecordBatch:
            shingles = np.concatenate([p for p, _, _ in parts]).view(np.int64)
            long = [len(p) for p, _, _ in parts]
            nodes = np.repeat(np.array([k for _, k, _ in parts], np.uint64).view(np.int64), long)
            places = np.repeat(np.array([n for *_, n in parts]) << 32, long) | np.concatenate([np.arange(k) for k in long])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (shingles, nodes, places)], ["shingle", "node", "place"])

        parts, rows = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                hashes = shingle_set(text)
                first = prefix(hashes, *common.value)
                parts.append((first, _node(hashes), len(hashes)))
                rows += len(first)
                if rows > ROWS:
                    yield batch_of(parts)
                    parts, rows = [], 0
        if parts:
            yield batch_of(parts)

    return _texts(docs).mapInArrow(run, "shingle long, node long, place long")


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, keep: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    pairs = keep(_not_too_far(pairs.distinct(), nodes), "pairs")
    if pairs.isEmpty():
        return pairs
    asked = keep(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "asked")
    sets = keep(_sets_of(docs, asked), "sets")
    one, two = (sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                alike.append((ALIKE + OF) * both >= ALIKE * (len(p) + len(q)))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return keep(pairs.join(one, "a").join(two, "b").mapInArrow(compare, "a long, b long"), "alike")


def _could_be(x: Column, y: Column) -> Column:
    """Whether sets with these sizes that share nothing before these places can be similar enough."""
    n, at = (lambda p: F.shiftright(p, 32)), (lambda p: p.bitwiseAND(F.lit((1 << 32) - 1)))
    return (ALIKE + OF) * F.least(n(x) - at(x), n(y) - at(y)) >= ALIKE * (n(x) + n(y))


def _shared_shingles(rows: DataFrame) -> DataFrame:
    """shingle, and of the nodes that share it the smallest and largest; one shingle for each set of nodes.

    A passage gives many shingles that the same nodes share. All nodes have them in the same order, so the
    first one leaves the most pairs possible and stands for the rest, whose number is ``alike``. Sets of
    nodes are told apart by their number, ends and two sums of hashes.
    """
    part = lambda seed: F.sum(F.shiftrightunsigned(F.xxhash64("node", F.lit(seed)), 33))  # noqa: E731  2^32 of them fit a long
    groups = rows.groupBy("shingle").agg(
        F.min("node").alias("lo"),
        F.min_by("place", "node").alias("lo_place"),
        F.max("node").alias("hi"),
        F.max_by("place", "node").alias("hi_place"),
        F.count(F.lit(1)).alias("size"),
        part(1).alias("one"),
        part(2).alias("two"),
    )
    return groups.where("lo < hi").groupBy("lo", "hi", "size", "one", "two").agg(
        F.min_by("shingle", "lo_place").alias("shingle"),
        F.min("lo_place").alias("lo_place"),
        F.min_by("hi_place", "lo_place").alias("hi_place"),
        F.count(F.lit(1)).alias("alike"),
    ).select("shingle", "lo", "lo_place", "hi", "hi_place", "alike")


def similar_links(docs: DataFrame, nodes: DataFrame, keep: Scratch, sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) between nodes; their components are those of all pairs that are similar enough.

    Nodes that the trees find near are paired. Rows of prefixes are exchanged once: the nodes of each shingle are summed up, and met, where the
    rows lie then. Shingles of one node alone, most of them, go no further. Of those who share a shingle
    the one that shares most of its own is likely to be what the others were made from: it, the
    smallest and the largest are compared with all others first.
    """
    rows = _prefixes(docs, nodes.count(), sample).repartition("shingle")
    met = keep(rows.join(_shared_shingles(rows), "shingle"), "met")
    shares = met.groupBy("node").agg(F.sum("alike").alias("shares"))
    # One number with the shares above 40 bits of the node's hash: its greatest value is a hash aggregate.
    score = F.shiftleft("shares", 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64("node"), 24))
    rated = met.select("shingle", "node", "place").join(shares, "node").select("shingle", "node", "place", score.alias("score"))
    best = rated.groupBy("shingle").agg(F.max_by("node", "score").alias("mid"), F.max_by("place", "score").alias("mid_place"))
    met = keep(met.join(best, "shingle"), "rated")
    stars = [
        met.where(_could_be(F.col("place"), F.col(f"{end}_place"))).select(F.col("node").alias("a"), F.col(end).alias("b")).where("a <> b")
        for end in ("lo", "mid", "hi")
    ]
    stars = reduce(DataFrame.union, [near_prints(nodes, keep), *stars]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = _confirmed(stars, docs, nodes, keep)
    roots = keep(lowest_per_component(links), "star-roots")
    left = met.select("shingle", "node", "place").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = keep(left.distinct(), "left")
    apart = left.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("shingle")
    left = keep(left.join(apart, "shingle"), "apart")
    x, y = left.alias("x"), left.alias("y")
    meet = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    rest = x.join(y, meet & _could_be(F.col("x.place"), F.col("y.place"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return links.union(_confirmed(rest, docs, nodes, keep))


def one_of_each(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, with all their columns.

    A component is what links between similar texts connect, named by its smallest doc_id. A null
    text counts as empty. doc_id is a whole number. Rows without a doc_id and rows that repeat one are
    treated as in ``neighbours.one_of_each``; an empty table gives an empty result. ``docs`` is
    read several times and must not change meanwhile.
    """
    with Scratch(docs.sparkSession) as keep:
        nodes = keep(nodes_of(docs), "nodes")
        roots = keep(lowest_per_component(similar_links(docs, nodes, keep, sample)), "roots")
        nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        first = shared(nodes.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    return first_of_components(docs, first)
