"""Near-duplicates: SimHash fingerprints searched with vantage-point trees (operator 4).

Fingerprints are partitioned by their Hamming distance to vantage points: at each node of a tree the
ones within a median distance go to the inner child, the others to the outer one. By the triangle
inequality a fingerprint within ``radius`` of a query can lie in a child only if the query's own
distance is within ``radius`` of that child's range, so a query visits the other child too only if it
is that close to the boundary. Most random fingerprints are close to most boundaries, so a tree over all of them
would send each to a number of shards that grows with the table. Distinct fingerprints are therefore dealt
by pieces of their bits: of radius + 1 pieces of two fingerprints within radius one is equal, so each goes to radius + 1
shards, however many there are. Each shard is searched by a tree whose top is fitted on a bounded
sample of all and sends queries near boundaries to every leaf they overlap; in a leaf the same recursion goes
on. The result is exact for any tree: the sample only balances it.

A shard reports the links it finds as a spanning forest, not as all pairs, so a dense group of
near-copies costs as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import lowest_per_component, shared, text_of

SHINGLE_WORDS = 3
RADIUS = 3
#: Fingerprints that the top of the tree is fitted on, at most.
SAMPLE = 65_536
#: Fingerprints in a shard, on average.
SHARD = 4_096
#: Levels of the tree that are fitted on the sample.
TOP = 4
#: In memory, a node of so few fingerprints is compared one by one.
LEAF = 48
_SEED = 42


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of word shingles; words are separated by ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[shingle_words - 1 :] if len(words) >= shingle_words else ends[-1:]
    total = np.zeros(64, np.int64)
    starts, stops = first[:n].tolist(), last[:n].tolist()
    for k in range(0, n, 65_536):
        hashes = np.array(
            [digest(flat[i:j], _SEED) for i, j in zip(starts[k : k + 65_536], stops[k : k + 65_536])], np.uint64
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * total > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit integer ``bits``, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, pa.int64())], ["doc_id", "bits"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, bits long")


def _distance(points: np.ndarray, centre: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ centre).astype(np.int16)


def fit_tree(sample: np.ndarray, depth: int, seed: int = 7) -> list[tuple[int, int]]:
    """Vantage points and radii of a tree of so many levels, as a heap; shard = leaf of the heap."""
    tree: list[tuple[int, int]] = []
    rng = np.random.default_rng(seed)
    level = [sample]
    for _ in range(depth):
        below = []
        for points in level:
            centre = points[rng.integers(len(points))] if len(points) else np.uint64(rng.integers(1 << 62))
            far = _distance(points, centre)
            # A point is at 0 from itself; the boundary that halves the points is preferred.
            radius = int(np.median(far)) if len(points) else 32
            if len(points) and (far <= radius).all():
                radius = int(far.max()) - 1
            tree.append((int(centre), radius))
            below += [points[far <= radius], points[far > radius]]
        level = below
    return tree


def _deal(points: np.ndarray, tree: list[tuple[int, int]], depth: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of each point and the leaves it belongs to; slack 0: its own leaf only."""
    index, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    centres = np.array([c for c, _ in tree] or [0], np.uint64)
    radii = np.array([r for _, r in tree] or [0], np.int16)
    for _ in range(depth):
        far = np.bitwise_count(points[index] ^ centres[node]).astype(np.int16)
        inner, outer = far <= radii[node] + slack, far > radii[node] - slack
        index, node = (
            np.concatenate((index[inner], index[outer])),
            np.concatenate((2 * node[inner] + 1, 2 * node[outer] + 2)),
        )
    return index, node - ((1 << depth) - 1)


def _search(points: np.ndarray, members: np.ndarray, queries: np.ndarray, radius: int, forest, depth: int = 0) -> None:
    """Link each query to the members within radius; members and queries index points."""
    stack = [(members, queries, depth)]
    while stack:
        m, q, d = stack.pop()
        if not len(m) or not len(q):
            continue
        if len(m) <= LEAF or d > 40:
            for k in range(0, len(q), max(1, 4_000_000 // len(m))):
                part = q[k : k + max(1, 4_000_000 // len(m))]
                near = np.bitwise_count(points[part][:, None] ^ points[m][None, :]) <= radius
                i, j = np.nonzero(near)
                forest.link(part[i], m[j])
            continue
        centre = points[m[(len(m) * 7 + d) % len(m)]]
        far_m, far_q = _distance(points[m], centre), _distance(points[q], centre)
        cut = int(np.median(far_m))
        if (far_m <= cut).all():
            cut = int(far_m.max()) - 1
        if cut < 0:
            d = 41
            stack.append((m, q, d))
            continue
        stack.append((m[far_m <= cut], q[far_q <= cut + radius], d + 1))
        stack.append((m[far_m > cut], q[far_q > cut - radius], d + 1))


class Forest:
    """Union of linked points, the smallest index as root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        other = a != b
        a, b = a[other], b[other]
        while len(a):
            a, b = self.roots(a), self.roots(b)
            other = a != b
            a, b = a[other], b[other]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))

    def roots(self, a: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[a]
            upper = self.up[up]
            if (up == upper).all():
                return up
            self.up[a] = upper
            a = upper


def near_links(prints: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column ``bits``) at most radius bits apart.

    Only as many links as connect each shard's groups are returned: their connected components
    are exactly those of all pairs within the radius.
    """
    spark = prints.sparkSession
    n = prints.count()
    share = min(1.0, 1.2 * sample / max(n, 1))
    picked = prints.where(F.abs(F.hash("bits").cast("long")) < share * 2**31).limit(sample).toPandas()["bits"]
    points = np.sort(picked.to_numpy(np.int64)).view(np.uint64)
    depth = min(TOP, max(0, int(np.log2(max(len(points), 1) / 4)))) if len(points) else 0
    tree = spark.sparkContext.broadcast(fit_tree(points, depth))
    # Of radius + 1 pieces of near fingerprints one is equal: they meet in the shard that it falls in.
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    shards = max(1, -(-n // shard))
    piece = [F.shiftrightunsigned("bits", lo).bitwiseAND(F.lit((1 << min(hi - lo, 63)) - 1)) for lo, hi in zip(edges, edges[1:])]
    leaves = [F.pmod(F.xxhash64(p), F.lit(shards)) + F.lit(k * shards) for k, p in enumerate(piece)]
    dealt = prints.select("bits", F.explode(F.array(*leaves)).alias("leaf"))
    # A shard with more fingerprints than planned is cut in blocks, each pair of which is one task group.
    sizes = shared(dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")), "shards")
    blocks = sizes.select(
        "leaf",
        F.ceil(F.col("size") / (4.0 * shard)).cast("int").alias("mb"),
        F.ceil(F.col("size") / (32.0 * shard)).cast("int").alias("qb"),
    ).where("mb > 1")
    dealt = dealt.join(F.broadcast(blocks), "leaf", "left")  # few: each has over four times its share
    whole = dealt.where("mb is null").select("leaf", "bits", F.lit(0).alias("m"), F.lit(0).alias("q"), F.lit(None).cast("boolean").alias("asks"))
    heavy = dealt.where("mb is not null")
    spread = F.pmod(F.xxhash64("bits"), F.lit(1 << 30)).cast("int")
    asks = heavy.select(
        "leaf", "bits", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"), (spread % F.col("qb")).alias("q"), F.lit(True).alias("asks")
    )
    answers = heavy.select(
        "leaf", "bits", (spread % F.col("mb")).alias("m"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), F.lit(False).alias("asks")
    )

    def find(table):
        bits = table.column("bits").to_numpy()
        asking = table.column("asks").to_pandas()
        values, index = np.unique(bits, return_inverse=True)
        index, near = index.reshape(-1), values.view(np.uint64)
        forest = Forest(len(values))
        members, queries = (np.unique(index[(asking != other).to_numpy(bool)]) for other in (True, False))
        own, home = _deal(near[members], tree.value, depth, 0)
        at, leaf = _deal(near[queries], tree.value, depth, radius)
        for k in range(1 << depth):
            _search(near, members[own[home == k]], queries[at[leaf == k]], radius, forest)
        child = np.flatnonzero(forest.up != np.arange(len(values)))
        return pa.table({"a": values[child], "b": values[forest.roots(child)]})

    rows = whole.unionByName(answers).unionByName(asks)
    return rows.groupBy("leaf", "m", "q").applyInArrow(find, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in at most radius bits; a component is what
    links connect, named by its smallest doc_id. A null text counts as empty; texts without words
    have fingerprint zero and are linked like any other. Repeated rows get equal rows; an empty table
    gives an empty result; other columns are ignored.
    """
    prints = shared(fingerprints(docs, shingle_words), "prints")
    distinct = shared(prints.groupBy("bits").agg(F.min("doc_id").alias("lowest")), "distinct")
    links = near_links(distinct, radius, **options)
    roots = shared(lowest_per_component(links), "roots").withColumnRenamed("node", "bits")
    linked = distinct.join(roots, "bits")
    named = linked.groupBy("root").agg(F.min("lowest").alias("component_id"))
    linked = linked.join(named, "root").select("bits", "component_id")
    names = distinct.join(linked, "bits", "left").select("bits", F.coalesce("component_id", "lowest").alias("component_id"))
    return prints.join(names, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, with all their columns.

    Of rows that repeat that doc_id one stays. Rows without a doc_id form groups like any other;
    a group of such rows alone keeps them all.
    """
    return first_of_components(docs, near_duplicates(docs, **options).select("component_id"))


def first_of_components(docs: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is a component_id; of rows that repeat a doc_id one stays."""
    kept = docs.join(components.select(F.col("component_id").alias("_id")).distinct(), docs.doc_id.eqNullSafe(F.col("_id")), "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").isEmpty():
        known = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
        kept = known.unionByName(kept.where("doc_id is null"))
    return kept
