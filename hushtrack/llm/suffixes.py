"""Removal of repeated byte strings with a distributed merge sort of suffixes (operator 8).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
doc_id. Not every suffix need be sorted to find these strings: of the grams of ``GRAM`` bytes in such a
string the one with the smallest hash is its anchor, and equal strings have equal anchors at equal
places. So only suffixes that start at anchors (about one in twelve) are sorted, over their first gram.

1. Each task sorts the anchor suffixes of its texts in runs and front-codes them: of each different
   suffix only what it does not share with the one before. Runs are exchanged by ranges of suffixes,
   and a loser tree that never compares known prefixes again merges the runs of a range. Suffixes in
   only one document are done with.
   The others learn where their gram stands in the smallest document that has it.
2. Anchors in a row whose grams stand in a row in one smaller document lie in a copied stretch: what
   is inside is settled. For the rest, the strings around anchors are compared as a whole, after tasks have
   settled what repeats among their own texts. (Of the documents that have a string the smallest is never
   settled itself, so it is among those compared.)
3. The byte ranges found are joined to their texts and cut out.

Copies of a passage cost one entry per run in 1, and in 2 only what is near the ends of a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import shared, text_of
from hushtrack.llm.loser_tree import cuts, merge, prefixes, quantiles

LENGTH = 50
GRAM = 28
_REACH = LENGTH - GRAM
#: Bytes of text in a run, and of text whose grams are hashed at once.
RUN_BYTES = 16 << 20
_SLICE = 1 << 20
#: Documents, and anchors of each, that the ranges are balanced on, at most.
SAMPLE_DOCS, SAMPLE_ANCHORS = 4_000, 64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LAST = (1 << 63) - 1


def _gear() -> np.ndarray:
    return np.random.default_rng(8).integers(0, 1 << 64, 256, dtype=np.uint64)


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram, from sums that double in length: 1, 2, 4, 8, 16 bytes."""
    p = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(p, n, 1 << 64))
    sums = {1: _gear()[raw]}
    for n in (1, 2, 4, 8):
        sums[2 * n] = sums[n][:-n] + power(n) * sums[n][n:]
    count = len(raw) - GRAM + 1
    h, at = np.zeros(count, np.uint64), 0
    for n in (16, 8, 4, 2, 1):
        if GRAM - at >= n:
            h += power(at) * sums[n][at : at + count]
            at += n
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in texts that lie in raw from starts to ends, with the first and last string start
    that each is the anchor of."""
    found = [np.zeros((3, 0), np.int64)]
    fits = ends - starts >= LENGTH
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts[fits]] += 1
    inside[ends[fits] - LENGTH + 1] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    for lo in range(0, max(0, len(raw) - LENGTH + 1), _SLICE):
        part = raw[lo : lo + _SLICE + LENGTH - 1]
        low = np.flatnonzero(inside[lo : lo + len(part) - LENGTH + 1])
        if not len(low):
            continue
        h = _gram_hashes(part)
        bits = np.uint64((1 << 21) - 1)
        best = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= _REACH + 1:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        best = np.minimum(best[: len(part) - LENGTH + 1], best[_REACH + 1 - width : _REACH + 1 - width + len(part) - LENGTH + 1])
        at = (best[low] & bits).astype(np.int64)
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (low[1:] != low[:-1] + 1)))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:] - 1, [len(at) - 1]))
        found.append(np.stack((at[first], low[first], low[last])) + lo)
    return tuple(np.concatenate(found, axis=1))


def _words(raw: np.ndarray, at: np.ndarray, length: int = GRAM) -> np.ndarray:
    """The bytes from each place on as big-endian words, padded with zeros: one column each."""
    words = np.zeros((-(-length // 8), len(at)), np.uint64)
    if not len(at):
        return words
    eight = np.lib.stride_tricks.sliding_window_view(raw, 8)
    for k in range(len(words)):
        # The last eight bytes hold some of the word before, which are shifted out.
        over = max(0, 8 * (k + 1) - length)
        words[k] = eight[at + (8 * k - over)].reshape(-1).view(">u8").astype(np.uint64) << np.uint64(8 * over)
    return words


def _in_order(words: np.ndarray) -> np.ndarray:
    """A stable order of keys (one column each): by their first word, and by the others where it is equal."""
    order = np.argsort(words[0], kind="stable")
    first = words[0][order]
    tie = np.zeros(len(order) + 1, bool)
    tie[1:-1] = first[1:] == first[:-1]
    equal = np.flatnonzero(tie[1:] | tie[:-1])
    some = order[equal]
    order[equal] = some[np.lexsort(words[::-1, some])]
    return order


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", count, 8)
    out, at = [], 8 * (count + 1)
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(data, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def front_coded(words: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """What each key does not share with the one before it, one after the other."""
    raw = np.ascontiguousarray(words.T).astype(">u8").view(np.uint8).reshape(words.shape[1], 8 * words.shape[0])[:, :GRAM]
    return raw[np.arange(GRAM)[None, :] >= lcp[:, None]]


def front_decoded(lcp: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The keys as words again: a byte comes from the last key that did not share it."""
    n = len(lcp)
    begin = np.concatenate(([0], np.cumsum(GRAM - lcp.astype(np.int64))))[:-1] - lcp
    full = np.zeros((-(-GRAM // 8), n, 8), np.uint8)
    for k in range(GRAM):
        own = np.flatnonzero(lcp <= k)
        full[k >> 3, :, k & 7] = np.repeat(rest[begin[own] + k], np.diff(own, append=n))
    return full.reshape(len(full), 8 * n).view(">u8").astype(np.uint64)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch, and where each starts (one more at the end)."""
    column = batch.column("text")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _run(raw: np.ndarray, starts: np.ndarray):
    """Sorted different anchor suffixes of a run: words, common prefixes, number of anchors, whether in
    two documents, the first document; for each anchor in that order its place and reach."""
    at, lo, hi = anchors(raw, starts[:-1], starts[1:])
    words = _words(raw, at)
    order = _in_order(words)
    words, at, lo, hi = words[:, order], at[order], lo[order], hi[order]
    lcp = prefixes(words, GRAM)
    new = lcp < GRAM
    if len(new):
        new[0] = True
    head = np.flatnonzero(new)
    doc = np.searchsorted(starts, at, side="right") - 1
    several = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head) if len(head) else np.zeros(0, bool)
    lengths = np.diff(np.concatenate((head, [len(at)])))
    return words[:, head], lcp[head], lengths, several, doc[head], at, (at - hi).astype(np.uint8), (at - lo).astype(np.uint8)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of()
    # Order of documents: by doc_id, null last. The hash tells rows of one doc_id apart.
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank"), F.xxhash64(text).alias("hash"), text.alias("text")
    )


def _ranges(keyed: DataFrame, parts: int) -> np.ndarray:
    """First 16 bytes of suffixes at which a sample of anchors is cut in equal parts."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = _texts(batch)
            at = anchors(raw, starts[:-1], starts[1:])[0]
            doc = np.searchsorted(starts, at, side="right") - 1
            first = np.searchsorted(doc, doc)
            at = at[np.arange(len(at)) - first < SAMPLE_ANCHORS] if len(at) else at
            w = _words(raw, at, 16)
            yield pa.RecordBatch.from_arrays([pa.array(w[0].view(np.int64)), pa.array(w[1].view(np.int64))], ["a", "b"])

    n = keyed.count()
    some = keyed.where(F.pmod(F.xxhash64("hash", F.lit(8)), F.lit(1 << 30)) < int(min(1.0, SAMPLE_DOCS / max(n, 1)) * (1 << 30)))
    got = some.select("text").mapInArrow(pick, "a long, b long").toPandas().to_numpy(np.int64).view(np.uint64)
    return quantiles(got.reshape(-1, 2), parts)


def _suspects(keyed: DataFrame, parts: int) -> DataFrame:
    """Of documents with grams that others have too: rank, hash, spots (place and reach of anchors
    that are to be compared), starts and ends of the stretches settled."""
    pivots = keyed.sparkSession.sparkContext.broadcast(_ranges(keyed, parts))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = 0, [], 0
        task = TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            rank, hashes = (np.concatenate([h[k] for h in held]) for k in (2, 3))
            texts = [raw[a:b] for raw, starts, *_ in held for a, b in zip(starts, starts[1:])]
            # Documents in order: the first of equal suffixes is then of the smallest one.
            order = np.lexsort((hashes, rank))
            rank, hashes, texts = rank[order], hashes[order], [texts[k] for k in order]
            raw = np.concatenate(texts)
            starts = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
            words, lcp, lengths, several, first, at, before, after = _run(raw, starts)
            ends = cuts(words, pivots.value)
            own = np.concatenate(([0], np.cumsum(lengths)))
            rows = [(0, _pack(starts, rank, hashes), -1)]
            for part, (a, b) in enumerate(zip(ends, ends[1:])):
                if a < b:
                    common = lcp[a:b].astype(np.uint8)
                    common[0] = 0
                    x, y = own[a], own[b]
                    rest = front_coded(words[:, a:b], common)
                    blob = _pack(
                        common, rest, lengths[a:b].astype("<u4"), several[a:b], rank[first[a:b]],
                        at[x:y].astype("<u4"), before[x:y], after[x:y],
                    )
                    rows.append((part, blob, part))
            run = (task << 24) + number
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([run % parts if k < 0 else p for p, _, k in rows], pa.int32()),
                    pa.array([k >= 0 for _, _, k in rows]),
                    pa.array([run] * len(rows), pa.int64()),
                    pa.array([b for _, b, _ in rows], pa.binary()),
                ],
                ["part", "keys", "run", "blob"],
            )

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                piece = batch.slice(k, 256)
                raw, starts = _texts(piece)
                held.append((raw, starts, piece.column("rank").to_numpy(), piece.column("hash").to_numpy()))
                size += len(raw)
                if size >= RUN_BYTES:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()

    def merged(table):
        keys = table.column("keys").to_pylist()
        run, blobs = table.column("run").to_pylist(), table.column("blob")
        out = [(r, False, blobs[k].as_py()) for k, r in enumerate(run) if not keys[k]]
        source = sorted((r, k) for k, r in enumerate(run) if keys[k])
        got = [_unpack(blobs[k].as_py(), "u1", "u1", "<u4", "?", "<i8", "<u4", "u1", "u1") for _, k in source]
        if got:
            starts = np.concatenate(([0], np.cumsum([len(g[0]) for g in got])))
            words = np.concatenate([front_decoded(g[0].astype(np.int16), g[1]) for g in got], axis=1)
            lcp = np.concatenate([g[0] for g in got]).astype(np.int16)
            order, common = merge(words, lcp, starts, GRAM)
            new = common < GRAM
            new[:1] = True
            head, group = np.flatnonzero(new), np.cumsum(new) - 1
            several, rank = np.concatenate([g[3] for g in got])[order], np.concatenate([g[4] for g in got])[order]
            many = np.diff(np.concatenate((head, [len(order)]))) > 1
            many |= np.bitwise_or.reduceat(several, head)
            # Where the gram stands in its smallest document: of equal ranks the first run's.
            by_rank, shared_rows = head.copy(), np.flatnonzero(~new | np.append(~new[1:], False))
            shared_rows = shared_rows[np.lexsort((order[shared_rows], rank[shared_rows], group[shared_rows]))]
            lead = np.flatnonzero(np.diff(group[shared_rows], prepend=-1))
            by_rank[group[shared_rows[lead]]] = shared_rows[lead]
            source_run = np.repeat([r for r, _ in source], np.diff(starts))[order]
            place = np.concatenate([g[5][np.cumsum(g[2], dtype=np.int64) - g[2]] for g in got])[order]
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            for (r, _), g, a, b in zip(source, got, starts, starts[1:]):
                mine = group[back[a:b]]
                here = np.repeat(many[mine], g[2])
                if here.any():
                    first = np.repeat(by_rank[mine], g[2])[here]
                    out.append((r, True, _pack(g[5][here], g[6][here], g[7][here], rank[first], source_run[first], place[first])))
        return pa.table({"run": pa.array([o[0] for o in out], pa.int64()), "keys": pa.array([o[1] for o in out], pa.bool_()), "blob": pa.array([o[2] for o in out], pa.binary())})

    def by_document(table):
        keys, blobs = table.column("keys").to_pylist(), table.column("blob")
        lists = [_unpack(blobs[k].as_py(), "<u4", "u1", "u1", "<i8", "<i8", "<u4") for k, is_key in enumerate(keys) if is_key]
        out = {n: [] for n in ("rank", "hash", "spots", "start", "end")}
        if lists:
            starts, rank, hashes = _unpack(blobs[keys.index(False)].as_py(), "<i8", "<i8", "<i8")
            columns = [np.concatenate([g[k] for g in lists]) for k in range(6)]
            order = np.argsort(columns[0], kind="stable")
            at, before, after, other, run, place = (c[order].astype(np.int64) for c in columns)
            doc = np.searchsorted(starts, at, side="right") - 1
            begin, stop, open_ = _stretches(at, before, after, doc, other < rank[doc], run, place)
            head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            for a, b in zip(head, np.concatenate((head[1:], [len(doc)]))):
                d, zero = doc[a], starts[doc[a]]
                left = np.flatnonzero(open_[a:b]) + a
                whole = np.unique(np.stack((begin[a:b], stop[a:b])), axis=1) - zero
                whole = whole[:, whole[1] - whole[0] >= LENGTH]
                out["rank"].append(rank[d])
                out["hash"].append(hashes[d])
                out["spots"].append(_pack((at[left] - zero).astype("<u4"), before[left].astype("u1"), after[left].astype("u1")) if len(left) else None)
                out["start"].append(whole[0].tolist())
                out["end"].append(whole[1].tolist())
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})

    sorted_runs = keyed.mapInArrow(runs, "part int, keys boolean, run long, blob binary")
    found = shared(sorted_runs.groupBy("part").applyInArrow(merged, "run long, keys boolean, blob binary"), "suffixes")
    spots = found.groupBy("run").applyInArrow(
        by_document, "rank long, hash long, spots binary, start array<bigint>, end array<bigint>"
    )
    return shared(spots, "suspects")


def _stretches(at, before, after, doc, usable, run, place):
    """For each anchor the copied stretch that it lies in, and whether strings of it reach beyond.

    Grams less than ``GRAM`` bytes apart that are as far apart in a smaller document overlap there
    too, so together they are a copy of it.
    """
    apart = np.diff(at)
    chained = usable[1:] & usable[:-1] & (doc[1:] == doc[:-1]) & (run[1:] == run[:-1])
    chained &= (np.diff(place) == apart) & (apart <= GRAM)
    head = np.flatnonzero(np.concatenate(([True], ~chained)))
    size = np.diff(np.concatenate((head, [len(at)])))
    begin = np.repeat(at[head], size)
    stop = np.repeat(at[head + size - 1] + GRAM, size)
    stop = np.where(usable, stop, begin)
    inside = usable & (at - after >= begin) & (at - before + LENGTH <= stop)
    return begin, stop, ~inside


def _surroundings(raw: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Bytes around anchors, as far as the strings reach that they are anchors of; zeros beyond."""
    column = np.arange(2 * _REACH + GRAM)
    use = (column >= _REACH - after[:, None].astype(np.int64)) & (column < _REACH + LENGTH - before[:, None].astype(np.int64))
    place = np.clip(at[:, None] + (column - _REACH), 0, len(raw) - 1)
    return np.where(use, raw[place], np.uint8(0))


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal rows together, and where each group starts in it."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for c in columns:
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(new)


def _as_words(full: np.ndarray) -> list[np.ndarray]:
    pad = np.zeros((full.shape[0], -(-full.shape[1] // 8) * 8), np.uint8)
    pad[:, : full.shape[1]] = full
    words = pad.view(np.uint64)
    return [words[:, k] for k in range(words.shape[1])]


_FOUND = "bucket int, rank long, hash long, place long, before int, after int, around binary"


def _settle(keyed: DataFrame, suspects: DataFrame, parts: int) -> DataFrame:
    """Surroundings of suspects: rows with a bucket are to be compared with those of other tasks; rows
    without are settled, every string of theirs being in a smaller document of the task."""
    spots = suspects.where("spots is not null").groupBy("rank", "hash").agg(F.collect_set("spots").alias("spots"))
    both = keyed.join(spots, ["rank", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            full, rank, hashes, place, before, after = (np.concatenate([h[k] for h in held]) for k in range(6))
            # In the order of a hash equals come together; each is compared with the one before. Others of
            # equal hash may part equals, which are then compared with those of other tasks.
            words = [*_as_words(full), before, after]
            order = np.lexsort((place, hashes, rank, _mixed(words)))
            same = np.zeros(len(order), bool)
            same[1:] = True
            for c in words:
                c = c[order]
                same[1:] &= c[1:] == c[:-1]
            # The first of equal surroundings is of the smallest document.
            least = rank[order][np.flatnonzero(~same)][np.cumsum(~same) - 1]
            settled = rank[order] > least
            bucket = _gram_bucket(full[order], parts)
            out_bucket = pa.array(np.where(settled, 0, bucket), pa.int32(), mask=settled)
            sent = np.ascontiguousarray(full[order[~settled]])
            ends = np.concatenate(([0], np.cumsum(~settled) * full.shape[1])).astype(np.int32)
            around = pa.Array.from_buffers(pa.binary(), len(order), [None, pa.py_buffer(ends), pa.py_buffer(sent)])
            return pa.RecordBatch.from_arrays(
                [
                    out_bucket, pa.array(rank[order]), pa.array(hashes[order]), pa.array(place[order]),
                    pa.array(before[order].astype(np.int32)), pa.array(after[order].astype(np.int32)), around,
                ],
                ["bucket", "rank", "hash", "place", "before", "after", "around"],
            )

        for batch in batches:
            ranks, hashes = batch.column("rank").to_numpy(), batch.column("hash").to_numpy()
            for k in range(batch.num_rows):
                raw = np.frombuffer(batch.column("text")[k].as_py().encode(), np.uint8)
                for blob in batch.column("spots")[k].as_py():
                    at, before, after = _unpack(blob, "<u4", "u1", "u1")
                    at = at.astype(np.int64)
                    n = len(at)
                    full = _surroundings(raw, at, before, after)
                    held.append((full, np.full(n, ranks[k]), np.full(n, hashes[k]), at, before, after))
                    size += n
                if size >= 200_000:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return both.mapInArrow(run, _FOUND)


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _gram_bucket(full: np.ndarray, parts: int) -> np.ndarray:
    h = _mixed(_as_words(np.ascontiguousarray(full[:, _REACH : _REACH + GRAM])))
    return (h % np.uint64(parts)).astype(np.int64)


def _compared(table):
    """Ranges of bytes whose strings are in a smaller document, from the surroundings of one bucket."""
    n = table.num_rows
    full = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint8).reshape(n, -1)
    rank, hashes, place = (table.column(c).to_numpy() for c in ("rank", "hash", "place"))
    before, after = table.column("before").to_numpy(), table.column("after").to_numpy()
    order, head = _grouped(*_as_words(np.ascontiguousarray(full[:, _REACH : _REACH + GRAM])))
    gram = np.empty(n, np.int64)
    gram[order] = np.repeat(np.arange(len(head)), np.diff(np.concatenate((head, [n]))))
    least, most = np.full(len(head), _LAST), np.full(len(head), -_LAST - 1)
    np.minimum.at(least, gram, rank)
    np.maximum.at(most, gram, rank)
    open_gram = (least < most)[gram]
    gone = np.zeros((n, _REACH + 2), bool)
    for o in range(_REACH + 1):
        use = np.flatnonzero(open_gram & (before <= o) & (after >= o))
        if not len(use):
            continue
        # The string that starts o bytes before the anchor: o bytes, the gram, the other bytes after it.
        sides = np.concatenate((full[use, _REACH - o : _REACH], full[use, _REACH + GRAM : 2 * _REACH + GRAM - o]), axis=1)
        order, head = _grouped(*_as_words(sides), gram[use])
        ranks = rank[use][order]
        low = np.minimum.reduceat(ranks, head)
        low = np.repeat(low, np.diff(np.concatenate((head, [len(order)]))))
        gone[use[order], o] = ranks > low
    begins = gone.copy()
    begins[:, 1:] &= ~gone[:, :-1]
    stops = gone.copy()
    stops[:, :-1] &= ~gone[:, 1:]
    row, first = np.nonzero(begins)
    _, last = np.nonzero(stops)
    return pa.table({"rank": rank[row], "hash": hashes[row], "start": place[row] - last, "end": place[row] - first + LENGTH})


def _joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1])) if len(starts) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    return starts[head], ends[np.concatenate((head[1:] - 1, [len(ends) - 1]))] if len(head) else ends[:0]


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """rank, hash (of the document), start, end: ranges of bytes to remove; they may overlap."""
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs)
    suspects = _suspects(keyed, parts)
    around = shared(_settle(keyed, suspects, parts), "around")
    own = around.where("bucket is null").select(
        "rank", "hash", (F.col("place") - F.col("after")).alias("start"), (F.col("place") - F.col("before") + LENGTH).alias("end")
    )
    copied = suspects.select("rank", "hash", F.explode(F.arrays_zip("start", "end")).alias("s")).select("rank", "hash", "s.start", "s.end")
    others = around.where("bucket is not null").groupBy("bucket").applyInArrow(_compared, "rank long, hash long, start long, end long")
    return own.unionByName(copied).unionByName(others)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Strings never cross documents and are judged on the input. A null text counts as empty; texts
    shorter than ``LENGTH`` bytes stay whole. Of rows with one doc_id none is smaller than the other, and a
    null doc_id is larger than all others. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    before = spark.conf.get(_CLEANUP)
    # What is exchanged for one written table is not needed after it.
    spark.conf.set(_CLEANUP, "true")
    try:
        ranges = repeated_ranges(docs)
        spans = ranges.groupBy("rank", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        spans = shared(spans.select("rank", "hash", "spans.start", "spans.end"), "spans")
    finally:
        spark.conf.set(_CLEANUP, before)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                piece = batch.slice(k, 512)
                rows = []
                for text, starts, ends in zip(piece.column("text"), piece.column("start"), piece.column("end")):
                    data = text.as_py().encode()
                    if starts.as_py() is None:
                        rows.append((len(data), 0, 0, data))
                        continue
                    a, b = _joined(np.array(starts.as_py(), np.int64), np.array(ends.as_py(), np.int64))
                    edges = [0, *np.stack((a, b), axis=1).ravel().tolist(), len(data)]
                    kept = b"".join(data[x:y] for x, y in zip(edges[0::2], edges[1::2]))
                    rows.append((len(data), len(data) - len(kept), len(a), kept))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *[pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], pa.array([r[3] for r in rows], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank"), F.xxhash64(text_of()).alias("hash"), text_of().alias("text"))
    both = keyed.join(spans, ["rank", "hash"], "left").select("doc_id", "text", "start", "end")
    return both.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
