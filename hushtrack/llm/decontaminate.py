"""Benchmark decontamination (operator 12).

Training texts are cut into shards of bounded size, each with an index of its words
(``fm_index.FMIndex``). Windows of benchmark words are searched backwards in each index, occurrences are
located by sampled positions, and what they cover is merged into spans to remove. Texts never cross the
network: a shard is made of rows that one task reads anyway.

Indexes name words by 44 bits of a hash, which can only find too much; what is found is compared word by
word with the text.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hushtrack.llm.common import shared, text_of
from hushtrack.llm.fm_index import MOST, FMIndex

#: Words of a window.
WINDOW = 10
#: Bytes of text in a shard, about.
SHARD_BYTES = 2 << 20
#: Bytes of benchmark texts that are broadcast at once; more are taken block by block.
PHRASE_BYTES = 32 << 20

# Words are made of these bytes of UTF-8 (digits, a to z, all that is not ASCII).
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers = {}

SHARD = "shard binary"
FOUND = "row long, doc_id {}, n_words long, spans array<struct<first_word:long,end_word:long,first_byte:long,end_byte:long>>, items array<string>"


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SHARD_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def _bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) byte of each word."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = _IS_WORD[text]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """44 bits of a polynomial hash of each word, by one running sum over the text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(text.astype(np.uint64) * _power(_BASE, len(text)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power(_UNBASE, len(text))[starts]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return (value ^ (value >> np.uint64(32))) >> np.uint64(20)


def _pieces(text: bytes, overlap: int, most: int) -> Iterator[tuple[bytes, int, int, np.ndarray, np.ndarray, bool]]:
    """(piece, its first byte, words before it, starts, ends, last one) of pieces that share ``overlap`` words.

    Only texts larger than a shard have more than one. A piece ends between words.
    """
    begin = words = 0
    size = most
    while True:
        gap = _GAP.search(text, begin + size) if begin + size < len(text) else None
        stop = gap.start() if gap else len(text)
        starts, ends = _bounds(np.frombuffer(text, np.uint8, stop - begin, begin))
        if stop < len(text) and len(starts) <= 2 * overlap:
            size *= 2  # a few very long words
            continue
        last = stop == len(text)
        yield text if last and not begin else text[begin:stop], begin, words, starts, ends, last
        if last:
            return
        again = len(starts) - overlap
        begin, words, size = begin + (int(starts[again]) if overlap else stop - begin), words + again, most


class _Shard:
    """Sequences gathered until they are worth an index."""

    def __init__(self) -> None:
        self.texts, self.rows, self.bytes, self.words = [], [], 0, 0

    def add(self, row: tuple, text: bytes, first_byte: int, first_word: int, starts: np.ndarray, ends: np.ndarray, last: bool) -> None:
        self.texts.append(text)
        self.rows.append((row, first_byte, first_word, starts, ends, last))
        self.bytes += len(text)
        self.words += len(starts) + 1

    def packed(self) -> bytes:
        sizes = np.array([len(r[3]) + 1 for r in self.rows])
        separators = np.cumsum(sizes) - 1
        parts = []
        for text, (_, _, _, starts, ends, _) in zip(self.texts, self.rows):
            parts += [_hashes(np.frombuffer(text, np.uint8), starts, ends), np.zeros(1, np.uint64)]
        hashes = np.concatenate(parts)
        words = np.zeros(len(hashes), np.int64)
        inside = np.ones(len(hashes), bool)
        inside[separators] = False
        keys = (hashes[inside] << np.uint64(20)) | np.flatnonzero(inside).astype(np.uint64)
        keys.sort()
        names = keys >> np.uint64(20)
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        words[keys & np.uint64(MOST - 1)] = np.cumsum(new)
        offsets = np.arange(len(words)) - np.repeat(separators + 1 - sizes, sizes)
        index = FMIndex.of(words, offsets, separators, int(new.sum()))
        return pickle.dumps((index.parts(), names[new], separators, self.rows, self.texts), protocol=5)


Batches = Iterator[pa.RecordBatch]


def _indexing(overlap: int, shard_bytes: int) -> Callable[[Batches], Batches]:
    """Batches of row, doc_id and text to shards: texts in lower case, their rows, the index of their words.

    A text larger than a shard is cut into pieces that share ``overlap`` words, so that each window
    lies in one piece.
    """

    def run(batches: Batches) -> Batches:
        def out(shard: _Shard) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard.packed()], pa.binary())], ["shard"])

        shard = _Shard()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts):
                text = text.as_py().translate(_LOWER)
                for piece, begin, words, starts, ends, last in _pieces(text, overlap, min(shard_bytes, 2 * MOST - 64)):
                    if shard.rows and (shard.bytes + len(piece) > shard_bytes or shard.words + len(starts) + 1 >= MOST):
                        yield out(shard)
                        shard = _Shard()
                    shard.add((row, doc_id), piece, begin, words, starts, ends, last)
        if shard.rows:
            yield out(shard)

    return run


def shards(docs: DataFrame, overlap: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard, of documents with row, doc_id and text (not null)."""
    return docs.select("row", "doc_id", "text").mapInArrow(_indexing(overlap, shard_bytes), SHARD)


class Phrases:
    """Distinct windows of benchmark texts and the items that have them."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int) -> None:
        self.items: list[str | None] = []
        of: dict[bytes, set[int]] = {}
        for item_id, text in items:
            words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
            if words:
                self.items.append(item_id)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                of.setdefault(b" ".join(words[k : k + window]), set()).add(len(self.items) - 1)
        self.windows = list(of)
        self.of = [sorted(v) for v in of.values()]
        split = [w.split(b" ") for w in self.windows]
        names = sorted({w for words in split for w in words})
        text = np.frombuffer(b" ".join(names), np.uint8)
        hashes = dict(zip(names, _hashes(text, *_bounds(text)).tolist())) if names else {}
        self.lengths = np.array([len(words) for words in split], np.int64)
        self.hashes = np.zeros((len(split), max(self.lengths, default=1)), np.uint64)
        for k, words in enumerate(split):
            self.hashes[k, self.hashes.shape[1] - len(words) :] = [hashes[w] for w in words]


def _occurrences(index: FMIndex, names: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Window and place in the shard of all occurrences."""
    filled = np.arange(phrases.hashes.shape[1]) >= phrases.hashes.shape[1] - phrases.lengths[:, None]
    at = np.minimum(np.searchsorted(names, phrases.hashes), len(names) - 1)
    known = np.flatnonzero(((names[at] == phrases.hashes) | ~filled).all(axis=1))
    low, high = index.search(np.where(filled, at + 1, 0)[known])
    sizes = np.maximum(high - low, 0)
    total = int(sizes.sum())
    rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
    return np.repeat(known, sizes), index.locate(rows)


def _finding(sent: Broadcast, whole: bool) -> Callable[[Batches], Batches]:
    """Shards to one row per text: row, doc_id, n_words, spans that windows cover, and the items found.

    A span has its first and last (exclusive) word and byte. Overlapping and adjoining spans are one.
    ``whole`` puts the pieces of a long text together, which needs the shards in the order they were
    made; otherwise there is one row per piece, and n_words counts up to its end.
    """
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.string()), ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("first_word", "end_word", "first_byte", "end_byte")]))),
        ("items", pa.list_(pa.string())),
    ])

    def found_in(packed: bytes) -> Iterator[tuple]:
        """(row, first word, number of words, spans, windows, last) of each sequence."""
        parts, names, separators, rows, texts = pickle.loads(packed)
        index = FMIndex.whole(parts)
        where, places = _occurrences(index, names, sent.value) if len(names) and sent.value.windows else (np.zeros(0, int), np.zeros(0, int))
        sequence = np.searchsorted(separators, places)
        order = np.argsort(sequence, kind="stable")
        cuts = np.searchsorted(sequence[order], np.arange(len(rows) + 1))
        for k, (row, first_byte, first_word, starts, ends, last) in enumerate(rows):
            spans, windows = [], set()
            mine = order[cuts[k] : cuts[k + 1]]
            begin = separators[k] - len(starts)
            for window, word in sorted(zip(where[mine].tolist(), (places[mine] - begin).tolist()), key=lambda x: x[1]):
                stop = word + int(sent.value.lengths[window])
                text = texts[k][starts[word] : ends[stop - 1]]
                if b" ".join(_WORD.findall(text)) == sent.value.windows[window]:
                    windows.add(window)
                    spans.append((first_word + word, first_word + stop, first_byte + int(starts[word]), first_byte + int(ends[stop - 1])))
            yield row, first_word, len(starts), merged(spans), windows, last

    def run(batches: Batches) -> Batches:
        words, spans, windows = 0, [], set()
        for batch in batches:
            for packed in batch.column("shard"):
                out = []
                for (row, doc_id), first_word, n, some, seen, last in found_in(packed.as_py()):
                    words, spans, windows = max(words, first_word + n), [*spans, *some], windows | seen
                    if last or not whole:
                        items = {sent.value.items[i] for w in windows for i in sent.value.of[w]} - {None}
                        names = ("first_word", "end_word", "first_byte", "end_byte")
                        out.append((row, None if doc_id is None else str(doc_id), words, [dict(zip(names, s)) for s in merged(spans)], sorted(items)))
                        words, spans, windows = 0, [], set()
                columns = [pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def merged(spans: list[tuple]) -> list[tuple]:
    """Spans by their start, those that overlap or adjoin as one."""
    out: list[tuple] = []
    for span in sorted(spans):
        if out and span[0] <= out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1] = (out[-1][0], span[1], out[-1][2], span[3])
        else:
            out.append(span)
    return out


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, phrase_bytes: int = PHRASE_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """What benchmark texts cover in documents; one row per row of ``docs``.

    Columns: doc_id, n_words, spans (array of first_word, end_word, first_byte, end_byte; ends exclusive,
    bytes of the UTF-8 text) and items (sorted ids, as strings, of the items with a window that occurs).
    A window is ``window`` consecutive words of an item, or all words of an item that has fewer. Words
    are ASCII digits, letters (A-Z lower-cased) and all that is not ASCII.

    Null and empty texts have no words. Rows are never merged: repeated ones give repeated results, a
    null doc_id stays null. Items without words have no window; an item without an id covers words but
    is not listed; equal ids count once. An empty table of items finds nothing. Other columns are ignored.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    blocks = max(1, -(-size // phrase_bytes))

    def phrases(block: int) -> Broadcast:
        # About ``phrase_bytes`` of items come to the driver at a time.
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        return docs.sparkSession.sparkContext.broadcast(Phrases([tuple(r) for r in part], window))

    schema, named = FOUND.format("string"), F.col("doc_id").cast(id_type)
    if blocks == 1:  # a shard is searched where it was made
        index, find = _indexing(window - 1, shard_bytes), _finding(phrases(0), whole=True)
        return rows.mapInArrow(lambda batches: find(index(batches)), schema).drop("row").withColumn("doc_id", named)
    index = shared(shards(rows, window - 1, shard_bytes), "fm-index")
    each = reduce(DataFrame.unionByName, [shared(index.mapInArrow(_finding(phrases(k), whole=False), schema), "found") for k in range(blocks)])
    together = each.groupBy("row").agg(
        F.first("doc_id").cast(id_type).alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("spans")
            spans = [[dict(zip(s[0], m)) for m in merged([tuple(x.values()) for x in s])] if s else [] for s in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(spans, batch.schema.field(at).type))

    return together.drop("row").mapInArrow(one, together.drop("row").schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes of the spans."""
    at, parts = 0, []
    for first, end in spans:
        parts.append(text[at:first])
        at = end
    return b"".join([*parts, text[at:]])


def cleaned(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with the spans that benchmark texts cover taken out of ``text``; all rows and columns stay.

    Needs a doc_id that is not repeated: spans meet their text by it, and rows without a doc_id
    or with a repeated one are refused.
    """
    hit = contaminated_spans(docs, benchmark, **options).where(F.size("spans") > 0)
    hit = shared(hit.select("doc_id", F.col("spans").alias("_spans")), "spans")
    if not hit.where(F.col("doc_id").isNull()).isEmpty() or not hit.groupBy("doc_id").count().where("count > 1").isEmpty():
        raise ValueError("doc_id must be given and unique where spans are removed")

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([
            t if s is None else without_spans(t.encode("utf-8", "surrogatepass"), [(x["first_byte"], x["end_byte"]) for x in s]).decode("utf-8", "surrogatepass")
            for t, s in zip(texts, spans)
        ])

    met = docs.join(hit, "doc_id", "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans"))
    return met.withColumn("text", text).select(*docs.columns)


def contaminated_sql(window: int = WINDOW) -> str:
    """The digest columns in DuckDB's SQL."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        i AS (SELECT cast(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
        wins AS (SELECT DISTINCT item, least(len(w), {window}) AS m, w[k:k + least(len(w), {window}) - 1] AS win
          FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
        grams AS (SELECT r, m, k, w[k:k + m - 1] AS win
          FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM wins))),
        hits AS (SELECT r, k, wins.m, item FROM grams JOIN wins ON grams.m = wins.m AND grams.win = wins.win),
        cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS p FROM hits) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
        SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cover USING (r) LEFT JOIN named USING (r)"""
