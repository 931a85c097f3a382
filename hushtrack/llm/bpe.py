"""BPE encoding and decoding with reuse of content-defined chunks (operator 1).

A rolling hash over the bytes of a text cuts it into chunks where the last bytes decide, so a passage
that occurs in many documents falls into the same chunks wherever it stands. A chunk that a task has
seen before is not encoded again; of a new chunk, only words that the task has not seen are. Cuts
fall anywhere, so the word around a join is broken: the join is repaired by encoding that word anew
and comparing with the encoding of a window that also holds a whole word from either side. Where they
disagree the window is the whole text, as it is for tokenizers that keep the blanks between words.

Chunks are reused within a task. Sending texts about, so that chunks meet over all tasks, would
shuffle the corpus to save a fraction of the encoding; so nothing is shuffled here.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hushtrack.llm.common import text_of

#: Chunks have 2**CHUNK_BITS bytes on average.
CHUNK_BITS = 10
#: Bytes of chunks, and number of words, that a task remembers at most; it forgets all at once.
CHUNK_MEMORY = 32 << 20
WORD_MEMORY = 250_000
_OUT_BYTES = 8 << 20
#: Characters that end a word for any tokenizer whose words hold no white space.
_BLANK = b" \t\n\r"
_TO_SPACE = bytes(0x20 if b in _BLANK else b for b in range(256))
#: How the tokenizers with word ends normalise and split. For such a tokenizer, words of
#: printable ASCII and Latin letters are split here and their pieces go straight to the model.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _splits_words(tokenizer) -> bool:
    config = json.loads(tokenizer.to_str())
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    split = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [s.get("type") for s in steps] == _NORMALIZERS
        and steps[1].get("content") == " "
        and len(split) == 2
        and split[0].get("pattern") == {"Regex": _SPLIT}
        and split[0].get("invert") is True
        and split[1].get("type") == "ByteLevel"
        and not split[1].get("use_regex")
        and not split[1].get("add_prefix_space")
        and config.get("decoder") is None
        and config.get("post_processor") is None
        and config["model"].get("type") == "BPE"
        and not config["model"].get("dropout")
    )


def _gear() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks of data: where the hash of the last 16 bytes has so many zero bits.

    Cuts do not split the bytes of a character; the last one is the end of data.
    """
    raw = np.frombuffer(data, np.uint8)
    h = _gear()[raw]
    for width in (1, 2, 4, 8):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    ends = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1
    ends = ends[ends < len(raw)].tolist()
    for k, end in enumerate(ends):
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        ends[k] = end
    return [*dict.fromkeys(e for e in ends if e < len(data)), len(data)]


def _letters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next from U+0100 on."""
    prints = [0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE for b in range(256)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if p else chr(next(rest)) for b, p in enumerate(prints)]


_LETTER = _letters()


class ChunkEncoder:
    """Encodes texts with a tokenizer of the tokenizers library, remembering chunks and words."""

    def __init__(self, tokenizer, bits: int = CHUNK_BITS):
        self.tokenizer, self.bits = tokenizer, bits
        self.joins = tokenizer.decoder is None
        self.model = tokenizer.model if _splits_words(tokenizer) else None
        # Chunks are encoded word by word, which suits tokenizers that drop the blanks between words.
        apart = b"".join(self.whole(w) for w in ("ab", "c"))
        self.drops_blanks = all(self.whole(f"ab{c}c{c}") == apart for c in map(chr, _BLANK))
        marks = [re.escape(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values()]
        self.marks = re.compile(b"|".join(marks) or b"(?!)")
        self.pieces: dict[str, tuple[bytes, str]] = {}
        self.words: dict[bytes, tuple[bytes, str]] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.held = 0
        self.agreed: set[tuple[bytes, bytes, bytes]] = set()
        self.encoded = self.reused = 0

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.words]
        if not new:
            return
        if len(self.words) + len(new) > WORD_MEMORY:
            self.words.clear()
            new = list(words)
        if self.model is not None:
            new = [w for w in new if not self._spell(w)]
            if not new:
                return
        found = self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        for w, e in zip(new, found):
            ids = e.ids
            told = self.tokenizer.decode(ids, skip_special_tokens=False) if self.joins and ids else ""
            self.words[w] = (struct.pack(f"<{len(ids)}I", *ids), told)

    def _spell(self, word: bytes) -> bool:
        """Encode a plain word from its pieces; False if it is for the whole tokenizer."""
        text = word.decode()
        if not _PLAIN.fullmatch(text) or self.marks.search(word):
            return False
        got = []
        for piece in _PIECE.findall(text.lower()):
            known = self.pieces.get(piece)
            if known is None:
                spelled = piece if piece.isascii() else "".join(map(_LETTER.__getitem__, piece.encode()))
                tokens = self.model.tokenize(spelled)
                known = (struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]), " ".join([t.value for t in tokens]))
                if len(self.pieces) >= WORD_MEMORY:
                    self.pieces.clear()
                self.pieces[piece] = known
            got.append(known)
        self.words[word] = got[0] if len(got) == 1 else (b"".join([i for i, _ in got]), " ".join([t for _, t in got]))
        return True

    def _chunk(self, chunk: bytes) -> tuple:
        """Before the first blank, after the last (None: no blank), first and last word between, ids, texts."""
        known = self.chunks.get(chunk)
        if known is not None:
            self.reused += 1
            return known
        self.encoded += 1
        parts = chunk.translate(_TO_SPACE).split(b" ")
        if len(parts) == 1:
            made = (chunk, None, b"", b"", b"", "")
        else:
            between = [w for w in parts[1:-1] if w]
            self._learn(set(between))
            got = [self.words[w] for w in between]
            told = " ".join([t for _, t in got if t]) if self.joins else ""
            made = (
                parts[0], parts[-1], between[0] if between else b"", between[-1] if between else b"",
                b"".join([i for i, _ in got]), told,
            )
        if self.held > CHUNK_MEMORY:
            self.chunks.clear()
            self.held = 0
        self.chunks[chunk] = made
        self.held += 4 * len(chunk) + 400
        return made

    def _agree(self, left: bytes, word: bytes, right: bytes) -> bool:
        """Whether a window over the join encodes as its words do one by one."""
        if not (left or right) or (left, word, right) in self.agreed:
            return True
        window = b" ".join(w for w in (left, word, right) if w)
        self._learn({w for w in (left, word, right) if w})
        apart = b"".join(self.words[w][0] for w in (left, word, right) if w)
        if self.whole(window.decode()) != apart:
            return False
        if len(self.agreed) < WORD_MEMORY:
            self.agreed.add((left, word, right))
        return True

    def encode(self, text: str) -> tuple[bytes, str]:
        """Token ids as little-endian unsigned 32-bit integers, and the decoded text."""
        if not self.drops_blanks:
            return self._plain(text)
        data = text.encode()
        ids: list[bytes] = []
        told: list[str] = []
        open_word, last = b"", b""
        at = 0
        for end in cut_points(data, self.bits) if data else []:
            head, tail, first, final, body, body_told = self._chunk(data[at:end])
            at = end
            open_word += head
            if tail is None:
                continue
            if not self._close(open_word, last, first, ids, told):
                return self._plain(text)
            ids.append(body)
            told.append(body_told)
            open_word, last = tail, final or last
        if not self._close(open_word, last, b"", ids, told):
            return self._plain(text)
        joined = b"".join(ids)
        if self.joins:
            return joined, " ".join([t for t in told if t])
        return joined, self.tokenizer.decode(np.frombuffer(joined, "<u4").tolist(), skip_special_tokens=False)

    def _close(self, word: bytes, left: bytes, right: bytes, ids: list[bytes], told: list[str]) -> bool:
        if not word:
            return True
        if not self._agree(left, word, right):
            return False
        self._learn({word})
        got = self.words[word]
        ids.append(got[0])
        told.append(got[1])
        return True

    def _plain(self, text: str) -> tuple[bytes, str]:
        ids = self.whole(text)
        return ids, self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def encoded(docs: DataFrame, tokenizer_path: str, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (binary, 32-bit little-endian), decoded.

    Encodes without adding special tokens (their strings in a text become special tokens, as the
    library has it) and decodes with them. A null text counts as empty and has no tokens. The
    tokenizer file is read once by the driver and travels with the tasks. Repeated rows get equal
    rows; an empty table gives an empty result; other columns are ignored.
    """
    with open(tokenizer_path, "rb") as f:
        # Bounded by the vocabulary: a few MB.
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(model.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        encoder = ChunkEncoder(tokenizer, chunk_bits)
        for batch in batches:
            start, size, out = 0, 0, []
            texts = batch.column("text")
            for k in range(len(texts)):
                out.append(encoder.encode(texts[k].as_py()))
                size += len(out[-1][0]) + len(out[-1][1])
                if size > _OUT_BYTES or k + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(start, len(out)),
                            pa.array([len(i) // 4 for i, _ in out], pa.int64()),
                            pa.array([i for i, _ in out], pa.binary()),
                            pa.array([t for _, t in out], pa.string()),
                        ],
                        ["doc_id", "n_tokens", "ids", "decoded"],
                    )
                    start, size, out = k + 1, 0, []

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
