import os
import random
import struct

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from hushtrack.llm.bpe import ChunkEncoder, cut_points, encoded  # noqa: E402


def load(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def tokenizer():
    return load("word_bpe_49k.json")


def library(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), tokenizer.decode(ids, skip_special_tokens=False)


def test_table(spark, messy, messy_rows, tokenizer, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = encoded(messy, path, chunk_bits=6).collect()
    want = [(r[0], *library(tokenizer, r[1] or "")) for r in messy_rows]
    assert sorted([(r.doc_id, bytes(r.ids), r.decoded) for r in got], key=str) == sorted(want, key=str)
    assert all(4 * r.n_tokens == len(r.ids) for r in got)
    assert encoded(nothing, path).count() == 0


# Small chunks cut nearly every word; the byte-level tokenizer keeps blanks, so it takes whole texts.
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("bits", [2, 5, 10])
def test_joins(name, bits):
    tokenizer, rng = load(name), random.Random(bits)
    letters = "abE'sdreé ÀßK1!?<|>endoftext \n\t.-_Üñ́ ſΣ\x0b"
    encoder = ChunkEncoder(tokenizer, bits)
    texts = ["", " ", "don't 'RE <|endoftext|>x <|startoftext|>", "é" * 500, "é ́x" * 50, "w" * 3000, "ab cd " * 300]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(250)]
    for text in texts + texts[:20]:
        assert encoder.encode(text) == library(tokenizer, text), repr(text)
    assert (encoder.reused > 0) == encoder.drops_blanks == (name == "word_bpe_49k.json")


def test_shared_passages_share_chunks(tokenizer):
    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice(["erth", "tion", "the", "of", "anly"]) for _ in range(n))
    passage = say(3000)
    encoder = ChunkEncoder(tokenizer, 7)
    encoder.encode(say(7) + passage)
    made = encoder.encoded
    encoder.encode(say(11) + " " + passage + say(5))
    assert encoder.encoded - made < made / 4


def test_cuts_follow_content():
    rng = random.Random(4)
    data = bytes(rng.randrange(256) for _ in range(5000))
    ends = set(cut_points(data, 6))
    moved = {e - 100 for e in cut_points(data[:100] + data, 6)}
    assert len(ends & moved) > 0.9 * len(ends)
    text = ("é" * 400).encode()
    assert all(text[:e].decode() is not None for e in cut_points(text, 2))
