"""Token counts and byte-level BPE against the libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from strataflow.llm import bpe
from strataflow.llm.token_count import prove, token_counts
from tests.llm import fixtures

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def strange(seed):
    rng = random.Random(seed)
    alphabet = "abc thé  \n\n\tÉß日本語한국어🎉👩‍👧 ▁  .,;'sS1234567890٣<s></s><unk><0x0A>the ing\r\x00\x0b"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return [*made, "a" * 3000, " " * 2000, "\n" * 99, "ab" * 1500, "日本" * 900, "▁▁a", " a", "a ", "  a  b  ", "\n a\n", "<s>", "</s> x", "don't we'll I'M"]


@pytest.fixture(scope="module")
def given():
    return [(r if r else None) if i % 50 else None for i, r in enumerate(strange(9))]


def test_counts_equal_the_library():
    pieces, model = prove(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in strange(1):
        assert pieces.tokens(text) == len(model.encode(text)), text[:50]


def test_proofs_hold():
    pieces, model = prove(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for word in random.Random(2).sample(sorted(pieces.known), 3000):
        assert pieces.known[word] == 1 and (not word or len(model.encode(word)) == 1)


def test_count_table(spark, given):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [*enumerate(given), *fixtures.texts()]
    got = token_counts(fixtures.table(spark, rows), MODEL, limit=20).collect()
    want = sorted((i or -1, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 20) for i, t in rows)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts(fixtures.table(spark, []).limit(0), MODEL).collect() == []


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_word_by_word():
    ranks = bpe.load_ranks(RANKS)
    rng = random.Random(6)
    words = ["".join(rng.choice("aeinrst éöв") for _ in range(rng.randint(1, 25))).encode() for _ in range(3000)] + [b"", b"aaaaaaa", bytes(range(256))]
    assert bpe.replay(words, ranks) == [bpe.encode_word(w, ranks) if w else [] for w in words]


def test_encoding_table(spark, given, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 2000)
    own = library()
    rows = [*enumerate(given), *fixtures.texts()]
    got = bpe.encoded(fixtures.table(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i or -1, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.encoded(fixtures.table(spark, []).limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
