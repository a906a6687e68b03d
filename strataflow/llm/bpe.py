"""Byte-level BPE by merge replay over the words of a corpus.

A task gathers the distinct words (matches of the splitting pattern) of its texts, up to a bounded amount of text at a
time, and lays their bytes out as one array of symbols with links to the neighbours. An inverted index leads from token
pairs to the positions where they stand; pairs that spell the same token share an entry. All merges are then replayed
in rank order over all words at once: the entry of the rank is read, positions that no longer hold are skipped, the
others merge, and only the pairs with their neighbours enter the index anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose words are replayed together; a longer text goes alone.
CHUNK_BYTES = 24 << 20
RESULT = "doc long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@dataclass
class Ranks:
    tokens: list[bytes]  # by id
    whole: dict[bytes, int]
    byte_id: np.ndarray
    codes: np.ndarray  # sorted: left id << 32 | right id of every pair that spells a token
    merged: np.ndarray  # the id of that token

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair spells, or -1."""
        code = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, self.merged[at], -1)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    """Read a rank file; ids are ranks. Every split of a token into two tokens is a pair that merges to it."""
    with open(path, "rb") as lines:
        whole = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = [b""] * (max(whole.values()) + 1)
    for token, i in whole.items():
        tokens[i] = token
    codes, merged = [], []
    for token, i in whole.items():
        for cut in range(1, len(token)):
            left, right = whole.get(token[:cut]), whole.get(token[cut:])
            if left is not None and right is not None:
                codes.append(left << 32 | right)
                merged.append(i)
    order = np.argsort(np.array(codes, dtype=np.int64))
    return Ranks(tokens, whole, np.array([whole[bytes([b])] for b in range(256)], dtype=np.int32), np.array(codes, dtype=np.int64)[order], np.array(merged, dtype=np.int32)[order])


def encode_word(word: bytes, ranks: Ranks) -> list[int]:
    """The merges of one word, lowest rank first, leftmost first."""
    if word in ranks.whole:
        return [ranks.whole[word]]
    parts = [bytes([b]) for b in word]
    while True:
        best = min(((ranks.whole.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            return [ranks.whole[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def _apart(spots: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of sorted positions, those that merge when two that share a symbol cannot both: from left to right."""
    clash = np.zeros(len(spots), dtype=bool)
    clash[1:] = after[spots[:-1]] == spots[1:]
    if not clash.any():
        return spots
    keep = np.ones(len(spots), dtype=bool)
    for i in np.flatnonzero(clash).tolist():
        keep[i] = not keep[i - 1]
    return spots[keep]


def replay(words: list[bytes], ranks: Ranks) -> list[list[int]]:
    """The ids of each word, all merged together in rank order."""
    out: list = [None] * len(words)
    rest = []
    for i, word in enumerate(words):
        one = ranks.whole.get(word)
        if one is not None:
            out[i] = [one]
        elif word:
            rest.append(i)
        else:
            out[i] = []
    if not rest:
        return out
    sizes = np.array([len(words[i]) for i in rest], dtype=np.int64)
    symbol = ranks.byte_id[np.frombuffer(b"".join(words[i] for i in rest), dtype=np.uint8)].copy()
    n = len(symbol)
    word_of = np.repeat(np.arange(len(rest), dtype=np.int32), sizes)
    first = np.cumsum(sizes) - sizes
    after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
    after[first + sizes - 1] = n
    before[first] = -1
    # A symbol behind the last one matches no pair.
    symbol = np.append(symbol, np.int32(-1))
    after = np.append(after, n)
    index: dict[int, list[np.ndarray]] = defaultdict(list)

    def enter(spots: np.ndarray, least: int) -> np.ndarray:
        """Put the pairs at some positions into the index; positions whose pair has a rank below `least`."""
        follow = after[spots]
        spots, follow = spots[follow < n], follow[follow < n]
        rank = ranks.lookup(symbol[spots], symbol[follow])
        spots, rank = spots[rank >= 0], rank[rank >= 0]
        if not len(spots):
            return spots
        order = np.argsort(rank, kind="stable")
        spots, rank = spots[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for r, a, b in zip(rank[starts].tolist(), starts, [*starts[1:], len(spots)]):
            index[r].append(spots[a:b])
        return spots[rank < least]

    enter(np.arange(n, dtype=np.int64), 0)
    late: set[int] = set()
    for r in range(len(ranks.tokens)):
        if r not in index:
            continue
        found = index.pop(r)
        spots = np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
        follow = after[spots]
        holds = (symbol[spots] >= 0) & (follow < n)
        holds[holds] = ranks.lookup(symbol[spots[holds]], symbol[follow[holds]]) == r
        spots = _apart(spots[holds], after)
        if not len(spots):
            continue
        gone = after[spots]
        symbol[spots] = r
        symbol[gone] = -1
        after[spots] = after[gone]
        inner = after[spots]
        before[inner[inner < n]] = spots[inner < n]
        left = before[spots]
        touched = np.unique(np.concatenate((spots, left[left >= 0])))
        early = enter(touched, r)
        if len(early):
            late.update(word_of[early].tolist())
    alive = np.flatnonzero(symbol[:n] >= 0)
    ids, owner = symbol[alive], word_of[alive]
    bounds = np.searchsorted(owner, np.arange(len(rest) + 1)).tolist()
    flat = ids.tolist()
    for k, i in enumerate(rest):
        # A merge that made a pair of lower rank came too late for the replay; such words are merged one by one.
        out[i] = encode_word(words[i], ranks) if k in late else flat[bounds[k] : bounds[k + 1]]
    return out


def _encoder(path: str, pattern: str):
    def run(batches):
        ranks = load_ranks(path)
        split = regex.compile(pattern).findall
        held: list[tuple[int | None, np.ndarray]] = []
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        size = 0

        def flush():
            words = [w.encode() for w in number]
            ids = replay(words, ranks)
            raw = [np.array(x, dtype="<u4").tobytes() for x in ids]
            back = [b"".join([ranks.tokens[i] for i in x]) for x in ids]
            counts = np.array([len(x) for x in ids], dtype=np.int64)
            rows: tuple[list, ...] = ([], [], [], [])
            for doc, at in held:
                spots = at.tolist()
                values = (doc, int(counts[at].sum()), hashlib.sha256(b"".join([raw[i] for i in spots])).hexdigest(), hashlib.sha256(b"".join([back[i] for i in spots])).hexdigest())
                for column, value in zip(rows, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["doc", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = split(text or "")
                held.append((doc, np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found))))
                size += len(text or "")
                if size > CHUNK_BYTES:
                    yield flush()
                    held.clear()
                    number.clear()
                    size = 0
        if held:
            yield flush()

    return run


def encoded(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every row: the text split by the pattern, each match encoded by the
    ranks, without special tokens; the hash of the ids as little-endian unsigned 32-bit integers, and that of the bytes
    that the ids decode to. Null and empty texts have no ids. Repeated rows and rows without a key are encoded each; an
    empty table gives an empty result; other columns are not looked at. The rank file is read in every Python worker
    from the same path."""
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return texts.mapInArrow(_encoder(path, pattern), RESULT).withColumnRenamed("doc", key)


def encode_ids(words: list[str], path: str) -> list[list[int]]:
    """The ids of some matches of the pattern."""
    return replay([w.encode() for w in words], load_ranks(path))
