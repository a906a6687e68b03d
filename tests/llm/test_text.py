"""Words and shingles of whole columns against Python's own splitting."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strataflow.llm import text as T


def columns():
    rng = random.Random(1)
    alphabet = "ab CÉé\t\n\x0b\x0c\r \xa0日.,'9"
    return [None, "", " ", "a", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)), "x " * 3000]


@pytest.mark.parametrize("between, pattern", [(T.WHITE, r"[^\x20\x09-\x0D]+"), (T.NO_LETTER, r"[a-z0-9\x80-\U0010ffff]+")])
def test_words(between, pattern):
    found, firsts = T.words(*T.buffers(pa.array(columns())), between)
    want = [re.findall(pattern, re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")) for t in columns()]
    assert np.diff(firsts).tolist() == [len(w) for w in want]
    names = {}
    for word, h in zip((w for ws in want for w in ws), found.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_slices_and_offsets_give_the_same_words():
    data = pa.array(columns())
    whole, _ = T.words(*T.buffers(data))
    part, _ = T.words(*T.buffers(data.slice(100, 150)))
    _, firsts = T.words(*T.buffers(data))
    assert part.tolist() == whole[firsts[100] : firsts[250]].tolist()
    _, offsets = T.buffers(data)
    spans = list(T.slices(offsets, 200))
    assert [a for a, _ in spans[1:]] == [b for _, b in spans[:-1]] and spans[0][0] == 0 and spans[-1][1] == len(data)


def test_shingles():
    data = [t or "" for t in columns()]
    sets = T.shingles(*T.words(*T.buffers(pa.array(data))), 5)
    names = {}
    for text, tokens in zip(data, sets):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        want = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        assert len(tokens) == len(want) and (np.diff(tokens.astype(object)) > 0).all()
        names.setdefault(frozenset(want), tuple(tokens.tolist()))
        assert names[frozenset(want)] == tuple(tokens.tolist())
