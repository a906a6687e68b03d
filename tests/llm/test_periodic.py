"""Runs of words against a search over all periods."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataflow.llm.periodic import find_runs, periodic_runs
from strataflow.llm.queries import QUERIES
from tests.llm import fixtures


def all_runs(t, least=6):
    """(start, end, smallest period) by trying every period at every place."""
    best = {}
    for q in range(1, len(t) // 2 + 1):
        i = 0
        while i < len(t) - q:
            j = i
            while j < len(t) - q and t[j] == t[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in best.items())


def told(doc, text, planted):
    """What the contract asks of one row."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode())
    if planted and doc is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [(s, e - s, q) for s, e, q in all_runs(words, 12)]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def joined(texts):
    """Numbers of words of several texts, each followed by a value of its own, and where texts begin."""
    t, bounds = [], [0]
    for i, words in enumerate(texts):
        t += [*words, 1000 + i]
        bounds.append(len(t))
    return np.array(t, dtype=np.int64), np.array(bounds)


def check(texts):
    t, bounds = joined(texts)
    want = [(s + b, e + b, q) for words, b in zip(texts, bounds.tolist()) for s, e, q in all_runs(words)]
    assert find_runs(t, bounds) == sorted(want)


repeats = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=45), st.integers(1, 9)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(repeats, min_size=1, max_size=3))
def test_texts_of_repeated_pieces(texts):
    check([[w for piece, n in text for w in piece * n] for text in texts])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 3), st.integers(9, 120)), min_size=2, max_size=6), st.integers(1, 3))
def test_touching_regions_of_small_period(regions, times):
    """Regions of one small period in different phases, where long periods are highly periodic themselves."""
    check([[(turn + i) % p for p, turn, n in regions for i in range(n)] * times])


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1200:
        a, b = b, b + a
    check([b, a[:700], [0] * 900])


@pytest.mark.parametrize("planted", [False, True])
def test_whole_table(spark, planted):
    rng = random.Random(4)
    rows = [r for r in fixtures.texts() if len(r[1] or "") < 20_000]
    for at in range(500, 560):
        unit = fixtures.prose(rng, rng.randint(1, 90))
        rows.append((at, " ".join(fixtures.prose(rng, 7) + unit * rng.randint(2, 5) + unit[: rng.randrange(len(unit))] + fixtures.prose(rng, 5))))
    got = periodic_runs(fixtures.table(spark, rows), planted=planted)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(got.select(names).collect()) == Counter(told(i, t, planted) for i, t in rows)
    assert hashlib.sha256(got.where("doc_id = 500").first()["collapsed"].encode()).hexdigest() == got.where("doc_id = 500").first()["collapsed_sha256"]


def test_long_text(spark):
    """A text of 60,000 words with two runs far apart, the longer over 20,000 words."""
    rng = random.Random(9)
    unit = [str(rng.random()) for _ in range(10_000)]
    words = [str(rng.random()) for _ in range(15_000)] + unit * 2 + unit[:7] + [str(rng.random()) for _ in range(25_000)] + ["a", "b"] * 8
    row = periodic_runs(spark.createDataFrame([(7, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(15_000, 20_007, 10_000), (60_007, 16, 2)] and len(row["collapsed"].split()) == len(words) - 10_007 - 14


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert all(got[i] == told(i, t, True) for i, t in rows)


def test_empty_table(spark):
    assert periodic_runs(fixtures.table(spark, []).limit(0)).collect() == []
