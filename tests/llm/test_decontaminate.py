"""Benchmark hits against a scan of all windows of words."""

import hashlib
import random
import re
from collections import Counter

import pytest

from strataflow.llm.decontaminate import GramSet, contamination, decontaminate, grams, with_hits
from tests.llm import fixtures

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


def hit_words(text, items):
    """Words of a text inside an occurrence of a window, and the items whose windows occur."""
    w, hit, found = words(text), set(), set()
    for key, said in items:
        v = words(said)
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                if key is not None:
                    found.add(str(key))
    return len(w), hit, sorted(found)


def expected(rows, items):
    out = Counter()
    for i, t in rows:
        n, hit, found = hit_words(t, items)
        out[i, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)] += 1
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(12)
    items = [(k, " ".join(fixtures.prose(rng, rng.randint(11, 40)))) for k in range(8, 14)]
    items += [(1, None), (2, ""), (3, "--- ..."), (4, "Short one"), (5, items[0][1]), (5, "short, ONE"), (None, items[3][1] + " more"), (100, "été ça va 12 34"), (11, "added to eleven " * 5)]
    rows = [r for r in fixtures.texts() if len(r[1] or "") < 20_000]
    at = 900
    for key, said in [*items, *items]:
        if said:
            w = said.split()
            cut = w[rng.randrange(3) :] if len(w) > 12 else w
            rows.append((at, "Before. " + ",\t".join(x.upper() if rng.random() < 0.3 else x for x in cut) + "! behind " + " ".join(fixtures.prose(rng, rng.randint(0, 30)))))
            at += 1
    shared = [(950 + i, " ".join([*fixtures.prose(rng, 4), items[0][1], *fixtures.prose(rng, 3), items[1][1]])) for i in range(60)]
    return rows + shared + shared[:20], items


def table_of(spark, items):
    return spark.createDataFrame([(k, t, "x", "y") for k, t in items], "item_id long, text string, items string, h string")


@pytest.mark.parametrize("most", [1 << 18, 5], ids=["broadcast", "joined"])
def test_whole_table(spark, tables, most):
    rows, items = tables
    got = contamination(fixtures.table(spark, rows), table_of(spark, items), most=most)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows, items)


@pytest.mark.parametrize("most", [1 << 18, 5], ids=["broadcast", "joined"])
def test_spans_and_documents_go(spark, tables, most):
    rows, items = tables
    docs, bench = fixtures.table(spark, rows), table_of(spark, items)
    left = decontaminate(docs, bench, most=most)
    assert left.columns == docs.columns
    want = Counter()
    for i, t in rows:
        _, hit, _ = hit_words(t, items)
        want[i, tuple(w for at, w in enumerate(words(t)) if at not in hit)] += 1
    assert Counter((r.doc_id, tuple(words(r.text))) for r in left.collect()) == want
    clean = decontaminate(docs, bench, whole=True, most=most)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter((i, t) for i, t in rows if not hit_words(t, items)[1])


def test_untouched_texts_keep_their_bytes(spark):
    docs = spark.createDataFrame([(1, "  a b\n c  "), (2, "say short ONE, then. go"), (3, "short one"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate(docs, spark.createDataFrame([(1, "short one")], "item_id long, text string")).collect()}
    assert got == {1: "  a b\n c  ", 2: "say , then. go", 3: "", 4: None}


def test_equal_hashes_are_verified():
    """Windows whose hash is known but whose words differ do not hit; n-grams with one hash are told apart."""
    import numpy as np

    known = GramSet(np.array([7, 7, 9], dtype=np.uint64), np.array([2, 2, 2]), [b"a b", b"c d", b"e f"], [["1"], ["2"], ["3"]])
    assert known.items[known.verified(np.uint64(7), b"c d")] == ["2"] and known.verified(np.uint64(7), b"e f") is None


def test_empty_tables(spark, tables):
    rows, items = tables
    none = fixtures.table(spark, []).limit(0)
    assert contamination(none, table_of(spark, items)).collect() == []
    empty = table_of(spark, items).limit(0)
    got = contamination(fixtures.table(spark, rows), empty)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows, [])
    assert grams(empty).collect() == [] and with_hits(none, empty, "f").columns[-1] == "f"
