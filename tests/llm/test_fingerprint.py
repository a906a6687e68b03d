"""Fingerprints: edited texts against slicing, likeness against the generalised Jaccard similarity, awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from strataflow.llm.fingerprint import fingerprints, likeness, signatures
from tests.llm import fixtures


def weights(text):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text) if w)


def jaccard(a, b):
    both = a.keys() | b.keys()
    return sum(min(a[w], b[w]) for w in both) / sum(max(a[w], b[w]) for w in both) if both else 1.0


def edited(text, following):
    m = len(text) // 2
    return text[: len(text) - m] + following[:m]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    assert len(got) == len(rows)
    off = []
    by_text = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        new, r = edited(text, following), got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint and len(r.fingerprint) <= 384
        off += [r.near_edited - jaccard(weights(text), weights(new)), r.near_next - jaccard(weights(text), weights(following))]
    assert abs(np.mean(off)) < 0.03 and np.sqrt(np.mean(np.square(off))) < 0.08


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = fixtures.texts()
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints(fixtures.table(spark, rows)).collect())
    # Rows that repeat key and text are one document in the order; rows of one key have some order among them.
    names = {(i is not None, i or 0, t or "") for i, t in rows}
    shared = {i for _, i, _ in names if sum(n[1] == i for n in names) > 1 and i} | {0}
    order = sorted(names)
    firm = 0
    for k, (keyed, i, text) in enumerate(order):
        after = order[(k + 1) % len(order)]
        if i in shared or after[1] in shared:
            continue
        firm += 1
        assert (i, len(text), hashlib.sha256(edited(text, after[2]).encode()).hexdigest()) in got
    assert firm > 50 and sum(got.values()) == len(rows)
    one = fingerprints(fixtures.table(spark, [(5, "a b c d")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)] and one[0].edited_sha256 == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest()
    blank = fingerprints(fixtures.table(spark, [(1, None), (2, " ")])).collect()
    assert [(r.fingerprint, r.near_edited, r.near_next) for r in blank] == [("", 1.0, 1.0)] * 2
    assert fingerprints(fixtures.table(spark, []).limit(0)).collect() == [] and rng


def test_likeness_of_skewed_texts(spark):
    """One word that holds most of the weight, and texts of few distinct words."""
    few = [f"w{i}" for i in range(63)]
    heavy, light = " ".join(["a"] * 1000 + few), " ".join(["a", *few])
    rng = random.Random(8)
    counts = [(rng.randint(1, 900), rng.randint(1, 900)) for _ in range(8)]
    one, two = (" ".join(f"v{i}" for i, n in enumerate(counts) for _ in range(n[k])) for k in (0, 1))
    rows = [(1, heavy, light), (2, one, two), (3, "x y", "x z"), (4, "", "x"), (5, "", " ")]
    rows += [(100 + i, " ".join(f"{i}_{w}" for w in one.split()), " ".join(f"{i}_{w}" for w in two.split())) for i in range(30)]
    rows += [(200 + i, f"{heavy} ".replace("a ", f"{i}a "), f"{light} ".replace("a ", f"{i}a ")) for i in range(30)]
    table = spark.createDataFrame(rows, "k long, a string, b string").repartition("k")
    signed = signatures(table, ["k"], ["a", "b"])
    got = {r.k: r for r in signed.select("k", "a", "b", likeness(signed.a, signed.b).alias("near")).collect()}
    assert [len(got[k].a) for k in (1, 2, 3)] == [64] * 3 and len(got[4].b) == 64 and got[4].a is None and got[4].near == 0
    for first, (a, b) in ((100, rows[1][1:]), (200, rows[0][1:])):
        want = jaccard(weights(a), weights(b))
        assert abs(np.mean([got[first + i].near for i in range(30)]) - want) < 0.05
