"""Best-fit packing: rules, and the same choices as a plain search over all bins."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strataflow.llm.packing import best_fit, pack, pack_documents
from tests.llm import fixtures


def slow_best_fit(pieces, capacity, per_source):
    bins, out = [], [None] * len(pieces)
    for at in sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], i)):
        length, source, cluster = pieces[at]
        fits = [
            (b["room"], i) for i, b in enumerate(bins)
            if b["room"] >= length and (source is None or b["sources"][source] < per_source) and (cluster is None or cluster not in b["clusters"])
        ]
        if not fits:
            bins.append({"room": capacity, "sources": Counter(), "clusters": set(), "n": 0})
        which = min(fits)[1] if fits else len(bins) - 1
        b = bins[which]
        out[at] = (which, b["n"], capacity - b["room"])
        b["room"] -= length
        b["n"] += 1
        if source is not None:
            b["sources"][source] += 1
        if cluster is not None:
            b["clusters"].add(cluster)
    return out


def test_same_choices_as_a_plain_search():
    rng = random.Random(8)
    for _ in range(60):
        pieces = [(rng.randint(0, 50), rng.choice(["a", "a", "b", "c", None]), rng.choice([1, 2, 3, *range(9, 60), None])) for _ in range(rng.randint(0, 80))]
        per_source = rng.randint(1, 3)
        assert best_fit(pieces, 50, per_source) == slow_best_fit(pieces, 50, per_source)


def test_packing_a_table(spark):
    rows = fixtures.texts()
    got = pack_documents(fixtures.table(spark, rows), capacity=300).collect()
    words = Counter()
    for i, t in rows:
        words[i] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    packed, pieces, bins = Counter(), defaultdict(set), defaultdict(list)
    for r in got:
        packed[r.doc_id] += r.n_words
        pieces[r.doc_id].add(r.piece)
        bins[r.bin_id].append((r.position, r.start, r.n_words, r.doc_id))
    assert packed == words and {i for i, _ in rows} == set(pieces)
    source = {i: f"s{(i or 0) % 3}" for i, _ in rows if i != 11}
    for held in bins.values():
        held.sort()
        assert [h[0] for h in held] == list(range(len(held)))
        assert all(h[1] == sum(x[2] for x in held[:k]) for k, h in enumerate(held)) and sum(h[2] for h in held) <= 300
        assert max(Counter(source.get(h[3], h) for h in held).values()) <= 2


def test_copies_do_not_meet(spark):
    docs = spark.createDataFrame([(i, f"s{i}", i % 7) for i in range(70)], "doc_id long, source string, c long")
    got = pack(docs, F.lit(1), F.col("c"), capacity=50).collect()
    assert max(Counter((r.bin_id, r.doc_id % 7) for r in got).values()) == 1


def test_empty_table(spark):
    assert pack_documents(fixtures.table(spark, []).limit(0)).collect() == []
