"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from strataflow.llm.spelling import corpus_words, near_words, spelling_groups
from tests.llm import fixtures


def lower(run):
    return re.sub("[A-Z]", lambda m: m[0].lower(), run)


def counts(rows, garbled):
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if garbled and h % garbled == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(words, ratio=5):
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    form = {}
    for w, around in near.items():
        top = min(around, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = top if top is not None and words[top] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), form[w] and words[form[w]]))
    return out


def frame(spark, words):
    return spark.createDataFrame(list(words.items()) or [("x", 1)], "word string, n long").limit(len(words))


def test_words_of_all_texts(spark):
    rng = random.Random(2)
    rows = fixtures.texts() + [(i, " ".join(rng.choice(["Straße-Öffnung", "ÖFFNUNG", "öffnung1öffnung", "a÷bcdefg", "ABCDEF", "naïveté", "Привет", "éclair"]) for _ in range(60))) for i in range(700, 730)]
    docs = fixtures.table(spark, rows)
    for garbled in (None, 7):
        assert {r.word: r.n for r in corpus_words(docs, garbled=garbled).collect()} == counts(rows, garbled)


def test_groups_of_random_words(spark):
    """Short alphabets, all lengths from 1 on, so that words have many neighbours, and chains of forms."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 6, 7, 8, 9]))): 5 * 6 ** rng.randrange(6) + rng.randrange(3) for _ in range(900)}
    long = "".join(rng.choice("abcdefgh") for _ in range(40))
    words |= {long: 5000, long[:20] + long[21:]: 600, long[:20] + "z" + long[21:]: 600, "q" + long: 20, long + "q": 20, long[1:]: 20}
    assert {tuple(r) for r in spelling_groups(frame(spark, words)).collect()} == groups(words)


def test_every_pair_once(spark):
    rng = random.Random(6)
    words = {"".join(rng.choice("xyz") for _ in range(rng.choice([5, 6, 7]))): 5 for _ in range(400)}
    pairs = [(r.a, r.b) for r in near_words(frame(spark, words)).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if (len(a), a) < (len(b), b) and one_edit(a, b)}


def test_a_frequent_chunk_makes_no_large_group(spark):
    """Thousands of words that share their first half: no key holds more than a few of them."""
    from strataflow.llm import spelling
    from pyspark.sql import functions as F

    rng = random.Random(7)
    words = {"prefix" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)): 5 for _ in range(4000)}
    keyed = spelling._keyed(frame(spark, words).withColumn("size", F.char_length("word")), "chunks")
    assert keyed.groupBy("k").count().agg(F.max("count")).first()[0] <= 40


def test_no_table_is_broadcast(spark):
    """With a limit of one byte a broadcast raises an error: however small Spark takes a table for, joins do without."""
    rng = random.Random(8)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([6, 7, 8]))): 5 * 6 ** rng.randrange(6) for _ in range(500)}
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1b")
    try:
        found = {tuple(r) for r in spelling_groups(frame(spark, words)).collect()}
    finally:
        spark.conf.set(limit, before)
    assert found == groups(words) and any(root != form for _, form, root, *_ in found if form)


def test_awkward_words(spark):
    assert spelling_groups(frame(spark, {})).collect() == []
    docs = fixtures.table(spark, []).limit(0)
    assert corpus_words(docs).collect() == []
    odd = spark.createDataFrame([(None, 9), ("lonely", 5)], "word string, n long")
    assert {tuple(r) for r in spelling_groups(odd).where("word is not null").collect()} == {("lonely", None, "lonely", 5, 0, None)}
