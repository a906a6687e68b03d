"""The n-gram Jaccard join against all pairs compared."""

import random

import numpy as np
import pytest

from strataflow.llm import jaccard_join as J
from strataflow.llm.components import components
from strataflow.llm.text import U64
from tests.llm import fixtures


@pytest.mark.parametrize("small_bucket, block", [(8, 1024), (2, 16)])
def test_links_and_components(spark, monkeypatch, small_bucket, block):
    monkeypatch.setattr(J, "SMALL_BUCKET", small_bucket)
    monkeypatch.setattr(J, "BLOCK", block)
    rows = fixtures.texts()
    got = J.jaccard_components(fixtures.table(spark, rows)).collect()
    want = fixtures.components(rows)
    assert sorted((r.doc_id or -1, r.n_shingles) for r in got) == sorted((i or -1, len(fixtures.shingles(t))) for i, t in rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want.get(i)) for i, _ in rows}


def test_empty_table(spark):
    assert J.jaccard_components(fixtures.table(spark, []).limit(0)).collect() == []


def test_similarity_bound_is_exact(spark):
    """15 of 20 shared shingles link, 14 of 20 do not."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:22])), (2, " ".join(words[:19])), (3, " ".join(words[30:52])), (4, " ".join(words[30:48])), (5, " ".join(words[30:49]) + " x y")]
    got = {r.doc_id: r.component_id for r in J.jaccard_components(fixtures.table(spark, rows)).collect()}
    assert got == fixtures.components(rows)


def test_sketches_bound_the_symmetric_difference():
    random_ = np.random.default_rng(1)
    for _ in range(300):
        n = int(random_.integers(1, 700))
        a = np.unique(random_.integers(0, 2**63, n, dtype=U64) * U64(2))
        b = np.unique(np.concatenate((random_.choice(a, max(1, n * 4 // 5), replace=False), random_.integers(0, 2**63, n // 6, dtype=U64))))
        gap = len(np.setxor1d(a, b))
        assert J.distance(J.bit_sketch(a), J.bit_sketch(b)) <= gap
        k = J.band(min(len(a), len(b)))
        left, right = J.cells(a, k), J.cells(b, k)
        assert len(left) - len(np.intersect1d(left, right)) <= gap


def test_similar_sets_send_an_equal_cell():
    random_ = np.random.default_rng(2)
    none = np.zeros(0, U64), np.zeros(0, np.int64)
    met = 0
    for _ in range(2000):
        n = int(random_.integers(1, 300))
        a = np.unique(random_.integers(0, 2**63, n, dtype=U64) * U64(2))
        keep = random_.choice(a, max(1, len(a) - int(random_.integers(0, max(1, n // 7) + 1))), replace=False)
        b = np.unique(np.concatenate((keep, random_.integers(0, 2**63, int(random_.integers(0, max(1, n // 8) + 1)), dtype=U64))))
        if J._similar(a, b):
            met += 1
            assert len(np.intersect1d(J.sent(a, *none), J.sent(b, *none)))
    assert met > 500


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(500, 500)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}


def test_links_of_a_key_with_many_texts(spark):
    """One key is the smallest of many unlike sets; each has near copies under keys of their own. Empty texts of a key
    follow it."""
    rng = random.Random(6)
    rows = [(0, ""), (70, " "), (71, None)]
    for i in range(30):
        words = fixtures.prose(rng, 60)
        rows.append((0 if i % 3 else 70, " ".join(words)))
        rows += [(100 + 2 * i + k, " ".join([*words[: -1 - k], f"x{k}"])) for k in (0, 1)]
    want = fixtures.components(rows)
    assert len(set(want.values())) == 3
    got = J.jaccard_components(fixtures.table(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want[i]) for i, _ in rows} and len(got) == len(rows)


def test_sets_that_share_their_first_name(spark):
    """With first names of six bits most sets share theirs; the second name tells them apart."""
    rows = fixtures.texts()
    want = fixtures.components(rows)
    got = J.jaccard_components(fixtures.table(spark, rows), name_bits=6).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {(i, want.get(i)) for i, _ in rows}


def test_large_bucket_of_unlike_documents(spark):
    """5,000 documents share a template, each just too far from the others to link, but for a few planted pairs. All meet
    in large buckets. Groups hold two blocks at most, and the planted pairs alone are linked."""
    rng = random.Random(8)
    template = fixtures.prose(rng, 40)
    rows = [(i, " ".join([*template, *[f"{w}{i}" for w in "abcdefgh"]])) for i in range(5000)]
    pairs = {7: 4990, 2500: 2501, 1024: 3072}
    for a, b in pairs.items():
        rows[b] = (b, rows[a][1] + " z")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(fixtures.table(spark, rows)).collect()}
    sets = [fixtures.shingles(t) for _, t in rows]
    assert 100 * len(sets[0] & sets[1]) < 75 * len(sets[0] | sets[1])
    assert got == {i: i for i in range(5000)} | {b: a for a, b in pairs.items()}

    mixed = spark.range(5000).selectExpr("1L AS cell", "id AS doc", "id AS component", "0L AS main", "5000L AS members", "1L AS inside")
    groups = J._dealt(mixed).groupBy("cell", "at").count().collect()
    assert max(r["count"] for r in groups) < 2.5 * J.BLOCK and len(groups) == 5 * 6 // 2 + 5
    main = spark.range(5000).selectExpr("1L AS cell", "id AS doc", "IF(id < 3, id, 9L) AS component", "9L AS main", "5000L AS members", "4997L AS inside")
    groups = J._dealt(main).groupBy("at").count().collect()
    assert sum(r["count"] for r in groups) == 4997 + 3 * 6 and max(r["count"] for r in groups) < 1.5 * J.BLOCK
