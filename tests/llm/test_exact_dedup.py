"""Exact deduplication against a dictionary of normalised texts."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strataflow.llm import bits, exact_dedup as module
from strataflow.llm.exact_dedup import exact_dedup, exact_groups
from tests.llm import fixtures


def plain(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append(i)
    out = []
    for sha, ids in groups.items():
        keyed = [i for i in ids if i is not None]
        keep, kept = min(keyed) if keyed else None, 0
        for i in ids:
            stays = i == keep and not kept
            kept += stays
            out.append((i, keep, len(ids), stays, sha))
    return Counter(out)


def test_groups(spark):
    rows = fixtures.texts()
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(fixtures.table(spark, rows)).collect())
    assert got == expected(rows)


def test_rows_that_stay(spark):
    rows, docs = fixtures.texts(), fixtures.table(spark)
    left = exact_dedup(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, plain(r.text)) for r in left.collect()) == Counter((i, sha) for i, _, _, kept, sha in expected(rows).elements() if kept)


def test_empty_table(spark):
    none = fixtures.table(spark, []).limit(0)
    assert exact_groups(none).collect() == [] and exact_dedup(none).collect() == []


def test_only_repeated_keys_shuffle(spark):
    """Every repeated key is held; hardly any other."""
    keys = spark.range(40_000).selectExpr("xxhash64(id) AS k").unionByName(spark.range(500).selectExpr("xxhash64(id) AS k")).repartition(6)
    table = bits.fill(keys, bits.bits_for(40_500, 16, 1 << 26), 4, 2)[1]
    values = np.array([r.k for r in spark.range(40_000).selectExpr("xxhash64(id) AS k").collect()], dtype=np.int64).view(np.uint64)
    held = bits.holds(table, values, 4)
    assert held[:500].all() and held[500:].mean() < 0.02


def test_small_tables_let_no_more_unique_rows_through(spark):
    """With tables for 32,768 rows each the share of unique rows that shuffle stays small when rows grow tenfold, and no
    repeated row is missed."""
    for n in (30_000, 300_000):
        rows = spark.range(n).unionByName(spark.range(200)).select(F.col("id").alias("doc"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("sha"))
        marked = module._marked(rows.repartition(6), 1 << 19)
        repeated, let = marked.agg(F.expr("count_if(doc < 200 AND maybe)"), F.expr("count_if(doc >= 200 AND maybe)")).first()
        assert marked.count() == n + 200 and repeated == 400 and let < 0.02 * n


def test_groups_over_several_tables(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 39_000).alias("text"))
    one, many = exact_groups(rows), exact_groups(rows, most_bits=1 << 19)
    assert one.exceptAll(many).isEmpty() and many.count() == 40_000 and many.where("not kept").count() == 1000
    same = exact_groups(spark.range(70_000).select(F.col("id").alias("doc_id"), F.lit("the same").alias("text")), most_bits=1 << 19)
    assert [tuple(r) for r in same.groupBy("keep_id", "group_size", "kept").count().orderBy("kept").collect()] == [(0, 70_000, False, 69_999), (0, 70_000, True, 1)]
