"""The pipeline stage by stage against plain Python, and the registered queries."""

import re
import shutil
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from strataflow.llm.shared import TEST_KEY
from strataflow.llm import pii
from tests.llm import fixtures

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    shutil.copytree(f"{FOLDER}", tmp_path / "sf", dirs_exist_ok=True)
    docs = fixtures.table(spark)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, str(tmp_path / "sf")).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            left = Counter((r.doc_id, r.text) for r in after.collect())
        if name == "exact_dedup":
            firsts = {}
            for i, t in sorted(before, key=lambda x: (x[0] is None, x[0] or 0)):
                firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
            assert Counter(i for i, _ in left) == Counter(firsts.values())
        if name == "ngram_jaccard_join":
            group = fixtures.components(before)
            assert Counter(i for i, _ in left) == Counter(i for i, _ in before if group.get(i) == i)
        if name == "pii":
            assert left == Counter((i, None if t is None else pii.replaced(t, TEST_KEY)[0]) for i, t in before)
        if name == "best_fit_packing":
            assert {r.doc_id for r in after.collect()} == {i for i, _ in before}
        docs = after


def test_empty_documents(spark, tmp_path):
    docs = fixtures.table(spark, []).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


@pytest.mark.parametrize("name", [f"op{n}_" for n in range(1, 11)] + ["pipeline"])
def test_registered(name):
    assert sum(q.startswith(name) for q in entry.queries()) == 1


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    ids = {r.doc_id for r in rows}
    assert 100 < len(ids) < 200 and all(r.n_words <= 2048 for r in rows)


def test_exact_dedup_oracle(spark):
    from tests.check_queries import compare, connect

    ok, note, _ = compare(spark, connect(FOLDER), FOLDER, "op7_exact_dedup", entry.oracle_sql()["op7_exact_dedup"])
    assert ok, note
