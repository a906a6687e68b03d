"""Quality by compression: accuracy on held-out rows, the folds, and awkward rows."""

import zlib

from strataflow.llm.quality import quality_scores
from tests.llm import fixtures

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = [r for r in held if r.quality], [r for r in held if not r.quality]
    assert len(held) > 700 and sum(r.predicted for r in good) / len(good) > 0.98 and sum(1 - r.predicted for r in bad) / len(bad) > 0.85


def test_held_out_labels_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality")
    a, b = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_awkward_rows(spark):
    rows = fixtures.texts()
    docs = fixtures.table(spark, rows)
    for given in ([], [(12, 1)], [(12, 1), (13, 0), (14, 1), (16, 0), (17, 1), (18, 0), (None, 1), (19, None)]):
        scored = quality_scores(docs, spark.createDataFrame(given, "doc_id long, quality int")).collect()
        assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    assert quality_scores(docs.limit(0), spark.createDataFrame([(12, 1)], "doc_id long, quality int")).collect() == []
