"""The ordinal model: its gradient, ordered thresholds, and accuracy on documents it has not seen."""

import numpy as np
from pyspark.sql import functions as F

from strataflow.llm import toxicity as X
from tests.llm import fixtures

FOLDER = "/root/testdata/sf0.01"


def likelihood(rows, values, grades, w, cuts):
    x = np.array([w[r] @ v for r, v in zip(rows, values)])
    above = 1 / (1 + np.exp(-(x[:, None] - cuts)))
    above = np.hstack((np.ones((len(x), 1)), above, np.zeros((len(x), 1))))
    i = np.arange(len(x))
    return np.log(above[i, grades] - above[i, grades + 1]).mean()


def test_fit_is_a_maximum():
    random = np.random.default_rng(3)
    rows = [np.flatnonzero(random.random(6) < 0.4) for _ in range(400)]
    values = [np.ones(len(r)) for r in rows]
    true = np.array([2.0, 1.0, 0.5, -0.5, 0, 0])
    grades = np.digitize([true[r].sum() + random.logistic() for r in rows], [0.5, 1.5, 2.5])
    w, cuts = X._fit_ordinal(rows, values, grades, 6, steps=3000)
    assert (np.diff(cuts) > 0).all() and w[0] > w[1] > w[3]
    best = likelihood(rows, values, grades, w, cuts)
    for k in range(6):
        for step in (-0.2, 0.2):
            assert likelihood(rows, values, grades, w + step * np.eye(6)[k], cuts) < best + 1e-3


def test_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    english = docs.where("lang = 'en'")
    seen = F.col("doc_id") % 3 != 0
    model = X.fit_toxicity(english, labels.where(seen))
    scored = english.join(labels.where(~seen), "doc_id").select("doc_id", F.col("toxic").alias("label"), X.severity(model, F.col("text"), spark).alias("s"))
    rows = scored.select("label", "s.*").collect()
    assert sum(r.toxic == bool(r.label) for r in rows) / len(rows) > 0.9
    assert np.mean([r.expected_severity for r in rows if r.label]) > 5 * np.mean([r.expected_severity for r in rows if not r.label])
    assert all(0 <= r.expected_severity <= 3 and 0 <= r.p_toxic <= 1 and r.grade in (0, 1, 2, 3) for r in rows)


def test_awkward_rows(spark):
    rows, labels = fixtures.texts(), spark.createDataFrame([(1, 1, 0), (11, 0, 1), (12, 1, None), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    docs = fixtures.table(spark, rows)
    scored = X.toxicity_scores(docs, labels).collect()
    assert len(scored) == len(rows) and not any(r.p_toxic is None for r in scored)
    kept = X.drop_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert X.toxicity_scores(docs.limit(0), labels).collect() == []
