"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are words that tell toxic from other labelled texts. Severity grades 0 to 3 come from the labels: 0 where
`toxic` is 0, else by how many such words a text holds, repeats by their logarithm. The model shares one weight vector across three ordered
thresholds, P(grade > j) = sigmoid(w x - t_j), and gives the expected grade.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import NO_LETTER, U64, buffers, release, slices, words

#: At most about this many labelled rows are learned from, chosen by a hash of the key.
TRAIN_ROWS = 20_000
#: At most this many features, each with at least this chi-square value (one degree of freedom).
FEATURES, CHI_SQUARE = 4_000, 25.0
GRADES = 3
#: A document is toxic if P(grade > 0) reaches the model's limit: the best F1 on the rows learned from, within these.
LIMITS = (0.1, 0.5)
RIDGE = 0.004


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray  # sorted word hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above 0
    limit: float = LIMITS[1]


def _distinct_words(texts: pa.Array):
    """(text, sorted distinct word hashes, their weights 1 + log2(occurrences)) of every text."""
    data, offsets = buffers(texts)
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        hashes, at = words(data[part[0] : part[-1]], part - part[0], NO_LETTER)
        for i in range(last - first):
            found, n = np.unique(hashes[at[i] : at[i + 1]], return_counts=True)
            yield first + i, found, 1 + np.log2(n)


def _present(features: np.ndarray, found: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the features among some distinct words, and their values."""
    if not len(features):
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    at = np.searchsorted(features, found)
    at[at == len(features)] = 0
    here = features[at] == found
    return at[here], value[here]


def _word_rows(batches):
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for row, found, _ in _distinct_words(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), toxic[row], dtype=np.int32))], names=["word", "toxic"])


def _fit_ordinal(rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, n: int, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds that minimise the mean negative log-likelihood with a ridge on the weights
    (Adam on all rows; thresholds are a first value and positive gaps, so their order holds)."""
    at = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)]) if rows else np.zeros(0, int)
    to = np.concatenate(rows) if rows else np.zeros(0, int)
    value = np.concatenate(values) if values else np.zeros(0)
    w = np.zeros(n)
    free = np.array([2.0] + [0.0] * (GRADES - 1))  # the first threshold, then logs of gaps
    state = [np.zeros(n + GRADES), np.zeros(n + GRADES)]
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))
        x = np.bincount(at, weights=w[to] * value, minlength=len(rows))
        above = 1 / (1 + np.exp(-np.clip(x[:, None] - cuts, -30, 30)))
        above = np.hstack((np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))))
        i = np.arange(len(rows))
        high, low = above[i, grades], above[i, grades + 1]
        p = np.maximum(high - low, 1e-9)
        # d log p / dx = 1 - high - low for the logistic link.
        gx = -(1 - high - low) / len(rows)
        gc = np.zeros(GRADES)
        for j in range(GRADES):
            s = above[:, j + 1] * (1 - above[:, j + 1])
            gc[j] = -((s * (grades == j) - s * (grades == j + 1)) / p).sum() / len(rows)
        tail = np.cumsum(gc[::-1])[::-1]
        gradient = np.concatenate((np.bincount(to, weights=gx[at] * value, minlength=n) + RIDGE * w / max(len(rows), 1) ** 0.5, tail[:1], tail[1:] * np.exp(free[1:])))
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w, free = w - move[:n], free - move[n:]
    return w, np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learn from labelled documents. Labels that are null, or neither 0 nor 1, are left out; so are keys without a
    document. Without labelled rows of both kinds nothing is toxic."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, train_rows / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < int(share * 1_000_000)).dropDuplicates(["doc"])
    # Labels are a few bytes a row and at most train_rows of them are left, so they are safe to broadcast.
    train = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).join(F.broadcast(known), "doc").select("text", "toxic")
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    none = ToxicityModel(np.zeros(0, dtype=U64), np.zeros(0), np.arange(1.0, GRADES + 1) * 5)
    if not toxic or not other:
        return none
    counts = train.mapInArrow(_word_rows, "word long, toxic int").groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b, total = F.col("a"), F.col("b"), toxic + other
    cross = a * (other - b) - b * (toxic - a)
    chi = total * cross * cross / ((a + b) * (total - a - b) * float(toxic) * other)
    chosen = counts.where((a + b < total) & (a + b >= 3)).select("word", "a", "b", chi.alias("chi")).where(F.col("chi") >= CHI_SQUARE)
    best = chosen.orderBy(F.desc("chi"), "word").limit(FEATURES).collect()
    if not best:
        return none
    features = np.sort(np.array([r["word"] for r in best], dtype=np.int64).view(U64))
    telling = np.sort(np.array([r["word"] for r in best if r["a"] * other > r["b"] * toxic], dtype=np.int64).view(U64))

    def matrix(batches):
        for batch in batches:
            label = batch.column(1).to_pylist()
            hits, values, marks = [], [], []
            for _, found, value in _distinct_words(batch.column(0)):
                at, worth = _present(features, found, value)
                hits.append(at.tolist())
                values.append(worth.tolist())
                marks.append(float(_present(telling, found, value)[1].sum()))
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64())), pa.array(marks, pa.float64()), pa.array(label, pa.int32())], names=["hits", "worth", "marks", "toxic"])

    # At most about train_rows rows with the positions of their features.
    got = train.mapInArrow(matrix, "hits array<int>, worth array<double>, marks double, toxic int").collect()
    marks = np.array([r["marks"] for r in got])
    grade = np.where(np.array([r["toxic"] for r in got]) == 0, 0, 1 + (marks >= 2) + (marks >= 4))
    hits = [np.array(r["hits"], dtype=np.int64) for r in got]
    worth = [np.array(r["worth"]) for r in got]
    w, cuts = _fit_ordinal(hits, worth, grade, len(features))
    p = 1 / (1 + np.exp(cuts[0] - np.array([w[h] @ v for h, v in zip(hits, worth)])))
    return ToxicityModel(features, w, cuts, _limit(p, grade > 0))


def _limit(p: np.ndarray, toxic: np.ndarray) -> float:
    """The probability from which calling a row toxic gives the best F1, half way to the next lower value."""
    order = np.argsort(-p, kind="stable")
    p, right = p[order], np.cumsum(toxic[order])
    f1 = 2 * right / (np.arange(1, len(p) + 1) + toxic.sum())
    f1[:-1][p[1:] == p[:-1]] = -1  # equal values go together
    best = int(f1.argmax())
    below = p[best + 1] if best + 1 < len(p) else 0.0
    return float(np.clip((p[best] + below) / 2, *LIMITS))


def severity(model: ToxicityModel, text: Column, spark) -> Column:
    """A struct per text: expected_severity (0 to 3), p_toxic = P(grade > 0), grade (the most probable one), toxic
    (p_toxic at least the model's limit). Null and empty texts are scored as texts without features."""
    shared = spark.sparkContext.broadcast(model)
    kind = "struct<expected_severity: double, p_toxic: double, grade: int, toxic: boolean>"

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        x = np.zeros(len(texts))
        for row, found, value in _distinct_words(texts):
            at, worth = _present(m.features, found, value)
            x[row] = m.weights[at] @ worth
        release()
        above = 1 / (1 + np.exp(-np.clip(x[:, None] - m.thresholds, -30, 30)))
        steps = np.hstack((np.ones((len(x), 1)), above)) - np.hstack((above, np.zeros((len(x), 1))))
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(steps.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= m.limit)],
            names=["expected_severity", "p_toxic", "grade", "toxic"],
        )

    return score(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, expected_severity, p_toxic, grade and toxic of every row. Repeated rows are scored each; an empty table gives
    an empty result; other columns are not looked at."""
    model = fit_toxicity(docs, labels, key, text)
    return docs.select(F.col(key), severity(model, F.col(text), docs.sparkSession).alias("s")).select(key, "s.*")


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    model = fit_toxicity(docs, labels, key, text)
    return docs.where(~severity(model, F.col(text), docs.sparkSession)["toxic"])
