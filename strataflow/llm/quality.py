"""Quality by compression: zstandard with a dictionary of good and one of bad labelled text.

A text is cut into blocks that are compressed on their own, so that a dictionary tells as much at the end of a long text
as at its start. With B and G the total sizes under the bad and the good dictionary, the normalised difference
(B - G) / (B + G) says which kind the text is like. A logistic calibration on other labelled rows turns it into a
probability; it also sees G and B per byte, since junk that repeats itself compresses well under either dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, LEVEL, DICTIONARY_BYTES = 1024, 3, 112_640
#: About this many labelled rows are learned from (half for the dictionaries, half for the calibration), and about this
#: many bytes of blocks of each kind go into a dictionary. Rows and blocks are chosen by hashes.
TRAIN_ROWS, TRAIN_BYTES = 20_000, 10 << 20
CUT = 0.3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # constant first

    def compressors(self):
        if not hasattr(self, "_made"):
            self._made = [_compressor(self.good), _compressor(self.bad)]
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}


def _compressor(content: bytes):
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(**options)
    made = zstandard.ZstdCompressionDict(content)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=made, **options)


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; the plain text of the blocks where they are too few to train on."""
    blocks = sorted(set(blocks), key=hash_of)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY_BYTES]


def _features(texts: pa.Array, model: QualityModel) -> np.ndarray:
    good, bad = (c.compress for c in model.compressors())
    out = np.zeros((len(texts), 3))
    for row, text in enumerate(texts.to_pylist()):
        data = (text or "").encode()
        if data:
            blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
            g, b = sum(len(good(x)) for x in blocks), sum(len(bad(x)) for x in blocks)
            out[row] = (b - g) / (b + g), g / len(data), b / len(data)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps with a small ridge: mean, scale, weights."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack((np.ones((len(x), 1)), (x - mean) / scale))
    w, ridge = np.zeros(z.shape[1]), 1e-3 * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
    return mean, scale, w


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the key as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> QualityModel:
    """Learn from labelled rows that are not held out. Labels that are null, or neither 0 nor 1, are left out. Without rows
    of both kinds the score is the share of good rows, or 0.5 without any."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.select(F.col(key).alias("doc"), F.col("quality").cast("int").alias("good")).dropDuplicates(["doc"])
    share = min(1.0, TRAIN_ROWS / max(known.count(), 1))
    dealt = F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(2_000_000))
    known = known.withColumn("dealt", dealt).where(F.col("dealt") < int(share * 2_000_000))
    # At most about TRAIN_ROWS rows of a few bytes are left, so they are safe to broadcast.
    train = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), "doc")
    sizes = {r["good"]: r["n"] for r in train.groupBy("good").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    flat = QualityModel(b"", b"", np.zeros(3), np.ones(3), np.zeros(4))
    if len(sizes) < 2:
        flat.weights[0] = 0.0 if not sizes else 5.0 if 1 in sizes else -5.0
        return flat
    limits = {kind: min(1.0, TRAIN_BYTES / max(n // 2, 1)) for kind, n in sizes.items()}

    def blocks(batches):
        for batch in batches:
            kinds, found = [], []
            for body, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = body.encode()
                for i in range(0, len(data), BLOCK):
                    block = data[i : i + BLOCK]
                    if len(block) >= 32 and (hash_of(block) % 1_000_000) < limits[kind] * 1_000_000:
                        kinds.append(kind)
                        found.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(found, pa.binary())], names=["good", "block"])

    first = F.col("dealt") % 2 == 0
    got = train.where(first).select("text", "good").mapInArrow(blocks, "good int, block binary").collect()
    flat.good = _dictionary([bytes(r["block"]) for r in got if r["good"] == 1])
    flat.bad = _dictionary([bytes(r["block"]) for r in got if r["good"] == 0])
    shared = docs.sparkSession.sparkContext.broadcast(flat)

    def measured(batches):
        for batch in batches:
            x = _features(batch.column(0), shared.value)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(3)), batch.column(1)], names=["d", "g", "b", "good"])

    rows = train.where(~first).select("text", "good").mapInArrow(measured, "d double, g double, b double, good int").collect()
    if len({r["good"] for r in rows}) < 2:
        flat.weights = np.array([0.0, 1.0, 0.0, 0.0])
        return flat
    x = np.array([[r["d"], r["g"], r["b"]] for r in rows])
    flat.mean, flat.scale, flat.weights = _logistic(x, np.array([r["good"] for r in rows], dtype=float))
    return flat


def hash_of(block: bytes) -> int:
    """A hash that is equal on all machines."""
    return xxhash.xxh64_intdigest(block)


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score (0 to 1, higher: good likelier), predicted (1 if score >= 0.3) of every row; also difference,
    the normalised compressed-size difference. Only the text is scored. Null and empty texts have sizes of 0 and get the
    score of that. Repeated rows are scored each; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, key, text))

    @F.arrow_udf("struct<score: double, difference: double>")
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        x = _features(texts, model)
        z = np.hstack((np.ones((len(x), 1)), (x - model.mean) / model.scale))
        p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -30, 30)))
        return pa.StructArray.from_arrays([pa.array(p), pa.array(x[:, 0])], names=["score", "difference"])

    scored = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), score(F.col(text)).alias("s"))
    return scored.select(key, "held_out", "s.score", (F.col("s.score") >= CUT).cast("int").alias("predicted"), "s.difference")
