"""Bit tables of a fixed size that all tasks fill and that are merged by slices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 16
KEY_MIX = np.uint64(0x9E3779B97F4A7C15)


def places(keys: np.ndarray, n_bits: int, probes: int) -> list[np.ndarray]:
    """The bits of each 64-bit key, by double hashing. `n_bits` is a power of two."""
    first = keys.astype(np.uint64) * KEY_MIX
    first ^= first >> np.uint64(29)
    second = (first * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    mask = np.uint64(n_bits - 1)
    return [(((first + np.uint64(i) * second) >> np.uint64(7)) & mask).astype(np.int64) for i in range(probes)]


def bits_for(rows: int, per_row: int, most: int) -> int:
    """A power of two of at least `per_row` bits a row, between 2**19 and `most`. Beyond `most` the table fills up and
    lets more keys through: results stay right, less is saved."""
    n = 1 << 19
    while n < rows * per_row and n < most:
        n *= 2
    return n


def fill(keys: DataFrame, n_bits: int, probes: int, planes: int) -> list[np.ndarray]:
    """Bit tables over the only column of `keys` (64-bit integers): the first marks keys seen at least once, the second
    (if planes is 2) keys seen at least twice, in any tasks. Each task fills its own tables; slices of 8 KB are
    merged on the executors, and the driver receives `planes * n_bits / 8` bytes whatever the input."""
    name = keys.columns[0]

    def local(batches):
        once = np.zeros(n_bits, dtype=bool)
        twice = np.zeros(n_bits if planes == 2 else 0, dtype=bool)
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if planes == 2:
                # A key is seen before if all its bits are set; keys repeated in the batch are seen twice at once.
                distinct, counts = np.unique(values, return_counts=True)
                found = places(distinct, n_bits, probes)
                before = counts > 1
                before |= np.logical_and.reduce([once[p] for p in found])
                for p in found:
                    twice[p[before]] = True
                    once[p] = True
            else:
                for p in places(values, n_bits, probes):
                    once[p] = True
        rows: dict[str, list] = {"plane": [], "slice": [], "bits": []}
        for plane, table in enumerate((once, twice)[:planes]):
            packed = np.packbits(table).reshape(-1, min(SLICE, n_bits) // 8)
            for i in np.flatnonzero(packed.any(axis=1)):
                rows["plane"].append(plane)
                rows["slice"].append(int(i))
                rows["bits"].append(packed[i].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["plane"], pa.int32()), pa.array(rows["slice"], pa.int32()), pa.array(rows["bits"], pa.binary())],
            names=["plane", "slice", "bits"],
        )

    def merged(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(SLICE // 8, dtype=np.uint8), np.zeros(SLICE // 8, dtype=np.uint8)
        for plane, raw in zip(table["plane"].to_pylist(), table["bits"].to_pylist()):
            bits = np.frombuffer(raw, dtype=np.uint8)
            if plane == 0:
                twice |= once & bits
                once |= bits
            else:
                twice |= bits
        at = table["slice"][0].as_py()
        return pa.table({
            "plane": pa.array([0, 1][:planes], pa.int32()),
            "slice": pa.array([at] * planes, pa.int32()),
            "bits": pa.array([once.tobytes(), twice.tobytes()][:planes], pa.binary()),
        })

    schema = "plane int, slice int, bits binary"
    parts = keys.select(name).mapInArrow(local, schema)
    # Two levels, so that no group holds a slice of every task.
    done = parts.groupBy("slice", F.spark_partition_id() % 64).applyInArrow(merged, schema)
    done = done.groupBy("slice").applyInArrow(merged, schema)
    tables = [np.zeros((n_bits // SLICE, SLICE // 8), dtype=np.uint8) for _ in range(planes)]
    for row in done.collect():
        tables[row["plane"]][row["slice"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return [t.reshape(-1) for t in tables]


def holds(table: np.ndarray, keys: np.ndarray, probes: int) -> np.ndarray:
    """Whether each key may be in a table; never False for a key that was put in."""
    found = np.ones(len(keys), dtype=bool)
    for p in places(keys, len(table) * 8, probes):
        found &= (table[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1).astype(bool)
    return found
