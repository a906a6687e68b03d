"""Exact deduplication in two passes around a Bloom filter.

Pass one hashes every normalised text and fills two bit tables: keys seen at least once, keys seen at least twice. Pass
two looks each hash up in the second table. Only rows that it may hold are shuffled to find their groups; all others
are unique for certain and pass straight through.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm import bits
from strataflow.llm.shared import scratch, stash

#: Bits per row of the filter, probes per hash, and the most bits of a table (8 MB).
BITS_PER_ROW, PROBES, MOST_BITS = 16, 4, 1 << 26
#: Shares into which the copies of a text are dealt where they meet their group.
SALTS = 8


def normalised(text: Column) -> Column:
    """Null counts as empty; every run of white space `[\\x20\\x09-\\x0D]+` becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def _repeated(hashes: DataFrame, most_bits: int = MOST_BITS):
    """A column function that tells whether a hash may occur in several rows of `hashes` (its only column)."""
    spark, name = hashes.sparkSession, hashes.columns[0]
    n_bits = bits.bits_for(hashes.count(), BITS_PER_ROW, most_bits)
    table = spark.sparkContext.broadcast(bits.fill(hashes.select(F.xxhash64(name)), n_bits, PROBES, 2)[1])

    @F.pandas_udf("boolean")
    def held(keys: pd.Series) -> pd.Series:
        return pd.Series(bits.holds(table.value, keys.to_numpy(dtype=np.int64).view(np.uint64), PROBES))

    return lambda column: held(F.xxhash64(column))


def _marked(base: DataFrame, most_bits: int) -> DataFrame:
    """The rows of `base` with `maybe`, whether their `sha` may occur again. Where one table of `most_bits` would get too full,
    the hashes are stored by ranges of their own hash and each range has a table and a pass of its own, so the share of unique
    rows that is let through does not grow with the input."""
    ranges = -(-base.count() * BITS_PER_ROW // most_bits)
    if ranges <= 1:
        return base.withColumn("maybe", _repeated(base.select("sha"), most_bits)("sha"))
    spark, split, marked = base.sparkSession, scratch(base.sparkSession, "ranges"), scratch(base.sparkSession, "marked")
    base.withColumn("part", F.pmod(F.xxhash64("sha"), F.lit(ranges))).write.partitionBy("part").parquet(split)
    # A range has no folder where one text holds most rows.
    held = spark.read.parquet(split).select("part").distinct().collect()
    for part in sorted(r.part for r in held):
        rows = spark.read.schema(base.schema).parquet(f"{split}/part={part}")
        rows.withColumn("maybe", _repeated(rows.select("sha"), most_bits)("sha")).write.mode("append").parquet(marked)
    return spark.read.schema(base.withColumn("maybe", F.lit(True)).schema).parquet(marked)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256. Of equal texts the row with the smallest key
    stays. Null and empty texts are equal to each other. Rows without a key come last: one stays only where its group
    has no key at all, with keep_id null. Of rows that repeat both key and text one stays. An empty table gives an
    empty result; other columns are not looked at. A bit table has at most `most_bits`; more rows take more tables."""
    base = stash(docs.select(F.col(key).alias("doc"), text_hash(F.col(text)).alias("sha")), "hashes")
    marked = _marked(base, most_bits)
    alone = marked.where("not maybe").select("doc", F.col("doc").alias("keep"), F.lit(1).cast("long").alias("n"), F.lit(1).alias("copy"), "sha")
    # Equal (key, text) rows are counted first, so the group of a text gets one row per key from each task.
    some = marked.where("maybe").groupBy("sha", "doc").agg(F.count("*").alias("copies"))
    some = stash(some, "repeated")
    groups = some.groupBy("sha").agg(F.min("doc").alias("keep"), F.sum("copies").alias("n"))
    # Dealt by text and salt, so copies of one text spread over the tasks; a group is one row per salt.
    salted = some.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    shared = salted.join(spread, ["sha", "salt"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    every = alone.unionByName(shared.select("doc", "keep", "n", "copy", "sha"))
    return every.select(
        F.col("doc").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("doc").eqNullSafe(F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """The rows that stay, with all their columns. The rules are those of `exact_groups`, which sees keys and texts alone.
    The whole rows pass a bit table of the hashes that do repeat, which are few among all; those that it holds are shuffled,
    dealt by hash and key, so copies of one text spread over all tasks."""
    columns = docs.columns
    sha, maybe, copy, other = (f"{name}_{uuid.uuid4().hex}" for name in ("sha", "maybe", "copy", "other"))
    groups = exact_groups(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), most_bits=most_bits)
    many = stash(groups.where("group_size > 1").select(F.unhex("text_sha256").alias(copy), F.col("doc_id").alias(other), "keep_id"), "many")
    gone = many.where(~F.col(other).eqNullSafe(F.col("keep_id"))).select(copy, other).distinct()
    marked = docs.withColumn(sha, text_hash(F.col(text))).withColumn(maybe, _repeated(many.select(copy), most_bits)(sha))
    alone = marked.where(~F.col(maybe)).select(*columns)
    some = marked.where(F.col(maybe)).join(gone, (F.col(sha) == F.col(copy)) & F.col(key).eqNullSafe(F.col(other)), "left_anti")
    return alone.unionByName(some.dropDuplicates([sha, key]).select(*columns))
