"""Dense surrogate keys without a global window.

Ids are hashed into buckets, many more than there are tasks at any size. Bucket sizes are summed up in two levels: a
running sum over the buckets of a group, and one over the groups; together they give each bucket its first
number. Inside a bucket the ids are numbered in order. The numbers depend on the
data alone, so a lost task that runs again hands out the same keys, and buckets keep even sizes because the
ids are distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 1 << 20
GROUP_BUCKETS = 1 << 10


def assign_keys(
    rows: DataFrame, business_id: str, key: str, first: Column | int = 1, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Fill `key` with first, first + 1, ... for rows that hold one distinct business id each."""
    bucket = F.pmod(F.xxhash64(business_id), F.lit(buckets)).cast("int")
    placed = rows.withColumn("key_bucket", bucket)
    sizes = placed.groupBy("key_bucket").agg(F.count(F.lit(1)).alias("bucket_rows"))
    group = F.floor(F.col("key_bucket") / GROUP_BUCKETS)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_group = before.partitionBy("key_group").orderBy("key_bucket")
    sizes = sizes.withColumn("key_group", group)
    # The only window over everything sees one row per group of buckets, at most `buckets / GROUP_BUCKETS`.
    groups = sizes.groupBy("key_group").agg(F.sum("bucket_rows").alias("n")).select(
        "key_group", F.coalesce(F.sum("n").over(before.orderBy("key_group")), F.lit(0)).alias("group_start")
    )
    offsets = sizes.withColumn("inside", F.coalesce(F.sum("bucket_rows").over(in_group), F.lit(0))).join(groups, "key_group").select(
        "key_bucket", (F.col("group_start") + F.col("inside")).alias("bucket_start")
    )
    index = F.row_number().over(Window.partitionBy("key_bucket").orderBy(business_id))
    start = first if isinstance(first, Column) else F.lit(first)
    numbered = placed.withColumn("bucket_index", index).join(offsets, "key_bucket")
    value = (start.cast("long") + F.col("bucket_start") + F.col("bucket_index") - 1).alias(key)
    return numbered.select(*[value if c == key else F.col(c) for c in rows.columns])


def next_key(table: DataFrame, key: str) -> Column:
    """Scalar subquery: one above the highest key; the unknown member -1 does not count."""
    return table.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)) + 1).scalar()


def fill_missing_keys(rows: DataFrame, business_id: str, key: str, first: Column | int) -> DataFrame:
    """Keep the keys that are there and number the rest."""
    fresh = assign_keys(rows.filter(F.col(key).isNull()), business_id, key, first)
    return rows.filter(F.col(key).isNotNull()).unionByName(fresh)
