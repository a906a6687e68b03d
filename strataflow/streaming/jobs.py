"""Structured Streaming variants of landing, late parents and deduplication.

Checkpoints and outputs live below the shared folder the session names, so a lost executor or driver resumes
from the last committed micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None] | None = None,
    output: str | None = None,
) -> None:
    """Process everything there is, in as many micro-batches as needed, then stop.

    Either every micro-batch goes to `handle`, or the rows are appended to the Parquet folder `output`.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if handle is not None:
        query = writer.foreachBatch(handle).start()
    else:
        query = writer.format("parquet").outputMode("append").start(output)
    query.awaitTermination()


def first_per_key(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """The first row per key; state older than the watermark is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def link_late_parents(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, child_time: str,
    parent_time: str, parent_columns: dict[str, str], bound: str = "INTERVAL 1 DAY",
) -> DataFrame:
    """Children with the keys of their parent; -1 once no parent arrived within the bound.

    Both sides carry a watermark, so state is bounded and an unmatched child leaves as soon as its parent
    can no longer come. Time is cut into buckets as long as the bound; a parent stands in its own bucket and in both beside
    it, a child in its own alone, so a child meets each parent once and the state of one key is
    spread over its buckets.
    """
    length = F.expr(f"unix_seconds(TIMESTAMP '1970-01-01 00:00:00 UTC' + {bound})")

    def bucket(time: str) -> Column:
        return F.floor(F.unix_seconds(time) / length).cast("long")

    left = children.withWatermark(child_time, bound.replace("INTERVAL ", "")).withColumn("time_bucket", bucket(child_time)).alias("c")
    near = F.explode(F.sequence(bucket(parent_time) - 1, bucket(parent_time) + 1))
    right = parents.withWatermark(parent_time, bound.replace("INTERVAL ", "")).withColumn("time_bucket", near).alias("p")
    reach: Column = (
        (F.col(f"c.{child_key}") == F.col(f"p.{parent_key}"))
        & (F.col("c.time_bucket") == F.col("p.time_bucket"))
        & (F.col(f"p.{parent_time}") >= F.col(f"c.{child_time}") - F.expr(bound))
        & (F.col(f"p.{parent_time}") <= F.col(f"c.{child_time}") + F.expr(bound))
    )
    joined = left.join(right, reach, "leftOuter")
    return joined.select(
        *[F.col(f"c.{c}").alias(c) for c in children.columns],
        *[F.coalesce(F.col(f"p.{c}"), F.lit(-1)).alias(n) for c, n in parent_columns.items()],
    )
