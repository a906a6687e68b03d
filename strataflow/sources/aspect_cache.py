"""The review-aspect cache file: a JSON list of six-element arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.surrogate import assign_keys
from strataflow.sources import pieces

COLUMNS = ("review_hash", "review_text", "aspect_id", "sentiment_type_id", "matched_phrase", "ai_model")
NUMBERS = ("aspect_id", "sentiment_type_id")
KEY = ["review_hash", "aspect_id", "sentiment_type_id"]
DEFAULT_MODEL = "offline-fallback"
REQUEST_SIZE = 15


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of the list files of a path; array positions become columns. A file is read by as many tasks as
    it has splits, also where the whole list stands on one line."""
    entries = pieces.json_entries(spark, path).select(F.from_json("value", "array<string>").alias("e"))
    return entries.select(
        *[
            F.col("e")[i].cast("int").alias(c) if c in NUMBERS else F.col("e")[i].alias(c)
            for i, c in enumerate(COLUMNS)
        ]
    )


def read_cache_rows(spark: SparkSession, path: str) -> DataFrame:
    """The export of `write_cache`: one array per line, read in parallel."""
    lines = spark.read.text(path)
    e = F.from_json("value", "array<string>")
    return lines.select(
        *[e[i].cast("int").alias(c) if c in NUMBERS else e[i].alias(c) for i, c in enumerate(COLUMNS)]
    )


def add_missing(cache: DataFrame, entries: DataFrame) -> DataFrame:
    """Insert entries whose (hash, aspect, sentiment) the cache does not hold."""
    fresh = entries.dropDuplicates(KEY).join(cache.select(*KEY), KEY, "left_anti")
    return cache.unionByName(fresh.select(*cache.columns))


ORDER = ("review_text", "aspect_id", "sentiment_type_id")


def filled_entries(cache: DataFrame) -> DataFrame:
    """Entries with the defaults of an export."""
    return cache.select(
        F.trim("review_hash").alias("review_hash"), "review_text", "aspect_id", "sentiment_type_id",
        F.coalesce("matched_phrase", F.lit("")).alias("matched_phrase"),
        F.coalesce("ai_model", F.lit(DEFAULT_MODEL)).alias("ai_model"),
    )


def ordered_entries(cache: DataFrame) -> DataFrame:
    """Export order and defaults."""
    return filled_entries(cache).orderBy(*ORDER)


def _line() -> Column:
    """An entry as a six-element JSON array."""
    def field(c: str):
        if c in NUMBERS:
            return F.col(c).cast("string")
        # to_json quotes and escapes one text inside a one-element array; the brackets come off again.
        return F.regexp_replace(F.to_json(F.array(F.coalesce(F.col(c), F.lit("")))), r"^\[|\]$", "")

    return F.concat(F.lit("["), F.concat_ws(",", *[field(c) for c in COLUMNS]), F.lit("]"))


def write_cache(cache: DataFrame, path: str) -> None:
    """Sorted export, one six-element JSON array per line, range-partitioned over the executors."""
    ordered_entries(cache).select(_line().alias("value")).write.mode("overwrite").text(path)


def _first_of_partition() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def write_cache_lists(cache: DataFrame, path: str, files: int) -> None:
    """Sorted export as JSON lists, one per range of review texts; each range has a folder and a file of its own. Texts are
    shuffled once: any row of a partition brings the line that closes its list, and the first line opens it."""
    ranged = filled_entries(cache).repartitionByRange(files, "review_text").withColumns(
        {"part": F.spark_partition_id(), "closing": F.when(_first_of_partition(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))}
    )
    lines = ranged.withColumn("closing", F.explode("closing"))
    # A line that closes needs no texts to sort.
    lines = lines.withColumns({c: F.when(F.col("closing") == 0, F.col(c)) for c in ("review_text", "matched_phrase")})
    lines = lines.sortWithinPartitions("part", "closing", *ORDER).withColumn("first", _first_of_partition())
    line = F.when(F.col("closing") == 1, "]").otherwise(F.concat(F.when(F.col("first"), "[").otherwise(","), _line()))
    lines.select("part", line.alias("value")).write.mode("overwrite").partitionBy("part").text(path)


def request_batches(reviews: DataFrame, size: int = REQUEST_SIZE) -> DataFrame:
    """Split distinct review texts into requests of at most `size` texts."""
    numbered = assign_keys(
        reviews.select("review_hash", "review_text").withColumn("n", F.lit(None).cast("long")),
        "review_hash", "n", 0,
    )
    return numbered.select(
        F.floor(F.col("n") / size).cast("long").alias("request_batch"), "review_hash",
        F.col("review_text").alias("request_text"),
    )
