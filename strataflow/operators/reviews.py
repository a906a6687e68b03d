"""Review aspects: hash joins against the aspect cache, fallback classification, response matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.parsing import text_hash
from strataflow.operators.surrogate import fill_missing_keys, next_key
from strataflow.operators.upsert import upsert

PHRASE_LIMIT = 200
FALLBACK_ASPECT = 0
FALLBACK_SENTIMENT = 2
FALLBACK_MODEL = "offline-fallback"


def build_fact_review_aspect(ratings: DataFrame, cache: DataFrame) -> DataFrame:
    """Every aspect the cache holds for a rating's text: an equi-join on the text hash.

    Only the hash travels through the join, not the text. A text shared by a third of all ratings lands in
    one partition; AQE splits it, since the cache side holds a few aspects per hash.
    """
    hashed = ratings.filter(F.col("review_text").isNotNull()).select(
        "rating_key", "batch_id", text_hash(F.col("review_text")).alias("review_hash")
    )
    found = cache.select("review_hash", "aspect_id", "sentiment_type_id", "matched_phrase")
    return hashed.join(found, "review_hash").select(
        "rating_key", "aspect_id", "sentiment_type_id", "matched_phrase", "batch_id"
    )


ASPECT_KEY = ["rating_key", "aspect_id", "sentiment_type_id"]


def upsert_review_aspect(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, ASPECT_KEY, ["matched_phrase"], kept=["review_aspect_key"])


def merge_review_aspect(target: DataFrame | None, source: DataFrame, first: Column | int | None = None) -> DataFrame:
    """The upsert with surrogate keys; rows are numbered by their three-part key, from `first` or behind `target`."""
    part_key = F.concat_ws("|", *ASPECT_KEY)
    fresh = source.withColumn("review_aspect_key", F.lit(None).cast("long"))
    if target is None:
        merged, start = fresh, 1
    else:
        merged = upsert_review_aspect(target, fresh.select(*target.columns)).drop("merge_action")
        start = next_key(target, "review_aspect_key")
    first = start if first is None else first
    numbered = fill_missing_keys(merged.withColumn("part_key", part_key), "part_key", "review_aspect_key", first)
    return numbered.drop("part_key")


def uncached_reviews(ratings: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct non-blank texts whose hash the cache does not know.

    Hashes alone are made distinct and compared with the cache. Only then are the texts of the hashes that are new
    looked up, so no text of a known review is shuffled where those are few enough to be sent to the scan.
    """
    filled = ratings.filter(F.length(F.trim(F.col("review_text"))) > 0)
    new = filled.select(text_hash(F.trim("review_text")).alias("review_hash")).distinct().join(
        cache.select("review_hash"), "review_hash", "left_anti"
    )
    texts = filled.select(text_hash(F.trim("review_text")).alias("review_hash"), F.trim("review_text").alias("review_text"))
    return texts.join(new, "review_hash", "left_semi").distinct()


def fallback_aspects(reviews: DataFrame) -> DataFrame:
    """Offline classification: unknown aspect, neutral, the start of the text as phrase."""
    return reviews.select(
        "review_hash", "review_text",
        F.lit(FALLBACK_ASPECT).alias("aspect_id"),
        F.lit(FALLBACK_SENTIMENT).alias("sentiment_type_id"),
        F.substring("review_text", 1, PHRASE_LIMIT).alias("matched_phrase"),
        F.lit(FALLBACK_MODEL).alias("ai_model"),
    )


def match_responses(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Tie each response text back to the request text it answers.

    `responses` (request_batch, review_text, ...) and `requests` (request_batch, request_text): equal hashes
    match first. The remainder matches when one text contains the other, only within the same request batch;
    a request batch is what was sent in one call, a dozen or so texts. Several containing texts resolve to
    the smallest. Unmatched responses keep their own text.
    """
    asked = requests.select(
        "request_batch", F.col("request_text"), text_hash(F.col("request_text")).alias("request_hash")
    ).distinct()
    answered = responses.withColumn("review_hash", text_hash(F.col("review_text")))
    columns = answered.columns
    exact = answered.join(
        asked.select("request_batch", F.col("request_hash").alias("review_hash"), "request_text")
        .groupBy("request_batch", "review_hash")
        .agg(F.min("request_text").alias("matched_text")),
        ["request_batch", "review_hash"],
        "left",
    )
    done = exact.filter(F.col("matched_text").isNotNull())
    open_rows = exact.filter(F.col("matched_text").isNull()).drop("matched_text")
    reply, request = F.lower("review_text"), F.lower("request_text")
    contained = (
        open_rows.select("request_batch", "review_text").distinct()
        .join(asked, "request_batch")
        .filter(reply.contains(request) | request.contains(reply))
        .groupBy("request_batch", "review_text")
        .agg(F.min(F.struct("request_text", "request_hash")).alias("hit"))
    )
    rest = open_rows.join(contained, ["request_batch", "review_text"], "left").select(
        *[F.col(c) for c in columns if c != "review_hash"],
        F.coalesce("hit.request_hash", "review_hash").alias("review_hash"),
        F.coalesce("hit.request_text", "review_text").alias("matched_text"),
    )
    return done.unionByName(rest)
