"""Reference masters, small dimension lookups and their seeding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.upsert import upsert

# Reference masters. A plain entry is both code (upper-cased) and name; a pair is (code, name).
MASTERS: dict[str, tuple] = {
    "city": (
        "Ahmedabad", "Bengaluru", "Bhopal", "Chandigarh", "Chennai", "Coimbatore", "Delhi", "Gurugram",
        "Hyderabad", "Indore", "Jaipur", "Kochi", "Kolkata", "Lucknow", "Mumbai", "Nagpur", "Noida", "Pune",
        "Surat", "Visakhapatnam",
    ),
    "acquisition_channel": ("Direct", "Organic", "Paid", "Referral", "Social"),
    "vehicle_type": (
        ("3 WHEELER", "3-Wheeler"), "Bike", "Car", "Cycle", ("EV 3 WHEELER", "Electric 3-Wheeler"),
        ("EV BIKE", "Electric Bike"), ("EV CYCLE", "Electric Cycle"), ("EV SCOOTER", "Electric Scooter"),
        "Scooter", "Van",
    ),
    "employment_type": ("Contract", "Full-Time", "Part-Time"),
    "category": (
        "Beverages", "Biryani", "Bowls", "Breads", "Burgers", "Curries", "Desserts", "Dosa", "Fried Rice",
        "Fries", "Idli", "Juices", "Momos", "Noodles", "Pizza", "Rice", "Salads",
        ("SHAKES", "Milkshakes & Smoothies"), "Sides", "Snacks", "Soups", "Starters",
        ("TIKKA KEBAB", "Tikka & Kebabs"), "Wraps",
    ),
    "cuisine_type": (
        "Bengali", "Biryani", "Chinese", "Desserts", "Fast Food", "Goan", "Gujarati", "Healthy", "Indo-Chinese",
        "Italian", "Maharashtrian", "North Indian", "Pizza", "South Indian",
    ),
    "partner_type": ("Cloud Kitchen", "Home Chef", "Restaurant"),
}

# Small lookup dimensions.
LIFE_CYCLES = (
    (0, "Unknown", "Default fallback for entities with no transaction history or unknown state"),
    (1, "New", "Entities newly registered or onboarded within the last 30 days"),
    (2, "Retained", "Active entities maintaining regular order activities within the last 30 days"),
    (3, "Reactivated", "Entities previously inactive (>30 days) that have resumed transactions"),
    (4, "Churned", "Entities with no order or transaction activity for more than 30 days"),
)
RATING_TYPES = (
    (0, "Unknown", "0.00", "0.00"),
    (1, "Excellent", "4.60", "5.00"),
    (2, "Good", "4.00", "4.59"),
    (3, "Average", "3.00", "3.99"),
    (4, "Poor", "2.00", "2.99"),
    (5, "Very Bad", "1.00", "1.99"),
)
SENTIMENT_TYPES = (
    (0, "Unknown", "0.0000", "0.0000"),
    (1, "Positive", "0.2000", "1.0000"),
    (2, "Neutral", "-0.2000", "0.1999"),
    (3, "Negative", "-1.0000", "-0.2001"),
)
ASPECTS = (
    (0, "Unknown", "Unclassified feedback aspect"),
    (1, "Food Quality", "Taste, freshness, temperature, cooking quality"),
    (2, "Delivery Service", "Rider punctuality, attitude, transit handling, delivery accuracy"),
    (3, "Customer Support", "Agent responsiveness, dispute resolution, refund assistance"),
    (4, "Packaging", "Container condition, sealing, spill prevention"),
    (5, "Portion & Value", "Serving size, quantity sufficiency, value for money"),
    (6, "Food Safety", "Hygiene standards, contamination, foreign objects, expiration"),
)


def master_rows(spark: SparkSession, name: str) -> DataFrame:
    pairs = [e if isinstance(e, tuple) else (e.upper(), e) for e in MASTERS[name]]
    return spark.createDataFrame([(c, n, True) for c, n in pairs], "code string, name string, is_active boolean")


def life_cycles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LIFE_CYCLES, "lc_id int, life_cycle string, description string")


def _bands(spark: SparkSession, rows, name: str, decimal: str) -> DataFrame:
    df = spark.createDataFrame(rows, f"{name}_id int, {name} string, min_score string, max_score string")
    return df.withColumns({c: F.col(c).cast(decimal) for c in ("min_score", "max_score")})


def rating_types(spark: SparkSession) -> DataFrame:
    return _bands(spark, RATING_TYPES, "rating_type", "decimal(3,2)")


def sentiment_types(spark: SparkSession) -> DataFrame:
    return _bands(spark, SENTIMENT_TYPES, "sentiment_type", "decimal(5,4)")


def aspects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASPECTS, "aspect_id int, aspect_name string, aspect_description string")


def seed_aspects(spark: SparkSession, current: DataFrame | None) -> DataFrame:
    """Merge the aspect seeds into the current table."""
    seeds = aspects(spark)
    if current is None:
        return seeds
    return upsert(current, seeds, ["aspect_id"], ["aspect_name", "aspect_description"]).drop("merge_action")


def seed_master(current: DataFrame, seeds: DataFrame) -> DataFrame:
    """Merge master seeds by code; the result carries `merge_action`."""
    return upsert(current, seeds, ["code"], ["name", "is_active"])


def seed_cache(current: DataFrame, seeds: DataFrame) -> DataFrame:
    """Merge review-aspect cache rows by (hash, aspect, sentiment)."""
    return upsert(
        current, seeds, ["review_hash", "aspect_id", "sentiment_type_id"], ["matched_phrase", "ai_model"]
    )


def seed_summary(merged: dict[str, DataFrame]) -> DataFrame:
    """Per master: inserted, updated and current rows, PASS or FAIL (EMPTY).

    Each table is aggregated on its own (an empty one still gives its row) before the small union.
    """
    parts = [
        df.agg(
            F.count_if(F.col("merge_action") == "INSERT").alias("rows_inserted"),
            F.count_if(F.col("merge_action") == "UPDATE").alias("rows_updated"),
            F.count(F.lit(1)).alias("total_current_rows"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in merged.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn(
        "validation_status", F.when(F.col("total_current_rows") > 0, "PASS").otherwise("FAIL (EMPTY)")
    )


def match_values(master: DataFrame) -> DataFrame:
    """One row per accepted spelling (code or upper-cased name) of each active entry.

    Turning `code = x OR upper(name) = x` into rows makes the lookup an equi-join. A spelling shared by two
    entries keeps one name, so the lookup never multiplies rows.
    """
    return (
        master.filter("is_active")
        .select(F.explode(F.array("code", F.upper("name"))).alias("match_value"), "name")
        .groupBy("match_value")
        .agg(F.min("name").alias("name"))
    )


@dataclass(frozen=True)
class MasterMatch:
    """Which column is looked up in which master, and where the display name goes."""

    column: str
    master: str

    @property
    def result(self) -> str:
        return f"{self.column}__master"


def attach_master(df: DataFrame, match: MasterMatch, master: DataFrame) -> DataFrame:
    """Left equi-join; Catalyst broadcasts the master when its size is below the session's limit."""
    values = match_values(master).select(
        F.col("match_value").alias(f"{match.result}_value"), F.col("name").alias(match.result)
    )
    return df.join(
        values, F.upper(F.trim(F.col(match.column))) == F.col(f"{match.result}_value"), "left"
    ).drop(f"{match.result}_value")


def display_name(match: MasterMatch) -> Column:
    return F.coalesce(F.col(match.result), F.trim(F.col(match.column)))
