"""Serving views over the star schema. `as_of` is explicit, so a view gives the same answer when repeated."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.calendar import key_to_date, key_to_time


@dataclass(frozen=True)
class ChurnRule:
    """Days without activity: churned above `churn`; high and medium risk limits for retained and other."""

    key: str
    start_column: str
    churn: int
    retained_high: int
    retained_medium: int
    other_high: int
    other_medium: int


# Thresholds per entity.
CUSTOMER_CHURN = ChurnRule("customer_key", "signup_date", 60, 45, 20, 30, 10)
RESTAURANT_CHURN = ChurnRule("restaurant_key", "onboard_date", 60, 45, 15, 21, 8)
PARTNER_CHURN = ChurnRule("delivery_partner_key", "onboard_date", 30, 30, 15, 15, 7)

RETAINED = 2
CHURNED = 4


def churn_columns(rule: ChurnRule, as_of: Column) -> dict[str, Column]:
    unknown = F.col(rule.key) == -1
    last = F.coalesce("last_active", rule.start_column)
    idle = F.datediff(as_of, last)
    churned = F.coalesce(idle > rule.churn, F.lit(False))
    status = F.when(unknown, 0).when(churned, CHURNED).otherwise(F.coalesce("life_cycle_id", F.lit(0)))
    retained = F.coalesce("life_cycle_id", F.lit(0)) == RETAINED
    high = F.when(retained, F.lit(rule.retained_high)).otherwise(rule.other_high)
    medium = F.when(retained, F.lit(rule.retained_medium)).otherwise(rule.other_medium)
    risk = (
        F.when(unknown, "Unknown")
        .when(churned, "Churned")
        .when(idle > high, "High")
        .when(idle >= medium, "Medium")
        .when(idle < medium, "Low")
        .otherwise("Undefined")
    )
    return {
        "life_cycle": F.col("life_cycle_id"),
        "days_since_last_active": F.when(~unknown, idle),
        "is_churned": ~unknown & churned,
        "churned_date": F.when(~unknown & churned, F.date_add(last, rule.churn)),
        "last_status_id": status,
        "last_status": status,
        "churn_risk": risk,
    }


def churn_view(dimension: DataFrame, rule: ChurnRule, as_of: Column) -> DataFrame:
    """Current versions with idle days, churn flag, status and risk."""
    hidden = ("valid_from", "valid_to", "is_current", "batch_id", "load_timestamp")
    shown = [c for c in dimension.columns if c not in hidden]
    return dimension.filter("is_current").select(
        *shown, *[c.alias(n) for n, c in churn_columns(rule, as_of).items()]
    )


def customer_view(dimension: DataFrame, as_of: Column) -> DataFrame:
    return churn_view(dimension, CUSTOMER_CHURN, as_of)


def restaurant_view(dimension: DataFrame, as_of: Column) -> DataFrame:
    return churn_view(dimension, RESTAURANT_CHURN, as_of)


def delivery_partner_view(dimension: DataFrame, as_of: Column) -> DataFrame:
    return churn_view(dimension, PARTNER_CHURN, as_of)


UNKNOWN = -1
#: Values that stand for unknown keys in a join.
SPREAD = 1 << 20


def _ids(facts: DataFrame, row: str, *dimensions: tuple[DataFrame, str, str]) -> DataFrame:
    """Attach business ids by surrogate key; keys are unique, so rows are neither lost nor multiplied.

    Rows without a key, or with that of the unknown member, may be a third of all facts. They go around the join: each gets
    one of many values that no member has, by a hash of its own id, so they spread over the tasks, and the id of the unknown
    member comes from a subquery."""
    for dimension, key, business_id in dimensions:
        known = F.col(key).isNotNull() & (F.col(key) != UNKNOWN)
        spread = (F.lit(UNKNOWN - 1) - F.pmod(F.xxhash64(row), F.lit(SPREAD))).cast("long")
        probe, found = f"_{key}", f"_{business_id}"
        members = dimension.filter(F.col(key) != UNKNOWN).select(F.col(key).alias(probe), F.col(business_id).alias(found))
        unknown = dimension.filter(F.col(key) == UNKNOWN).agg(F.max(business_id)).scalar()
        joined = facts.withColumn(probe, F.when(known, F.col(key).cast("long")).otherwise(spread)).join(members, probe, "left")
        facts = joined.withColumn(business_id, F.when(F.col(key) == UNKNOWN, unknown).otherwise(F.col(found))).drop(probe, found)
    return facts


def _surrogate(facts: DataFrame, name: str) -> list[str]:
    """The fact's own key leads the view when the table carries it."""
    return [name] if name in facts.columns else []


def menu_item_view(menu: DataFrame, restaurants: DataFrame) -> DataFrame:
    return _ids(menu, "menu_item_id", (restaurants, "restaurant_key", "restaurant_id")).select(
        "menu_item_key", "menu_item_id", "restaurant_key", "restaurant_id", "item_name", "category",
        "is_veg", "price",
    )


def calendar_view(calendar: DataFrame) -> DataFrame:
    return calendar


def time_view(clock: DataFrame) -> DataFrame:
    return clock


def rating_type_view(ratings: DataFrame) -> DataFrame:
    return ratings.select("rating_type_id", "rating_type", "min_score", "max_score")


def sentiment_type_view(sentiments: DataFrame) -> DataFrame:
    return sentiments.select(F.col("sentiment_type_id").alias("sentiment_id"), F.col("sentiment_type").alias("sentiment"), "min_score", "max_score")


def life_cycle_view(cycles: DataFrame) -> DataFrame:
    return cycles.select("lc_id", "life_cycle", "description")


def aspect_view(aspects: DataFrame) -> DataFrame:
    return aspects.select("aspect_id", F.col("aspect_name").alias("aspect"), "aspect_description")


def order_view(
    facts: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame
) -> DataFrame:
    with_ids = _ids(
        facts, "order_id",
        (customers, "customer_key", "customer_id"),
        (restaurants, "restaurant_key", "restaurant_id"),
        (partners, "delivery_partner_key", "delivery_partner_id"),
    )
    return with_ids.select(
        *_surrogate(facts, "order_key"), "order_id", "order_date_key", key_to_date(F.col("order_date_key")).alias("order_date"),
        "order_time_key", key_to_time(F.col("order_time_key")).alias("order_time"),
        "customer_key", "customer_id", "restaurant_key", "restaurant_id",
        "delivery_partner_key", "delivery_partner_id",
        "subtotal_amount", "discount_amount", "delivery_fee", "total_amount", "net_order_value",
        "is_cod", "is_cancelled", "cust_lc_id", "rest_lc_id", "driver_lc_id",
    )


def order_item_view(facts: DataFrame, menu: DataFrame) -> DataFrame:
    return _ids(facts, "order_item_id", (menu, "menu_item_key", "menu_item_id")).select(
        *_surrogate(facts, "order_item_key"), "order_item_id", "order_id", "order_date_key", "customer_key",
        "restaurant_key", "menu_item_key", "menu_item_id", "quantity", "unit_price", "gross_line_total", "item_discount", "net_line_total",
    )


def delivery_view(
    facts: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame
) -> DataFrame:
    with_ids = _ids(
        facts, "delivery_id",
        (customers, "customer_key", "customer_id"),
        (restaurants, "restaurant_key", "restaurant_id"),
        (partners, "delivery_partner_key", "delivery_partner_id"),
    )
    measures = (
        "order_item", "delivery_item", "is_infull", "prep_time", "rider_wait_time", "travel_time",
        "expected_delivery_time_min", "actual_delivery_time_min", "delivery_delay_min", "is_ontime",
        "late_time", "prep_late_time", "late_reason", "is_otif", "distance_km", "distance_bins",
        "travel_bins", "prep_time_bins", "actual_bins",
    )
    return with_ids.select(
        *_surrogate(facts, "delivery_key"), "delivery_id", "order_id", "delivery_date_key",
        key_to_date(F.col("delivery_date_key")).alias("delivery_date"),
        "customer_key", "customer_id", "restaurant_key", "restaurant_id",
        "delivery_partner_key", "delivery_partner_id", *measures,
    )


def rating_view(
    facts: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame
) -> DataFrame:
    with_ids = _ids(
        facts, "rating_id",
        (customers, "customer_key", "customer_id"),
        (restaurants, "restaurant_key", "restaurant_id"),
        (partners, "delivery_partner_key", "delivery_partner_id"),
    )
    return with_ids.select(
        *_surrogate(facts, "rating_key"), "rating_id", "order_id", "rating_date_key",
        key_to_date(F.col("rating_date_key")).alias("review_date"),
        "rating_time_key", key_to_time(F.col("rating_time_key")).alias("review_time"),
        "customer_key", "customer_id", "restaurant_key", "restaurant_id",
        "delivery_partner_key", "delivery_partner_id",
        "rating", "rating_type_id", "sentiment_score", "sentiment_type_id", "review_text",
    )


def review_aspect_view(facts: DataFrame, ratings: DataFrame) -> DataFrame:
    parents = ratings.select("rating_key", "rating_id", "rating_date_key")
    return facts.join(parents, "rating_key", "left").select(
        *_surrogate(facts, "review_aspect_key"), "rating_id", "aspect_id", F.col("sentiment_type_id").alias("sentiment_id"), "sentiment_type_id",
        key_to_date(F.col("rating_date_key")).alias("review_date"), "matched_phrase",
    )
