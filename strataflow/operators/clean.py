"""Typed projections of clean rows, and the last row per business key within a batch."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions import parsing as P
from strataflow.operators.gates import VALUE
from strataflow.operators.lookups import MasterMatch, display_name
from strataflow.spec import ENTITIES, LINEAGE

REVIEW_LIMIT = 4000


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("source_row_number", "source_file_name"),
) -> DataFrame:
    """The row with the highest order columns per key.

    Spark takes the limit of one row per key below the exchange, so each map task already reduces a key to one row: a key
    that holds a third of the table costs one row per task in the shuffle. Sorting by a hash first compares whole
    numbers; ids of one kind begin with the same letters and digits.
    """
    place = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def _named(column: str) -> Column:
    return display_name(MasterMatch(column, column))


def _or_null(column: str) -> Column:
    return F.nullif(P.text(column), F.lit(""))


def typed_columns(entity: str, columns: Collection[str] = ()) -> dict[str, Column]:
    """Typed expression per target column. Values that the gates have parsed already, which are among `columns` then, are
    taken over."""
    key = P.key_text

    def parsed(parse):
        return lambda name, *args, **options: F.col(name + VALUE) if name + VALUE in columns else parse(name, *args, **options)

    whole, money, number, date, timestamp = (parsed(f) for f in (P.as_whole, P.as_decimal, P.as_int, P.as_date, P.as_timestamp))

    def money_or_zero(column: str) -> Column:
        return F.coalesce(money(column), F.lit(0).cast("decimal(18,2)"))

    if entity == "customer":
        return {
            "customer_id": key("customer_id"),
            "signup_date": date("signup_date", day_first=True),
            "city": _named("city"),
            "acquisition_channel": _named("acquisition_channel"),
        }
    if entity == "restaurant":
        return {
            "restaurant_id": key("restaurant_id"),
            "onboard_date": date("onboard_date"),
            "restaurant_name": P.text("restaurant_name"),
            "city": _named("city"),
            "cuisine_type": _named("cuisine_type"),
            "partner_type": _named("partner_type"),
            "avg_prep_time_min": _or_null("avg_prep_time_min"),
            "is_active": P.is_yes("is_active"),
        }
    if entity == "delivery_partner":
        return {
            "delivery_partner_id": key("delivery_partner_id"),
            "onboard_date": date("onboard_date"),
            "partner_name": P.or_unknown_name("partner_name"),
            "city": _named("city"),
            "vehicle_type": _named("vehicle_type"),
            "employment_type": _named("employment_type"),
            "avg_rating": money("avg_rating", 5, 2),
            "is_active": P.is_yes("is_active"),
        }
    if entity == "menu_item":
        return {
            "menu_item_id": key("menu_item_id"),
            "restaurant_id": key("restaurant_id"),
            "item_name": P.or_unknown_name("item_name"),
            "category": _named("category"),
            "is_veg": P.is_yes("is_veg"),
            "price": money("price", 10, 2).cast("decimal(18,2)"),
        }
    if entity == "order":
        return {
            "order_id": key("order_id"),
            "customer_id": key("customer_id"),
            "restaurant_id": key("restaurant_id"),
            "delivery_partner_id": F.nullif(key("delivery_partner_id"), F.lit("")),
            "order_timestamp": timestamp("order_timestamp"),
            "subtotal_amount": money("subtotal_amount"),
            "discount_amount": money_or_zero("discount_amount"),
            "delivery_fee": money_or_zero("delivery_fee"),
            "total_amount": money("total_amount"),
            "is_cod": P.is_yes("is_cod"),
            "is_cancelled": P.is_yes("is_cancelled"),
        }
    if entity == "order_item":
        return {
            "order_item_id": key("order_item_id"),
            "order_id": key("order_id"),
            "menu_item_id": key("menu_item_id"),
            "quantity": number("quantity"),
            "unit_price": money("unit_price"),
            "item_discount": money("item_discount"),
            "line_total": money("line_total"),
        }
    if entity == "delivery_performance":
        minutes = (
            "prep_time", "rider_wait_time", "travel_time", "order_item",
            "expected_delivery_time_min", "actual_delivery_time_min", "delivery_item",
        )
        return {
            "delivery_id": key("delivery_id"),
            "order_id": key("order_id"),
            **{c: whole(c) for c in minutes},
            "distance_km": money("distance_km", 10, 2),
        }
    if entity == "rating":
        return {
            "rating_id": key("rating_id"),
            "order_id": key("order_id"),
            "customer_id": key("customer_id"),
            "restaurant_id": key("restaurant_id"),
            "rating": money("rating", 3, 2),
            "review_text": F.nullif(F.substring(P.text("review_text"), 1, REVIEW_LIMIT), F.lit("")),
            "review_timestamp": timestamp("review_timestamp"),
            "sentiment_score": money("sentiment_score", 5, 4),
        }
    raise KeyError(entity)


def clean_rows(entity: str, passed_rows: DataFrame, wanted: Collection[str] | None = None) -> DataFrame:
    """Typed rows plus lineage, one per (batch, business key); with `wanted`, of the typed columns only those and the key."""
    lineage = [c for c in LINEAGE if c in passed_rows.columns]
    key = ENTITIES[entity].key
    columns = [c.alias(n) for n, c in typed_columns(entity, passed_rows.columns).items() if wanted is None or n in (key, *wanted)]
    typed = passed_rows.select(*columns, *lineage)
    return keep_latest(typed, ["batch_id", key])
