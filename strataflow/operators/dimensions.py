"""Entity dimensions: prepared sources, unknown members, menu items and post-fact enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.bands import band
from strataflow.functions.calendar import key_to_date
from strataflow.operators import scd2
from strataflow.operators.lookups import RATING_TYPES
from strataflow.operators.surrogate import fill_missing_keys, next_key
from strataflow.operators.upsert import upsert

# Preparation band -> (lowest, highest, group, index).
PREP_BANDS = {
    "<=15": (0, 15, "Fast", 1),
    "16-25": (16, 25, "Moderate", 2),
    "26-40": (26, 40, "Slow", 3),
    ">40": (41, 60, "Very Slow", 4),
}
ALL_BATCHES = -1


def of_batch(df: DataFrame, batch_id: int) -> DataFrame:
    """-1 means every batch: then no filter at all, otherwise one that prunes partitions."""
    return df if batch_id == ALL_BATCHES else df.filter(F.col("batch_id") == batch_id)


def effective_date(orders: DataFrame, batch_id: int, today: Column | None = None) -> Column:
    """First order date of the batch, else today, as a scalar subquery."""
    first = of_batch(orders, batch_id).agg(F.min(F.to_date("order_timestamp")).alias("d")).scalar()
    return F.coalesce(first, today if today is not None else F.current_date())


def customer_source(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "city", "signup_date", "acquisition_channel", "batch_id"
    )


def prep_columns(column: str = "avg_prep_time_min") -> dict[str, Column]:
    def pick(i: int) -> Column:
        expr = F.when(F.lit(False), F.lit(None))
        for text, entry in PREP_BANDS.items():
            expr = expr.when(F.col(column) == text, F.lit(entry[i]))
        return expr

    return {
        "min_prep_min": pick(0),
        "max_prep_min": pick(1),
        "prep_time_group": pick(2),
        "prep_time_index": pick(3),
    }


def restaurant_source(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        "restaurant_id", "restaurant_name", "city", "cuisine_type", "partner_type", "is_active",
        "onboard_date", "avg_prep_time_min",
        *[c.alias(n) for n, c in prep_columns().items()],
        "batch_id",
    )


def delivery_partner_source(partners: DataFrame) -> DataFrame:
    return partners.select(
        "delivery_partner_id", "partner_name", "city", "vehicle_type", "employment_type", "is_active",
        "onboard_date", "avg_rating",
        band(F.col("avg_rating"), RATING_TYPES, 0).alias("rating_type_id"),
        band(F.col("avg_rating"), RATING_TYPES, 1).alias("rating_type"),
        "batch_id",
    )


SOURCES = {
    "dim_customer": ("customer", customer_source),
    "dim_restaurant": ("restaurant", restaurant_source),
    "dim_delivery_partner": ("delivery_partner", delivery_partner_source),
}

DIMENSION_TYPES = {
    "dim_customer": (
        "customer_key bigint, customer_id string, city string, signup_date date, acquisition_channel string, "
        "last_active date, life_cycle_id int, valid_from date, valid_to date, is_current boolean, batch_id bigint"
    ),
    "dim_restaurant": (
        "restaurant_key bigint, restaurant_id string, restaurant_name string, city string, cuisine_type string, "
        "partner_type string, is_active boolean, onboard_date date, avg_prep_time_min string, min_prep_min int, "
        "max_prep_min int, prep_time_group string, prep_time_index int, last_active date, life_cycle_id int, "
        "valid_from date, valid_to date, is_current boolean, batch_id bigint"
    ),
    "dim_delivery_partner": (
        "delivery_partner_key bigint, delivery_partner_id string, partner_name string, city string, "
        "vehicle_type string, employment_type string, is_active boolean, onboard_date date, "
        "avg_rating decimal(5,2), rating_type_id int, rating_type string, last_active date, life_cycle_id int, "
        "valid_from date, valid_to date, is_current boolean, batch_id bigint"
    ),
    "dim_menu_item": (
        "menu_item_key bigint, menu_item_id string, restaurant_key bigint, item_name string, category string, "
        "is_veg boolean, price decimal(18,2), batch_id bigint"
    ),
}

# The unknown members that keep fact foreign keys filled.
_UNKNOWN_SPAN = {
    "last_active": "1900-01-01", "life_cycle_id": 0, "valid_from": "1900-01-01", "valid_to": "9999-12-31",
    "is_current": True, "batch_id": 0,
}
UNKNOWN_MEMBERS = {
    "dim_customer": {
        "customer_key": -1, "customer_id": "UNKNOWN", "signup_date": "1900-01-01", "city": "Unknown",
        "acquisition_channel": "Unknown", **_UNKNOWN_SPAN,
    },
    "dim_restaurant": {
        "restaurant_key": -1, "restaurant_id": "UNKNOWN", "onboard_date": "1900-01-01",
        "restaurant_name": "Unknown Restaurant", "city": "Unknown", "cuisine_type": "Unknown",
        "partner_type": "Unknown", "avg_prep_time_min": "Unknown", "is_active": False, "min_prep_min": 0,
        "max_prep_min": 0, "prep_time_group": "Unknown", "prep_time_index": 0, **_UNKNOWN_SPAN,
    },
    "dim_delivery_partner": {
        "delivery_partner_key": -1, "delivery_partner_id": "UNKNOWN", "onboard_date": "1900-01-01",
        "partner_name": "Unknown Driver", "city": "Unknown", "vehicle_type": "Unknown",
        "employment_type": "Unknown", "avg_rating": None, "is_active": False, "rating_type_id": 0,
        "rating_type": "Unknown", **_UNKNOWN_SPAN,
    },
    "dim_menu_item": {
        "menu_item_key": -1, "menu_item_id": "UNKNOWN", "restaurant_key": -1, "item_name": "Unknown Item",
        "category": "Unknown", "is_veg": None, "price": "0.00", "batch_id": 0,
    },
}


def empty_dimension(spark: SparkSession, name: str) -> DataFrame:
    """Only the unknown member."""
    row = UNKNOWN_MEMBERS[name]
    typed = spark.createDataFrame([], DIMENSION_TYPES[name]).schema
    return spark.range(1).select(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in typed.fields])


def load_dimension(
    name: str, dimension: DataFrame, typed_rows: DataFrame, effective: Column, first: Column | None = None
) -> DataFrame:
    """Hybrid SCD load of one entity dimension, numbered, with `scd_action` per row. New keys begin at `first`, by default
    behind those of `dimension`, which may be a part of the whole."""
    spec = scd2.DIMENSIONS[name]
    source = SOURCES[name][1](typed_rows)
    return scd2.with_keys(spec, scd2.apply_scd2(spec, dimension, source, effective), dimension, first)


def load_menu_items(menu: DataFrame, items: DataFrame, restaurants: DataFrame, first: Column | None = None) -> DataFrame:
    """Type-1 merge by menu item with the current restaurant key (-1 when there is none). New keys begin at `first`, by
    default behind those of `menu`."""
    current = restaurants.filter("is_current").select("restaurant_id", "restaurant_key")
    source = items.join(current, "restaurant_id", "left").select(
        F.lit(None).cast("long").alias("menu_item_key"),
        "menu_item_id",
        F.coalesce("restaurant_key", F.lit(-1)).cast("long").alias("restaurant_key"),
        "item_name", "category", "is_veg", "price", "batch_id",
    )
    merged = upsert(
        menu, source, ["menu_item_id"], ["restaurant_key", "item_name", "category", "is_veg", "price"],
        kept=["menu_item_key"],
    )
    start = next_key(menu, "menu_item_key") if first is None else first
    return fill_missing_keys(merged, "menu_item_id", "menu_item_key", start)


LIFE_CYCLE_COLUMNS = {
    "dim_customer": ("customer_key", "cust_lc_id", "signup_date"),
    "dim_restaurant": ("restaurant_key", "rest_lc_id", "onboard_date"),
    "dim_delivery_partner": ("delivery_partner_key", "driver_lc_id", "onboard_date"),
}


def _packed(facts: DataFrame, lifecycle: str) -> Column:
    """Order day and life cycle in one number, whose maximum is the last day and the highest life cycle on it. A date key
    of -1 stands for the unknown day."""
    day = F.when(F.col("order_date_key") == -1, 19000101).otherwise(F.col("order_date_key"))
    return day.cast("long") * 10 + F.coalesce(F.col(lifecycle), F.lit(0))


def bucket_of(business_id: str, buckets: int) -> Column:
    """The part of a dimension that holds all versions of an id."""
    return F.pmod(F.xxhash64(business_id), F.lit(buckets)).cast("int")


def month_activity(facts: DataFrame) -> DataFrame:
    """(dimension, member, month_key, top): the packed last activity of each key in each month. Maxima of months merge, so
    a batch computes those of the months it has written and leaves the others."""
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("dimension"), F.col(key).alias("member"), _packed(facts, lifecycle).alias("top"))
        for n, (key, lifecycle, _) in LIFE_CYCLE_COLUMNS.items()
    ]))
    rows = facts.select("month_key", each.alias("e")).select("month_key", "e.*").filter(F.col("member") != -1)
    return rows.groupBy("dimension", "member", "month_key").agg(F.max("top").alias("top"))


def _unpacked(tops: DataFrame, key: str) -> DataFrame:
    return tops.select(
        key,
        key_to_date((F.col("top") / 10).cast("int")).alias("last_order_date"),
        (F.col("top") % 10).cast("int").alias("last_life_cycle_id"),
    )


def stored_activity(name: str, activity: DataFrame, active: DataFrame) -> DataFrame:
    """`last_activity` from stored maxima of months, for the keys in the only column of `active`."""
    key = LIFE_CYCLE_COLUMNS[name][0]
    mine = activity.filter(F.col("dimension") == name).select(F.col("member").alias(key), "top")
    return _unpacked(mine.join(active.distinct(), key, "left_semi").groupBy(key).agg(F.max("top").alias("top")), key)


def last_activity(
    facts: DataFrame, key: str, lifecycle: str, batch_id: int = ALL_BATCHES
) -> DataFrame:
    """Last order day, and the highest life cycle on that day, of the keys active in the batch.

    Day and life cycle are packed into one number whose maximum is both answers: one hash aggregate with a
    map-side combine, instead of two aggregates and a self join.
    """
    known = facts.filter(F.col(key) != -1)
    if batch_id != ALL_BATCHES:
        active = of_batch(known, batch_id).select(key).distinct()
        known = known.join(active, key, "left_semi")
    return _unpacked(known.groupBy(key).agg(F.max(_packed(facts, lifecycle)).alias("top")), key)


def enrich(name: str, dimension: DataFrame, facts: DataFrame, batch_id: int = ALL_BATCHES) -> DataFrame:
    """Write last activity and life cycle back to the current versions."""
    key, lifecycle, _ = LIFE_CYCLE_COLUMNS[name]
    return with_activity(name, dimension, last_activity(facts, key, lifecycle, batch_id))


def with_activity(name: str, dimension: DataFrame, activity: DataFrame) -> DataFrame:
    """The dimension with the given last activity in its current versions."""
    key, _, start = LIFE_CYCLE_COLUMNS[name]
    hit = F.col("last_life_cycle_id").isNotNull() & F.col("is_current") & (F.col(key) != -1)
    replaced = {
        "last_active": F.when(hit, F.coalesce("last_order_date", start)).otherwise(F.col("last_active")),
        "life_cycle_id": F.when(hit, F.col("last_life_cycle_id")).otherwise(F.col("life_cycle_id")),
    }
    return dimension.join(activity, key, "left").select(
        *[replaced[c].alias(c) if c in replaced else F.col(c) for c in dimension.columns]
    )
