"""Fact builders: point-in-time keys, life cycles, delivery KPIs, ratings, and late-parent relinking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions import bands as B
from strataflow.functions.calendar import date_key, time_key
from strataflow.operators.lookups import RATING_TYPES, SENTIMENT_TYPES
from strataflow.operators.surrogate import assign_keys, fill_missing_keys
from strataflow.operators.upsert import upsert

UNKNOWN = -1
# Days without an order after which the next one counts as a reactivation.
LIFE_CYCLE_GAP = {"customer": 60, "restaurant": 60, "delivery_partner": 30}
LIFE_CYCLE_NAME = {"customer": "cust_lc_id", "restaurant": "rest_lc_id", "delivery_partner": "driver_lc_id"}


def previous_active_date(orders: DataFrame, entity_id: str, day: str = "order_date") -> DataFrame:
    """Previous distinct order day per entity.

    The distinct runs first (with a map-side combine), so a window group never holds more rows than there are
    calendar days, however many orders its entity has.
    """
    days = orders.select(entity_id, day).distinct()
    previous = F.lag(day).over(Window.partitionBy(entity_id).orderBy(day))
    return days.select("*", previous.alias("previous_date")).filter(F.col(entity_id).isNotNull())


def life_cycle(
    previous: Column, order_date: Column, gap_days: Column | int, last_active: Column | None = None,
    known_life_cycle: Column | None = None,
) -> Column:
    """1 New, 2 Retained (gap within the limit), 3 Reactivated.

    Without an earlier day in the batch, the dimension's last activity counts when its life cycle is known.
    """
    earlier = previous
    if last_active is not None:
        cached = F.when(F.coalesce(known_life_cycle, F.lit(0)) != 0, last_active)
        earlier = F.coalesce(previous, cached)
    gap = F.datediff(order_date, earlier)
    return F.when(earlier.isNull(), 1).when(gap <= gap_days, 2).when(gap > gap_days, 3).otherwise(0)


def net_order_value() -> Column:
    zero = F.lit(0).cast("decimal(18,2)")
    return (F.coalesce("subtotal_amount", zero) - F.coalesce("discount_amount", zero)).cast("decimal(18,2)")


def point_in_time(
    facts: DataFrame, dimension: DataFrame, business_id: str, key: str, day: str, keep: dict[str, str] | None = None
) -> DataFrame:
    """Attach the version valid on the day; `key` stays NULL when none is.

    The join is keyed on the business id with the interval as residual condition. Versions of one id never
    overlap, so the row count is unchanged.
    """
    kept = [F.col(c).alias(n) for c, n in (keep or {}).items()]
    versions = dimension.select(
        F.col(business_id).alias(f"{key}_id"), F.col("valid_from").alias(f"{key}_from"),
        F.col("valid_to").alias(f"{key}_to"), key, *kept,
    )
    inside = (F.col(business_id) == F.col(f"{key}_id")) & F.col(day).between(
        F.col(f"{key}_from"), F.col(f"{key}_to")
    )
    return facts.join(versions, inside, "left")


def known_date_key(df: DataFrame, day_key: str, calendar: DataFrame) -> DataFrame:
    """Mark the keys the calendar knows: `calendar_key` is NULL for days outside it."""
    keys = calendar.select(F.col("date_key").alias("calendar_key"))
    return df.join(keys, F.col(day_key) == F.col("calendar_key"), "left")


def _entity_days(base: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Version key and life cycle of every (entity, id, day) on which an id ordered.

    The three entities run through one plan, at the grain of distinct days: versions, cached activity and the day before
    are looked up once per id and day, however many orders share them. Rows without an id stay out of it.
    """
    ids = F.explode(F.array(*[F.struct(F.lit(e).alias("entity"), F.col(f"{e}_id").alias("id")) for e in dimensions]))
    days = base.select("order_date", ids.alias("e")).select("e.entity", "e.id", "order_date").filter("id IS NOT NULL").distinct()
    before = F.lag("order_date").over(Window.partitionBy("entity", "id").orderBy("order_date"))
    versions = reduce(
        DataFrame.unionByName,
        (
            d.select(
                F.lit(e).alias("entity"), F.col(f"{e}_id").alias("id"), "valid_from", "valid_to",
                F.col(f"{e}_key").cast("long").alias("key"), "last_active", "life_cycle_id",
            )
            for e, d in dimensions.items()
        ),
    )
    inside = F.col("order_date").between(F.col("valid_from"), F.col("valid_to"))
    same = (F.col("d.entity") == F.col("v.entity")) & (F.col("d.id") == F.col("v.id"))
    met = days.withColumn("previous", before).alias("d").join(versions.alias("v"), same & inside, "left")
    gap = F.create_map(*[F.lit(x) for pair in LIFE_CYCLE_GAP.items() for x in pair])[F.col("d.entity")]
    cycle = life_cycle(F.col("previous"), F.col("order_date"), gap, F.col("last_active"), F.col("life_cycle_id"))
    return met.select(F.col("d.entity").alias("entity"), F.col("d.id").alias("id"), "order_date", "key", cycle.alias("cycle"))


def build_fact_order(
    orders: DataFrame, calendar: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame
) -> DataFrame:
    """Typed orders with resolved keys, net value and the three life cycles.

    What the ids and days give comes back as three narrow rows per order, gathered by order id, so the wide orders are
    shuffled once.
    """
    dimensions = {"customer": customers, "restaurant": restaurants, "delivery_partner": partners}
    base = orders.select(
        "*", F.to_date("order_timestamp").alias("order_date"), date_key(F.col("order_timestamp")).alias("day_key")
    )
    ids = F.explode(F.array(*[F.struct(F.lit(e).alias("entity"), F.col(f"{e}_id").alias("id")) for e in dimensions]))
    narrow = base.select("order_id", "order_date", ids.alias("e")).select("order_id", "order_date", "e.entity", "e.id").filter("id IS NOT NULL")
    found = narrow.join(_entity_days(base, dimensions), ["entity", "id", "order_date"])

    def of(entity: str, column: str) -> Column:
        return F.max(F.when(F.col("entity") == entity, F.col(column)))

    gathered = found.groupBy("order_id").agg(
        *[of(e, "key").alias(f"{e}_key") for e in dimensions], *[of(e, "cycle").alias(LIFE_CYCLE_NAME[e]) for e in dimensions]
    )
    out = known_date_key(base, "day_key", calendar).join(gathered, "order_id", "left")
    # What has no id or no day counts as a first order; only a missing delivery partner has no life cycle.
    cycles = [
        F.coalesce(n, F.when(F.lit(e != "delivery_partner") | F.col(f"{e}_id").isNotNull(), 1)).alias(n)
        for e, n in LIFE_CYCLE_NAME.items()
    ]
    return out.select(
        "order_id",
        F.coalesce("calendar_key", F.lit(UNKNOWN)).alias("order_date_key"),
        F.coalesce(time_key(F.col("order_timestamp")), F.lit(UNKNOWN)).alias("order_time_key"),
        *[F.coalesce(f"{e}_key", F.lit(UNKNOWN)).cast("long").alias(f"{e}_key") for e in dimensions],
        "subtotal_amount", "discount_amount", "delivery_fee", "total_amount",
        net_order_value().alias("net_order_value"), "is_cod", "is_cancelled", *cycles, "batch_id",
    )


def build_fact_order_item(items: DataFrame, fact_order: DataFrame, menu: DataFrame) -> DataFrame:
    """Lines with the keys of their order; unmatched parents give -1."""
    parents = fact_order.select("order_id", "order_date_key", "customer_key", "restaurant_key")
    menu_keys = menu.select("menu_item_id", "menu_item_key")
    joined = items.join(parents, "order_id", "left").join(menu_keys, "menu_item_id", "left")
    gross = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    net = (F.col("quantity") * F.col("unit_price") - F.col("item_discount")).cast("decimal(18,2)")
    return joined.select(
        "order_item_id", "order_id",
        F.coalesce("order_date_key", F.lit(UNKNOWN)).alias("order_date_key"),
        *[
            F.coalesce(c, F.lit(UNKNOWN)).cast("long").alias(c)
            for c in ("customer_key", "restaurant_key", "menu_item_key")
        ],
        "quantity", "unit_price", gross.alias("gross_line_total"), "item_discount",
        net.alias("net_line_total"), "batch_id",
    )


def delivery_kpis(max_prep: Column) -> dict[str, Column]:
    """On-time in-full flags, delay, late reason and bins; unparsed inputs count as not met."""
    expected, actual = F.col("expected_delivery_time_min"), F.col("actual_delivery_time_min")
    prep = F.col("prep_time")
    delay = actual - expected
    late = actual > expected
    overrun = prep - max_prep
    in_full = F.coalesce(F.col("delivery_item") >= F.col("order_item"), F.lit(False))
    on_time = F.coalesce(actual <= expected, F.lit(False))
    reason = (
        F.when(late & (overrun > 0) & (overrun >= delay), "Prep-Time")
        .when(late & (overrun > 0) & (overrun < delay), "Both")
        .when(late & ((prep <= max_prep) | max_prep.isNull()), "Travel-Time")
    )
    return {
        "is_infull": in_full,
        "delivery_delay_min": delay,
        "is_ontime": on_time,
        "late_time": F.when(late, delay),
        "prep_late_time": F.when(overrun > 0, overrun),
        "late_reason": reason,
        "is_otif": in_full & on_time,
        "distance_bins": B.bins(F.col("distance_km"), *B.DISTANCE_BINS),
        "travel_bins": B.bins(F.col("travel_time"), *B.TRAVEL_BINS),
        "prep_time_bins": B.bins(prep, *B.PREP_BINS),
        "actual_bins": B.bins(actual, *B.ACTUAL_BINS),
    }


def build_fact_delivery(deliveries: DataFrame, fact_order: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Deliveries with the keys of their order and the restaurant version's preparation limit."""
    parents = fact_order.select(
        "order_id", "order_date_key", "customer_key", "restaurant_key", "delivery_partner_key"
    )
    limits = restaurants.select(F.col("restaurant_key"), "max_prep_min")
    joined = deliveries.join(parents, "order_id", "left").join(limits, "restaurant_key", "left")
    kpis = delivery_kpis(F.col("max_prep_min"))
    return joined.select(
        "delivery_id", "order_id",
        F.coalesce("order_date_key", F.lit(UNKNOWN)).alias("delivery_date_key"),
        *[
            F.coalesce(c, F.lit(UNKNOWN)).cast("long").alias(c)
            for c in ("customer_key", "restaurant_key", "delivery_partner_key")
        ],
        "order_item", "delivery_item", "prep_time", "rider_wait_time", "travel_time",
        "expected_delivery_time_min", "actual_delivery_time_min", "distance_km",
        *[c.alias(n) for n, c in kpis.items()],
        "batch_id",
    )


def build_fact_rating(
    ratings: DataFrame, fact_order: DataFrame, calendar: DataFrame, customers: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """Ratings keyed through their order, else by the version valid on the review day, else -1."""
    parents = fact_order.select(
        "order_id",
        F.col("customer_key").alias("order_customer_key"),
        F.col("restaurant_key").alias("order_restaurant_key"),
        "delivery_partner_key",
    )
    base = ratings.select(
        "*", F.to_date("review_timestamp").alias("review_date"),
        date_key(F.col("review_timestamp")).alias("day_key"),
    )
    # Ratings bring their own customer and restaurant ids; only the keys of the versions are wanted here.
    out = known_date_key(base.join(parents, "order_id", "left"), "day_key", calendar)
    out = point_in_time(out, customers, "customer_id", "customer_key", "review_date")
    out = point_in_time(out, restaurants, "restaurant_id", "restaurant_key", "review_date")
    return out.select(
        "rating_id", "order_id", F.coalesce("calendar_key", F.lit(UNKNOWN)).alias("rating_date_key"),
        F.coalesce(time_key(F.col("review_timestamp")), F.lit(UNKNOWN)).alias("rating_time_key"),
        F.coalesce("order_customer_key", "customer_key", F.lit(UNKNOWN)).cast("long").alias("customer_key"),
        F.coalesce("order_restaurant_key", "restaurant_key", F.lit(UNKNOWN)).cast("long").alias("restaurant_key"),
        F.coalesce("delivery_partner_key", F.lit(UNKNOWN)).cast("long").alias("delivery_partner_key"),
        "rating",
        F.coalesce(B.band(F.col("rating"), RATING_TYPES), F.lit(0)).alias("rating_type_id"),
        "sentiment_score",
        F.coalesce(B.band(F.col("sentiment_score"), SENTIMENT_TYPES), F.lit(0)).alias("sentiment_type_id"),
        "review_text", "batch_id",
    )


FACT_KEYS = {
    "fact_order": "order_id",
    "fact_order_item": "order_item_id",
    "fact_delivery_performance": "delivery_id",
    "fact_rating": "rating_id",
}


# Surrogate keys of the fact rows; a row keeps its key for good.
FACT_SURROGATES = {
    "fact_order": "order_key",
    "fact_order_item": "order_item_key",
    "fact_delivery_performance": "delivery_key",
    "fact_rating": "rating_key",
}


def upsert_fact(name: str, target: DataFrame, source: DataFrame) -> DataFrame:
    """Update changed facts and insert absent ones by business key; the batch id alone is no change."""
    key, surrogate = FACT_KEYS[name], FACT_SURROGATES[name]
    tracked = [c for c in source.columns if c not in (key, surrogate, "batch_id")]
    return upsert(target, source, [key], tracked, kept=[surrogate])


def merge_fact(name: str, target: DataFrame | None, source: DataFrame, first: Column | int) -> DataFrame:
    """`upsert_fact` with surrogate keys: new rows are numbered from `first`, the others keep theirs."""
    key, surrogate = FACT_KEYS[name], FACT_SURROGATES[name]
    fresh = source.drop(surrogate).withColumn(surrogate, F.lit(None).cast("long"))
    if target is None:
        return assign_keys(fresh, key, surrogate, first)
    merged = upsert_fact(name, target, fresh.select(*target.columns)).drop("merge_action")
    return fill_missing_keys(merged, key, surrogate, first)


# Keys a late parent may still fill: fact column -> fact_order column.
RELINK = {
    "fact_order_item": {
        "order_date_key": "order_date_key", "customer_key": "customer_key", "restaurant_key": "restaurant_key",
    },
    "fact_delivery_performance": {
        "delivery_date_key": "order_date_key", "customer_key": "customer_key",
        "restaurant_key": "restaurant_key", "delivery_partner_key": "delivery_partner_key",
    },
    "fact_rating": {
        "delivery_partner_key": "delivery_partner_key", "customer_key": "customer_key",
        "restaurant_key": "restaurant_key",
    },
}


def _orphan(columns) -> Column:
    cond = F.lit(False)
    for c in columns:
        cond = cond | (F.col(c) == UNKNOWN)
    return cond


def orphans(name: str, facts: DataFrame) -> DataFrame:
    """(fact key, order_id, month_key) of the rows that a late parent may still complete."""
    return facts.filter(_orphan(RELINK[name])).select(FACT_KEYS[name], "order_id", "month_key")


def _relink_pairs(name: str, facts: DataFrame, fact_order: DataFrame) -> DataFrame:
    pairs = RELINK[name]
    parents = fact_order.select(
        "order_id", *[F.col(p).alias(f"parent_{c}") for c, p in pairs.items()]
    )
    fixes = F.lit(False)
    for c in pairs:
        fixes = fixes | ((F.col(c) == UNKNOWN) & (F.col(f"parent_{c}") != UNKNOWN))
    return facts.filter(_orphan(pairs)).join(parents, "order_id", "left").withColumn(
        "relinked", F.coalesce(fixes, F.lit(False))
    )


def relink(name: str, facts: DataFrame, fact_order: DataFrame) -> DataFrame:
    """Replace -1 keys by those of a parent order that arrived later.

    Only rows that hold a -1 are joined; the rest of the fact table passes through without a shuffle.
    """
    pairs = RELINK[name]
    linked = _relink_pairs(name, facts, fact_order).select(
        *[
            F.when(F.col("relinked") & (F.col(c) == UNKNOWN), F.col(f"parent_{c}")).otherwise(F.col(c)).alias(c)
            if c in pairs
            else F.col(c)
            for c in facts.columns
        ],
        "relinked",
    )
    whole = facts.filter(~_orphan(pairs)).withColumn("relinked", F.lit(False))
    return whole.unionByName(linked)


def relink_preview(name: str, facts: DataFrame, fact_order: DataFrame) -> DataFrame:
    """Dry run: how many rows a relink would change."""
    return _relink_pairs(name, facts, fact_order).agg(
        F.lit(name).alias("fact_name"), F.count_if("relinked").alias("rows_to_relink")
    )
