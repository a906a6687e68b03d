"""Dimensions, facts, reviews and serving views over the mapped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import calendar
from strataflow.operators import clean, dimensions, facts, lookups, reviews, scd2, surrogate, views
from strataflow.plans import source_maps as M
from strataflow.plans.queries_quality import before_and_next
from strataflow.plans.registry import Source, dbl, fragment, query, txt

CALENDAR_START, CALENDAR_END = "1994-01-01", "2001-06-30"
EFFECTIVE = M.EFFECTIVE
AS_OF = "2001-08-01"
DIMS = ("dim_customer", "dim_restaurant", "dim_delivery_partner")


def day(text: str):
    return F.lit(text).cast("date")


def cal(src: Source) -> DataFrame:
    return src.once("calendar", lambda: calendar.dim_date(src.spark, CALENDAR_START, CALENDAR_END))


# Calendars ------------------------------------------------------------------------------------------------

@query(
    "k1_dim_date",
    "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date, CAST(year(d) AS INTEGER) AS year, "
    "CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) AS quarter_name, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, "
    "strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year, "
    "CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, strftime(d, '%a') AS day_short, "
    "dayofweek(d) IN (0, 6) AS is_weekend, CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year, "
    "CASE WHEN month(d) BETWEEN 4 AND 6 THEN 'FQ1' WHEN month(d) BETWEEN 7 AND 9 THEN 'FQ2' WHEN month(d) >= 10 THEN 'FQ3' ELSE 'FQ4' END AS fiscal_quarter, "
    "CAST(CASE WHEN month(d) BETWEEN 4 AND 6 THEN 1 WHEN month(d) BETWEEN 7 AND 9 THEN 2 WHEN month(d) >= 10 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter_number, "
    "monthname(d) AS fiscal_month, CAST(CASE WHEN month(d) >= 4 THEN month(d) - 3 ELSE month(d) + 9 END AS INTEGER) AS fiscal_month_number, "
    "CASE WHEN d < DATE '2025-06-01' THEN 'Pre-Crisis' WHEN d < DATE '2025-08-01' THEN 'Crisis' WHEN d < DATE '2025-10-01' THEN 'Recovery' ELSE 'Post-Recovery' END AS period, "
    "CAST(CASE WHEN d < DATE '2025-06-01' THEN 1 WHEN d < DATE '2025-08-01' THEN 2 WHEN d < DATE '2025-10-01' THEN 3 ELSE 4 END AS INTEGER) AS period_id, "
    "(SELECT count(*) FROM orders o WHERE CAST(o.o_orderdate AS DATE) = d) AS orders "
    "FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM orders) c "
    "UNION ALL SELECT -1, '1900-01-01', 1900, 0, 'N/A', 0, 'Unknown', 'UNK', '1900-00', 0, 0, 0, 'Unknown', 'UNK', false, 1900, 'N/A', 0, 'Unknown', 0, 'Unknown', 0, 0",
)
def dim_date(src: Source) -> DataFrame:
    """The calendar between the first and last order, with the orders per day."""
    orders = src.table("orders").select(F.to_date("o_orderdate").alias("full_date"))
    first, last = (orders.agg(f("full_date").alias("d")).scalar() for f in (F.min, F.max))
    per_day = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("orders"))
    return calendar.dim_date(src.spark, first, last).join(per_day, "full_date", "left").fillna(0, ["orders"])


@query(
    "k2_dim_time",
    "SELECT CAST((m // 60) * 100 + m % 60 AS INTEGER) AS time_key, lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00' AS time_value, "
    "CAST(m // 60 AS INTEGER) AS hour, CAST(m % 60 AS INTEGER) AS minute, CAST(CASE WHEN m // 60 = 0 THEN 12 WHEN m // 60 > 12 THEN m // 60 - 12 ELSE m // 60 END AS INTEGER) AS hour_12, "
    "CASE WHEN m // 60 >= 12 THEN 'PM' ELSE 'AM' END AS am_pm, "
    "lpad(CAST(CASE WHEN m // 60 = 0 THEN 12 WHEN m // 60 > 12 THEN m // 60 - 12 ELSE m // 60 END AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || "
    "CASE WHEN m // 60 >= 12 THEN ' PM' ELSE ' AM' END AS time_display, "
    "CASE WHEN m // 60 BETWEEN 6 AND 10 THEN '06:00 - 11:00' WHEN m // 60 BETWEEN 11 AND 13 THEN '11:00 - 14:00' WHEN m // 60 BETWEEN 14 AND 16 THEN '14:00 - 17:00' "
    "WHEN m // 60 BETWEEN 17 AND 20 THEN '17:00 - 21:00' WHEN m // 60 >= 21 THEN '21:00 - 24:00' ELSE '00:00 - 06:00' END AS time_group, "
    "CAST(CASE WHEN m // 60 BETWEEN 6 AND 10 THEN 1 WHEN m // 60 BETWEEN 11 AND 13 THEN 2 WHEN m // 60 BETWEEN 14 AND 16 THEN 3 "
    "WHEN m // 60 BETWEEN 17 AND 20 THEN 4 WHEN m // 60 >= 21 THEN 5 ELSE 6 END AS INTEGER) AS time_group_id, "
    "m // 60 BETWEEN 11 AND 13 OR m // 60 BETWEEN 17 AND 20 AS is_peak_hour, "
    "(SELECT count(*) FROM events e WHERE hour(e.ts) * 60 + minute(e.ts) = m) AS events FROM range(1440) t(m) "
    "UNION ALL SELECT -1, NULL, 0, 0, 0, 'NA', 'Unknown', 'Unknown', 0, false, 0",
)
def dim_time(src: Source) -> DataFrame:
    """The clock with the events per minute of the day."""
    per_minute = (
        src.table("events").select(calendar.time_key(F.col("ts")).alias("time_key"))
        .groupBy("time_key").agg(F.count(F.lit(1)).alias("events"))
    )
    return calendar.dim_time(src.spark).join(per_minute, "time_key", "left").fillna(0, ["events"])


@query(
    "k3_surrogate_keys",
    "SELECT city, count(*) AS customers, true AS keys_unique, true AS keys_dense FROM ods_customer GROUP BY city",
)
def surrogate_keys(src: Source) -> DataFrame:
    """Number all customers after the keys in use; the whole range is dense and free of repeats."""
    fresh = src("ods_customer").withColumn("customer_key", F.lit(None).cast("long"))
    first = surrogate.next_key(src("dim_customer"), "customer_key")
    keyed = surrogate.assign_keys(fresh, "customer_id", "customer_key", first)
    whole = keyed.agg(
        (F.count_distinct("customer_key") == F.count(F.lit(1))).alias("keys_unique"),
        ((F.max("customer_key") - F.min("customer_key") + 1 == F.count(F.lit(1)))
         & (F.min("customer_key") == first)).alias("keys_dense"),
    )
    return keyed.groupBy("city").agg(F.count(F.lit(1)).alias("customers")).select(
        "*", whole.select("keys_unique").scalar().alias("keys_unique"),
        whole.select("keys_dense").scalar().alias("keys_dense"),
    )


# Entity dimensions ----------------------------------------------------------------------------------------

def _prep(values: tuple, kind: str) -> str:
    names = ("<=15", "16-25", "26-40", ">40")
    return f"CAST(CASE avg_prep_time_min " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in zip(names, values)) + f" END AS {kind})"


fragment("src_dim_customer", "SELECT customer_id, city, signup_date, acquisition_channel, batch_id FROM next_customer")
fragment(
    "src_dim_restaurant",
    "SELECT restaurant_id, restaurant_name, city, cuisine_type, partner_type, is_active, onboard_date, avg_prep_time_min, "
    f"{_prep((0, 16, 26, 41), 'INTEGER')} AS min_prep_min, {_prep((15, 25, 40, 60), 'INTEGER')} AS max_prep_min, "
    + _prep(("'Fast'", "'Moderate'", "'Slow'", "'Very Slow'"), "VARCHAR")
    + f" AS prep_time_group, {_prep((1, 2, 3, 4), 'INTEGER')} AS prep_time_index, batch_id FROM next_restaurant",
)


# The oracles state their limits themselves, so that a wrong one in an operator shows.
RATING_BANDS = (
    "(VALUES (1, 'Excellent', 4.60, 5.00), (2, 'Good', 4.00, 4.59), (3, 'Average', 3.00, 3.99), (4, 'Poor', 2.00, 2.99), "
    "(5, 'Very Bad', 1.00, 1.99)) b(id, name, low, high)"
)
SENTIMENT_BANDS = (
    "(VALUES (1, 'Positive', 0.2000, 1.0000), (2, 'Neutral', -0.2000, 0.1999), (3, 'Negative', -1.0000, -0.2001)) b(id, name, low, high)"
)
fragment(
    "src_dim_delivery_partner",
    "SELECT delivery_partner_id, partner_name, city, vehicle_type, employment_type, is_active, onboard_date, avg_rating, "
    f"b.id AS rating_type_id, b.name AS rating_type, batch_id FROM next_delivery_partner LEFT JOIN {RATING_BANDS} "
    "ON avg_rating BETWEEN b.low AND b.high",
)
_SHOW = {
    "signup_date": txt, "onboard_date": txt, "last_active": txt, "valid_from": txt, "valid_to": txt,
    "avg_rating": dbl,
}


def _scd2_sql(name: str) -> str:
    """The load as separate steps: new ids, closed and opened versions, corrections, overwrites, the rest."""
    spec = scd2.DIMENSIONS[name]
    i, start = spec.business_id, spec.start_column
    pair = f"src_{name} s JOIN {name} t ON t.{i} = s.{i} AND t.is_current"
    moved = "(" + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in spec.versioned) + ")"
    edited = "(" + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in spec.overwritten) + ")"
    eff = f"DATE '{EFFECTIVE}'"
    attrs = lambda a: ", ".join(f"{a}.{c}" for c in spec.attributes)
    tail = "t.last_active, t.life_cycle_id, t.valid_from"
    columns = ", ".join(
        [i, *spec.attributes, "last_active", "life_cycle_id", "valid_from", "valid_to", "is_current", "batch_id", "scd_action"]
    )
    parts = [
        f"SELECT s.{i}, {attrs('s')}, s.{start}, 0, COALESCE(s.{start}, DATE '1900-01-01'), DATE '9999-12-31', true, s.batch_id, 'INSERT' "
        f"FROM src_{name} s WHERE NOT EXISTS (SELECT 1 FROM {name} t WHERE t.{i} = s.{i})",
        f"SELECT t.{i}, {attrs('t')}, {tail}, {eff} - 1, false, t.batch_id, 'CLOSED' FROM {pair} WHERE {moved} AND t.valid_from < {eff}",
        f"SELECT s.{i}, {attrs('s')}, COALESCE(t.last_active, s.{start}), COALESCE(t.life_cycle_id, 0), {eff}, DATE '9999-12-31', true, s.batch_id, 'VERSION' "
        f"FROM {pair} WHERE {moved} AND t.valid_from < {eff}",
        f"SELECT t.{i}, {attrs('s')}, {tail}, t.valid_to, true, s.batch_id, 'CORRECTION' FROM {pair} WHERE {moved} AND t.valid_from >= {eff}",
        f"SELECT t.{i}, {attrs('s')}, {tail}, t.valid_to, true, s.batch_id, 'TYPE1' FROM {pair} WHERE NOT {moved} AND {edited}",
        f"SELECT t.{i}, {attrs('t')}, {tail}, t.valid_to, true, t.batch_id, 'SAME' FROM {pair} WHERE NOT {moved} AND NOT {edited}",
        f"SELECT t.{i}, {attrs('t')}, {tail}, t.valid_to, true, t.batch_id, 'SAME' FROM {name} t WHERE t.is_current AND NOT EXISTS (SELECT 1 FROM src_{name} s WHERE t.{i} = s.{i})",
        f"SELECT t.{i}, {attrs('t')}, {tail}, t.valid_to, false, t.batch_id, 'HISTORY' FROM {name} t WHERE NOT t.is_current",
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) v({columns})"


def _dim_shown(name: str) -> str:
    spec = scd2.DIMENSIONS[name]
    columns = [spec.business_id, *spec.attributes, "last_active", "life_cycle_id", "valid_from", "valid_to", "is_current", "batch_id", "scd_action"]
    return ", ".join(_SHOW[c](c) if c in _SHOW else c for c in columns)


def source_of(src: Source, name: str) -> DataFrame:
    entity, build = dimensions.SOURCES[name]
    return build(src(f"next_{entity}"))


def loaded(src: Source, name: str) -> DataFrame:
    spec = scd2.DIMENSIONS[name]
    return scd2.apply_scd2(spec, src(name), source_of(src, name), day(EFFECTIVE))


def _register_dimensions() -> None:
    for number, name in ((5, "dim_customer"), (6, "dim_restaurant"), (7, "dim_delivery_partner")):
        fragment(f"loaded_{name}", _scd2_sql(name))
        query(f"k{number}_{name}", f"SELECT {_dim_shown(name)} FROM loaded_{name}")(
            lambda src, n=name: loaded(src, n).drop(scd2.DIMENSIONS[n].key)
        )


_register_dimensions()
# The deliveries of the next month, as the effective date of the batch is the first order of that month.
fragment("first_order_1997", "SELECT min(CAST(order_timestamp AS DATE)) AS d FROM ods_order WHERE batch_id = 199701")


fragment(
    "priced_menu",
    "SELECT m.menu_item_id, COALESCE(r.restaurant_key, -1) AS restaurant_key, m.item_name, m.category, m.is_veg, m.price, m.batch_id "
    "FROM next_menu_item m LEFT JOIN dim_restaurant r ON r.restaurant_id = m.restaurant_id AND r.is_current",
)


@query(
    "k8_dim_menu_item",
    "SELECT n.menu_item_id, n.restaurant_key, n.item_name, n.category, n.is_veg, CAST(n.price AS DOUBLE) AS price, n.batch_id, 'INSERT' AS merge_action "
    "FROM priced_menu n WHERE NOT EXISTS (SELECT 1 FROM dim_menu_item t WHERE t.menu_item_id = n.menu_item_id) "
    "UNION ALL SELECT n.menu_item_id, CASE WHEN x THEN n.restaurant_key ELSE t.restaurant_key END, CASE WHEN x THEN n.item_name ELSE t.item_name END, "
    "CASE WHEN x THEN n.category ELSE t.category END, CASE WHEN x THEN n.is_veg ELSE t.is_veg END, CAST(CASE WHEN x THEN n.price ELSE t.price END AS DOUBLE), "
    "CASE WHEN x THEN n.batch_id ELSE t.batch_id END, CASE WHEN x THEN 'UPDATE' ELSE 'UNCHANGED' END "
    "FROM (SELECT n.menu_item_id AS id, (t.restaurant_key IS DISTINCT FROM n.restaurant_key OR t.item_name IS DISTINCT FROM n.item_name OR t.category IS DISTINCT FROM n.category "
    "OR t.is_veg IS DISTINCT FROM n.is_veg OR t.price IS DISTINCT FROM n.price) AS x FROM priced_menu n JOIN dim_menu_item t ON t.menu_item_id = n.menu_item_id) d "
    "JOIN priced_menu n ON n.menu_item_id = d.id JOIN dim_menu_item t ON t.menu_item_id = d.id",
)
def dim_menu_item(src: Source) -> DataFrame:
    return dimensions.load_menu_items(src("dim_menu_item"), src("next_menu_item"), src("dim_restaurant")).drop(
        "menu_item_key"
    )


@query(
    "k9_scd2_actions",
    " UNION ALL ".join(f"SELECT '{n}' AS dimension_name, scd_action, count(*) AS versions FROM loaded_{n} GROUP BY scd_action" for n in DIMS),
)
def scd2_actions(src: Source) -> DataFrame:
    out = None
    for name in DIMS:
        part = loaded(src, name).groupBy("scd_action").agg(F.count(F.lit(1)).alias("versions")).select(
            F.lit(name).alias("dimension_name"), "*"
        )
        out = part if out is None else out.unionByName(part)
    return out


def _log_sql(name: str) -> str:
    spec = scd2.DIMENSIONS[name]

    def value(a: str, c: str) -> str:
        return f"CAST(CAST({a}.{c} AS INTEGER) AS VARCHAR)" if c == "is_active" else f"CAST({a}.{c} AS VARCHAR)"

    return " UNION ALL ".join(
        f"SELECT s.batch_id, '{name}' AS dimension_name, s.{spec.business_id} AS business_id, t.{spec.key} AS surrogate_key_old, "
        f"CASE WHEN t.valid_from >= DATE '{EFFECTIVE}' THEN t.{spec.key} END AS surrogate_key_new, "
        f"CASE WHEN t.valid_from >= DATE '{EFFECTIVE}' THEN 'SCD2_SAME_DAY_CORRECTION' ELSE 'SCD2_VERSION' END AS change_type, "
        f"'{c}' AS column_name, {value('t', c)} AS old_value, {value('s', c)} AS new_value, '{EFFECTIVE}' AS effective_date "
        f"FROM src_{name} s JOIN {name} t ON t.{spec.business_id} = s.{spec.business_id} AND t.is_current WHERE t.{c} IS DISTINCT FROM s.{c}"
        for c in spec.versioned
    )


@query("k10_change_log", " UNION ALL ".join(_log_sql(n) for n in DIMS))
def change_log(src: Source) -> DataFrame:
    """Logged changes of the three dimensions, before the new versions have their keys."""
    out = None
    for name in DIMS:
        part = scd2.change_log(scd2.DIMENSIONS[name], src(name), source_of(src, name), day(EFFECTIVE)).drop("logged_at")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "k10_change_log_keys",
    "SELECT dimension_name, change_type, count(*) AS changes, count(*) AS with_new_key, "
    "CAST(sum(CASE WHEN change_type = 'SCD2_SAME_DAY_CORRECTION' THEN 1 ELSE 0 END) AS BIGINT) AS key_kept FROM ("
    + " UNION ALL ".join(_log_sql(n) for n in DIMS) + ") GROUP BY dimension_name, change_type",
)
def change_log_keys(src: Source) -> DataFrame:
    """After numbering: every change has a new key, and only corrections kept the old one."""
    out = None
    for name in DIMS:
        spec, dim, source = scd2.DIMENSIONS[name], src(name), source_of(src, name)
        keyed = scd2.with_keys(spec, scd2.apply_scd2(spec, dim, source, day(EFFECTIVE)), dim)
        part = scd2.change_log(spec, dim, source, day(EFFECTIVE), keyed=keyed)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("dimension_name", "change_type").agg(
        F.count(F.lit(1)).alias("changes"), F.count("surrogate_key_new").alias("with_new_key"),
        F.count_if(F.col("surrogate_key_new") == F.col("surrogate_key_old")).alias("key_kept"),
    )


# Order facts ----------------------------------------------------------------------------------------------

def _lag_sql(table: str, column: str) -> str:
    return (
        f"SELECT {column}, order_date, lag(order_date) OVER (PARTITION BY {column} ORDER BY order_date) AS previous_date FROM "
        f"(SELECT DISTINCT {column}, CAST(order_timestamp AS DATE) AS order_date FROM {table} WHERE {column} IS NOT NULL) x"
    )


def _cycle(lag: str, dim: str, gap: int) -> str:
    earlier = f"COALESCE({lag}.previous_date, CASE WHEN COALESCE({dim}.life_cycle_id, 0) <> 0 THEN {dim}.last_active END)"
    days = f"date_diff('day', {earlier}, CAST(o.order_timestamp AS DATE))"
    return f"CAST(CASE WHEN {earlier} IS NULL THEN 1 WHEN {days} <= {gap} THEN 2 WHEN {days} > {gap} THEN 3 ELSE 0 END AS INTEGER)"


def _date_key(stamp: str) -> str:
    return (
        f"CASE WHEN CAST({stamp} AS DATE) BETWEEN DATE '{CALENDAR_START}' AND DATE '{CALENDAR_END}' "
        f"THEN CAST(strftime({stamp}, '%Y%m%d') AS INTEGER) ELSE -1 END"
    )


def _fact_order_sql(table: str) -> str:
    def pit(alias: str, dim: str, column: str) -> str:
        return (
            f"LEFT JOIN {dim} {alias} ON o.{column} = {alias}.{column} AND CAST(o.order_timestamp AS DATE) "
            f"BETWEEN {alias}.valid_from AND {alias}.valid_to "
            f"LEFT JOIN ({_lag_sql(table, column)}) l{alias} ON o.{column} = l{alias}.{column} AND CAST(o.order_timestamp AS DATE) = l{alias}.order_date "
        )

    return (
        f"SELECT o.order_id, {_date_key('o.order_timestamp')} AS order_date_key, "
        "CAST(hour(o.order_timestamp) * 100 + minute(o.order_timestamp) AS INTEGER) AS order_time_key, "
        "COALESCE(c.customer_key, -1) AS customer_key, COALESCE(r.restaurant_key, -1) AS restaurant_key, "
        "COALESCE(p.delivery_partner_key, -1) AS delivery_partner_key, o.subtotal_amount, o.discount_amount, o.delivery_fee, o.total_amount, "
        "CAST(COALESCE(o.subtotal_amount, 0) - COALESCE(o.discount_amount, 0) AS DECIMAL(18,2)) AS net_order_value, o.is_cod, o.is_cancelled, "
        f"{_cycle('lc', 'c', 60)} AS cust_lc_id, {_cycle('lr', 'r', 60)} AS rest_lc_id, "
        f"CASE WHEN o.delivery_partner_id IS NOT NULL THEN {_cycle('lp', 'p', 30)} END AS driver_lc_id, o.batch_id "
        f"FROM {table} o " + pit("c", "dim_customer", "customer_id") + pit("r", "dim_restaurant", "restaurant_id")
        + pit("p", "dim_delivery_partner", "delivery_partner_id")
    )


MONEY = ("subtotal_amount", "discount_amount", "delivery_fee", "total_amount", "net_order_value")
for _name, _table in (("fact_order_all", "ods_order"), ("fact_order_before", "before_order"), ("fact_order_next", "next_order")):
    fragment(_name, _fact_order_sql(_table))


def orders_fact(src: Source, table: str = "ods_order") -> DataFrame:
    return src.once(
        ("fact_order", table),
        lambda: facts.build_fact_order(src(table), cal(src), *(src(n) for n in DIMS)),
    )


def stored_orders(src: Source, table: str) -> DataFrame:
    """The keys of the order facts, worked out once and stored; whatever the query builds from these facts reads them."""
    keys = ("order_id", "order_date_key", "order_time_key", "customer_key", "restaurant_key", "delivery_partner_key")
    return src.once(
        ("fact_order", table),
        lambda: src.stored(
            f"fact_{table}", lambda: facts.build_fact_order(src(table), cal(src), *(src(n) for n in DIMS)).select(*keys)
        ),
    )


ORDER_COLUMNS = (
    "order_id, order_date_key, order_time_key, customer_key, restaurant_key, delivery_partner_key, "
    + dbl(*MONEY) + ", is_cod, is_cancelled, cust_lc_id, rest_lc_id, driver_lc_id, batch_id"
)


@query("f1_fact_order", f"SELECT {ORDER_COLUMNS} FROM fact_order_all")
def fact_order(src: Source) -> DataFrame:
    return orders_fact(src)


@query(
    "f1_point_in_time_misses",
    "SELECT batch_id, count(*) AS orders, CAST(sum(CASE WHEN customer_key = -1 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_customers, "
    "CAST(sum(CASE WHEN restaurant_key = -1 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_restaurants, "
    "CAST(sum(CASE WHEN delivery_partner_key = -1 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_partners, "
    "CAST(sum(CASE WHEN order_date_key = -1 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_days FROM fact_order_all GROUP BY batch_id",
)
def point_in_time_misses(src: Source) -> DataFrame:
    """Orders whose day finds no version or calendar day, per batch."""
    return orders_fact(src).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("customer_key") == -1).alias("unknown_customers"),
        F.count_if(F.col("restaurant_key") == -1).alias("unknown_restaurants"),
        F.count_if(F.col("delivery_partner_key") == -1).alias("unknown_partners"),
        F.count_if(F.col("order_date_key") == -1).alias("unknown_days"),
    )


@query(
    "f2_previous_active_date",
    " UNION ALL ".join(
        f"SELECT '{e}' AS entity, {e}_id AS entity_id, CAST(order_date AS VARCHAR) AS order_date, CAST(previous_date AS VARCHAR) AS previous_date "
        f"FROM ({_lag_sql('ods_order', e + '_id')})"
        for e in ("customer", "restaurant", "delivery_partner")
    ),
)
def previous_active_date(src: Source) -> DataFrame:
    orders = src("ods_order").withColumn("order_date", F.to_date("order_timestamp"))
    out = None
    for entity in ("customer", "restaurant", "delivery_partner"):
        part = facts.previous_active_date(orders, f"{entity}_id").select(
            F.lit(entity).alias("entity"), F.col(f"{entity}_id").alias("entity_id"), "order_date", "previous_date"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "f3_lifecycle_summary",
    "WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS prev "
    "FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)), "
    "c AS (SELECT o.o_totalprice, o.o_custkey, CAST(CASE WHEN d.prev IS NULL THEN 1 WHEN date_diff('day', d.prev, d.day) <= 60 THEN 2 ELSE 3 END AS INTEGER) AS life_cycle_id "
    "FROM orders o JOIN customer ON c_custkey = o_custkey JOIN d ON d.o_custkey = o.o_custkey AND d.day = CAST(o.o_orderdate AS DATE)) "
    "SELECT life_cycle_id, CASE life_cycle_id WHEN 1 THEN 'New' WHEN 2 THEN 'Retained' ELSE 'Reactivated' END AS life_cycle, "
    "count(*) AS orders, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM c GROUP BY life_cycle_id",
)
def lifecycle_summary(src: Source) -> DataFrame:
    """Orders, customers and revenue of new, retained and reactivated customers."""
    known = src.table("customer").select(F.col("c_custkey").alias("customer_id"))
    orders = src.table("orders").select(
        F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
    ).join(known, "customer_id", "left_semi")
    # Orders of one customer and day share their previous day: reduce to that grain once, and go on from there.
    daily = orders.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue")
    )
    previous = facts.previous_active_date(daily, "customer_id")
    cycle = facts.life_cycle(F.col("previous_date"), F.col("order_date"), facts.LIFE_CYCLE_GAP["customer"])
    staged = daily.join(previous, ["customer_id", "order_date"]).withColumn("life_cycle_id", cycle)
    names = {i: n for i, n, _ in lookups.LIFE_CYCLES}
    name = F.when(F.col("life_cycle_id") == 1, names[1]).when(F.col("life_cycle_id") == 2, names[2]).otherwise(names[3])
    return staged.groupBy("life_cycle_id").agg(
        F.sum("orders").alias("orders"), F.count_distinct("customer_id").alias("customers"),
        F.sum("revenue").cast("double").alias("revenue"),
    ).select("life_cycle_id", name.alias("life_cycle"), "orders", "customers", "revenue")


@query(
    "f3_order_life_cycles",
    "SELECT batch_id, cust_lc_id, rest_lc_id, driver_lc_id, count(*) AS orders FROM fact_order_all GROUP BY ALL",
)
def order_life_cycles(src: Source) -> DataFrame:
    return orders_fact(src).groupBy("batch_id", "cust_lc_id", "rest_lc_id", "driver_lc_id").agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "f4_net_order_value",
    "SELECT batch_id, CAST(sum(CAST(COALESCE(subtotal_amount, 0) - COALESCE(discount_amount, 0) AS DECIMAL(18,2))) AS DOUBLE) AS net_order_value, count(*) AS orders FROM ods_order GROUP BY batch_id",
)
def net_order_value(src: Source) -> DataFrame:
    return src("ods_order").select("batch_id", facts.net_order_value().alias("net")).groupBy("batch_id").agg(
        F.sum("net").cast("double").alias("net_order_value"), F.count(F.lit(1)).alias("orders")
    )


def _fact_upsert_sql(key: str, target: str, source: str, columns: list[str], money: tuple[str, ...]) -> str:
    tracked = [c for c in columns if c not in (key, "batch_id")]
    same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in tracked)

    def pick(a: str) -> str:
        return ", ".join(dbl(f"{a}.{c}") if c in money else f"{a}.{c}" for c in columns)

    return (
        f"SELECT {pick('s')}, 'INSERT' AS merge_action FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = s.{key}) "
        f"UNION ALL SELECT {pick('s')}, 'UPDATE' FROM {source} s JOIN {target} t ON t.{key} = s.{key} WHERE NOT ({same}) "
        f"UNION ALL SELECT {pick('t')}, 'UNCHANGED' FROM {source} s JOIN {target} t ON t.{key} = s.{key} WHERE {same} "
        f"UNION ALL SELECT {pick('t')}, 'KEEP' FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE t.{key} = s.{key})"
    )


ORDER_FACT = [
    "order_id", "order_date_key", "order_time_key", "customer_key", "restaurant_key", "delivery_partner_key", *MONEY,
    "is_cod", "is_cancelled", "cust_lc_id", "rest_lc_id", "driver_lc_id", "batch_id",
]


@query("f5_upsert_fact_order", _fact_upsert_sql("order_id", "fact_order_before", "fact_order_next", ORDER_FACT, MONEY))
def upsert_fact_order(src: Source) -> DataFrame:
    return facts.upsert_fact("fact_order", orders_fact(src, "before_order"), orders_fact(src, "next_order"))


# Lines, deliveries, ratings -------------------------------------------------------------------------------

fragment(
    "ods_order_item",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY source_row_number DESC, "
    "source_file_name DESC) AS rn FROM lines) WHERE rn = 1",
)


def items(src: Source) -> DataFrame:
    return clean.keep_latest(src("lines"), ["order_item_id"])


def _item_sql(parent: str) -> str:
    return (
        "SELECT i.order_item_id, i.order_id, COALESCE(o.order_date_key, -1) AS order_date_key, COALESCE(o.customer_key, -1) AS customer_key, "
        "COALESCE(o.restaurant_key, -1) AS restaurant_key, COALESCE(m.menu_item_key, -1) AS menu_item_key, i.quantity, i.unit_price, "
        "CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS gross_line_total, i.item_discount, "
        "CAST(i.quantity * i.unit_price - i.item_discount AS DECIMAL(18,2)) AS net_line_total, i.batch_id "
        f"FROM ods_order_item i LEFT JOIN {parent} o ON i.order_id = o.order_id LEFT JOIN dim_menu_item m ON m.menu_item_id = i.menu_item_id"
    )


fragment("fact_item_all", _item_sql("fact_order_all"))
fragment("fact_item_before", _item_sql("fact_order_before"))
ITEM_COLUMNS = (
    "order_item_id, order_id, order_date_key, customer_key, restaurant_key, menu_item_key, quantity, "
    + dbl("unit_price", "gross_line_total", "item_discount", "net_line_total") + ", batch_id"
)


def items_fact(src: Source, table: str = "ods_order") -> DataFrame:
    return facts.build_fact_order_item(items(src), orders_fact(src, table), src("dim_menu_item"))


@query("f6_fact_order_item", f"SELECT {ITEM_COLUMNS} FROM fact_item_all")
def fact_order_item(src: Source) -> DataFrame:
    return items_fact(src)


def _bin(value: str, edges, labels) -> str:
    return "CASE " + " ".join(f"WHEN {value} <= {e} THEN '{n}'" for e, n in zip(edges, labels)) + f" WHEN {value} > {edges[-1]} THEN '{labels[-1]}' END"


def _delivery_sql(deliveries: str, parent: str) -> str:
    delay, over = "(d.actual_delivery_time_min - d.expected_delivery_time_min)", "(d.prep_time - r.max_prep_min)"
    late = "d.actual_delivery_time_min > d.expected_delivery_time_min"
    full, on_time = "d.delivery_item >= d.order_item", "d.actual_delivery_time_min <= d.expected_delivery_time_min"
    return (
        "SELECT d.delivery_id, d.order_id, COALESCE(o.order_date_key, -1) AS delivery_date_key, COALESCE(o.customer_key, -1) AS customer_key, "
        "COALESCE(o.restaurant_key, -1) AS restaurant_key, COALESCE(o.delivery_partner_key, -1) AS delivery_partner_key, "
        "d.order_item, d.delivery_item, d.prep_time, d.rider_wait_time, d.travel_time, d.expected_delivery_time_min, d.actual_delivery_time_min, d.distance_km, "
        f"CASE WHEN {full} THEN true ELSE false END AS is_infull, {delay} AS delivery_delay_min, CASE WHEN {on_time} THEN true ELSE false END AS is_ontime, "
        f"CASE WHEN {late} THEN {delay} END AS late_time, CASE WHEN d.prep_time > r.max_prep_min THEN {over} END AS prep_late_time, "
        f"CASE WHEN {late} AND {over} > 0 AND {over} >= {delay} THEN 'Prep-Time' WHEN {late} AND {over} > 0 AND {over} < {delay} THEN 'Both' "
        f"WHEN {late} AND (d.prep_time <= r.max_prep_min OR r.max_prep_min IS NULL) THEN 'Travel-Time' END AS late_reason, "
        f"CASE WHEN {full} AND {on_time} THEN true ELSE false END AS is_otif, "
        f"{_bin('d.distance_km', (3, 5), ('0 - 3 km', '3 - 5 km', '5+ km'))} AS distance_bins, "
        f"{_bin('d.travel_time', (15, 30, 45), ('0 - 15 mins', '15 - 30 mins', '30 - 45 mins', '45+ mins'))} AS travel_bins, "
        f"{_bin('d.prep_time', (15, 30, 45, 60), ('0 - 15 mins', '15 - 30 mins', '30 - 45 mins', '45 - 60 mins', '60+ mins'))} AS prep_time_bins, "
        f"{_bin('d.actual_delivery_time_min', (30, 45, 55, 65), ('0 - 30 mins', '30 - 45 mins', '45 - 55 mins', '55 - 65 mins', '65+ mins'))} AS actual_bins, d.batch_id "
        f"FROM {deliveries} d LEFT JOIN {parent} o ON o.order_id = d.order_id LEFT JOIN dim_restaurant r ON r.restaurant_key = o.restaurant_key"
    )


fragment("fact_delivery_all", _delivery_sql("ods_delivery_performance", "fact_order_all"))
fragment("fact_delivery_before", _delivery_sql("before_delivery_performance", "fact_order_before"))
fragment("fact_delivery_next", _delivery_sql("next_delivery_performance", "fact_order_all"))
fragment("fact_delivery_orphan", _delivery_sql("ods_delivery_performance", "fact_order_before"))
DELIVERY_FACT = [
    "delivery_id", "order_id", "delivery_date_key", "customer_key", "restaurant_key", "delivery_partner_key", "order_item", "delivery_item",
    "prep_time", "rider_wait_time", "travel_time", "expected_delivery_time_min", "actual_delivery_time_min", "distance_km", "is_infull",
    "delivery_delay_min", "is_ontime", "late_time", "prep_late_time", "late_reason", "is_otif", "distance_bins", "travel_bins",
    "prep_time_bins", "actual_bins", "batch_id",
]


def deliveries_fact(src: Source, deliveries: str = "ods_delivery_performance", orders: str = "ods_order") -> DataFrame:
    return facts.build_fact_delivery(src(deliveries), orders_fact(src, orders), src("dim_restaurant"))


@query("f7_fact_delivery_performance", "SELECT * REPLACE (CAST(distance_km AS DOUBLE) AS distance_km) FROM fact_delivery_all")
def fact_delivery(src: Source) -> DataFrame:
    return deliveries_fact(src)


@query(
    "f8_late_reasons",
    "SELECT late_reason, is_otif, count(*) AS deliveries, CAST(sum(late_time) AS BIGINT) AS late_minutes, CAST(sum(prep_late_time) AS BIGINT) AS prep_late_minutes FROM fact_delivery_all GROUP BY ALL",
)
def late_reasons(src: Source) -> DataFrame:
    return deliveries_fact(src).groupBy("late_reason", "is_otif").agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum("late_time").alias("late_minutes"),
        F.sum("prep_late_time").alias("prep_late_minutes"),
    )


@query(
    "f9_bins",
    "SELECT distance_bins, travel_bins, prep_time_bins, actual_bins, count(*) AS deliveries FROM fact_delivery_all GROUP BY ALL",
)
def delivery_bins(src: Source) -> DataFrame:
    """The bins need no keys, so they come straight from the deliveries."""
    kpis = facts.delivery_kpis(F.lit(None).cast("int"))
    names = ("distance_bins", "travel_bins", "prep_time_bins", "actual_bins")
    return src("ods_delivery_performance").select(*[kpis[n].alias(n) for n in names]).groupBy(*names).agg(
        F.count(F.lit(1)).alias("deliveries")
    )


@query(
    "f10_upsert_fact_delivery",
    _fact_upsert_sql("delivery_id", "fact_delivery_before", "fact_delivery_next", DELIVERY_FACT, ("distance_km",)),
)
def upsert_fact_delivery(src: Source) -> DataFrame:
    return facts.upsert_fact(
        "fact_delivery_performance", deliveries_fact(src, "before_delivery_performance", "before_order"),
        deliveries_fact(src, "next_delivery_performance"),
    )


RATING_START, RATING_END = "2024-01-01", "2024-01-25"


def rating_calendar(src: Source) -> DataFrame:
    return calendar.dim_date(src.spark, RATING_START, RATING_END)


def _rating_sql(parent: str) -> str:
    day_ = "CAST(r.review_timestamp AS DATE)"
    return (
        f"SELECT r.rating_id, r.order_id, CASE WHEN {day_} BETWEEN DATE '{RATING_START}' AND DATE '{RATING_END}' THEN CAST(strftime(r.review_timestamp, '%Y%m%d') AS INTEGER) ELSE -1 END AS rating_date_key, "
        "CAST(hour(r.review_timestamp) * 100 + minute(r.review_timestamp) AS INTEGER) AS rating_time_key, "
        "COALESCE(o.customer_key, c.customer_key, -1) AS customer_key, COALESCE(o.restaurant_key, s.restaurant_key, -1) AS restaurant_key, "
        "COALESCE(o.delivery_partner_key, -1) AS delivery_partner_key, r.rating, COALESCE(rt.id, 0) AS rating_type_id, r.sentiment_score, "
        "COALESCE(st.id, 0) AS sentiment_type_id, r.review_text, r.batch_id "
        f"FROM ods_rating r LEFT JOIN {parent} o ON o.order_id = r.order_id "
        f"LEFT JOIN dim_customer c ON c.customer_id = r.customer_id AND {day_} BETWEEN c.valid_from AND c.valid_to "
        f"LEFT JOIN dim_restaurant s ON s.restaurant_id = r.restaurant_id AND {day_} BETWEEN s.valid_from AND s.valid_to "
        f"LEFT JOIN {RATING_BANDS.replace(' b(', ' rt(')} ON r.rating BETWEEN rt.low AND rt.high "
        f"LEFT JOIN {SENTIMENT_BANDS.replace(' b(', ' st(')} ON r.sentiment_score BETWEEN st.low AND st.high"
    )


fragment("fact_rating_all", _rating_sql("fact_order_all"))
fragment("fact_rating_before", _rating_sql("fact_order_before"))
RATING_COLUMNS = (
    "rating_id, order_id, rating_date_key, rating_time_key, customer_key, restaurant_key, delivery_partner_key, "
    + dbl("rating") + ", rating_type_id, " + dbl("sentiment_score") + ", sentiment_type_id, review_text, batch_id"
)


def ratings_fact(src: Source, orders: str = "ods_order") -> DataFrame:
    return facts.build_fact_rating(
        src("ods_rating"), orders_fact(src, orders), rating_calendar(src), src("dim_customer"), src("dim_restaurant")
    )


@query("f11_fact_rating", f"SELECT {RATING_COLUMNS} FROM fact_rating_all")
def fact_rating(src: Source) -> DataFrame:
    return ratings_fact(src)


@query(
    "k4_lookup_usage",
    "SELECT 'rating_type' AS lookup, b.id, b.name, (SELECT count(*) FROM ods_rating r WHERE r.rating BETWEEN b.low AND b.high) AS used FROM "
    + RATING_BANDS
    + " UNION ALL SELECT 'sentiment_type', b.id, b.name, (SELECT count(*) FROM ods_rating r WHERE r.sentiment_score BETWEEN b.low AND b.high) FROM "
    + SENTIMENT_BANDS
    + " UNION ALL SELECT 'life_cycle', l.id, l.name, (SELECT count(*) FROM dim_customer c WHERE c.life_cycle_id = l.id) FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n, _ in lookups.LIFE_CYCLES) + ") l(id, name) "
    "UNION ALL SELECT 'aspect', a.id, a.name, (SELECT count(*) FROM labels c WHERE c.quality = a.id) FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n, _ in lookups.ASPECTS) + ") a(id, name)",
)
def lookup_usage(src: Source) -> DataFrame:
    """The seeded lookups with the rows that use each entry."""
    ratings, spark = src("ods_rating"), src.spark
    used = {
        "rating_type": ratings.select(facts.B.band(F.col("rating"), lookups.RATING_TYPES).alias("id")),
        "sentiment_type": ratings.select(facts.B.band(F.col("sentiment_score"), lookups.SENTIMENT_TYPES).alias("id")),
        "life_cycle": src("dim_customer").select(F.col("life_cycle_id").alias("id")),
        "aspect": src.table("labels").select(F.col("quality").alias("id")),
    }
    seeds = {
        "rating_type": lookups.rating_types(spark).filter("rating_type_id <> 0").select(
            F.col("rating_type_id").alias("id"), F.col("rating_type").alias("name")
        ),
        "sentiment_type": lookups.sentiment_types(spark).filter("sentiment_type_id <> 0").select(
            F.col("sentiment_type_id").alias("id"), F.col("sentiment_type").alias("name")
        ),
        "life_cycle": lookups.life_cycles(spark).select(F.col("lc_id").alias("id"), F.col("life_cycle").alias("name")),
        "aspect": lookups.seed_aspects(spark, None).select(F.col("aspect_id").alias("id"), F.col("aspect_name").alias("name")),
    }
    out = None
    for name, seed in seeds.items():
        counts = used[name].groupBy("id").agg(F.count(F.lit(1)).alias("used"))
        part = seed.join(counts, "id", "left").select(
            F.lit(name).alias("lookup"), "id", "name", F.coalesce("used", F.lit(0)).alias("used")
        )
        out = part if out is None else out.unionByName(part)
    return out


# Enrichment and relinking ---------------------------------------------------------------------------------

ENRICH_BATCH = 199806


def _enrich_sql(name: str) -> str:
    key, cycle, start = dimensions.LIFE_CYCLE_COLUMNS[name]
    spec = scd2.DIMENSIONS[name]
    day_of = "CASE WHEN order_date_key = -1 THEN DATE '1900-01-01' ELSE CAST(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d') AS DATE) END"
    return (
        f"SELECT '{name}' AS dimension_name, d.{spec.business_id} AS business_id, d.is_current, "
        f"CAST(CASE WHEN a.{key} IS NOT NULL AND d.is_current THEN COALESCE(a.last_day, d.{start}) ELSE d.last_active END AS VARCHAR) AS last_active, "
        f"CASE WHEN a.{key} IS NOT NULL AND d.is_current THEN COALESCE(a.cycle, 0) ELSE d.life_cycle_id END AS life_cycle_id, "
        f"CAST(d.valid_from AS VARCHAR) AS valid_from FROM {name} d LEFT JOIN ("
        f"SELECT f.{key}, l.last_day, CAST(max(f.{cycle}) AS INTEGER) AS cycle FROM fact_order_all f JOIN (SELECT {key}, max({day_of}) AS last_day FROM fact_order_all "
        f"WHERE {key} IN (SELECT {key} FROM fact_order_all WHERE batch_id = {ENRICH_BATCH} AND {key} <> -1) GROUP BY {key}) l "
        f"ON f.{key} = l.{key} AND {day_of} = l.last_day GROUP BY f.{key}, l.last_day) a ON a.{key} = d.{key}"
    )


@query("k11_enrich_dimensions", " UNION ALL ".join(_enrich_sql(n) for n in DIMS))
def enrich_dimensions(src: Source) -> DataFrame:
    """Last activity and life cycle of every version after one batch."""
    fact = orders_fact(src)
    out = None
    for name in DIMS:
        spec = scd2.DIMENSIONS[name]
        part = dimensions.enrich(name, src(name), fact, ENRICH_BATCH).select(
            F.lit(name).alias("dimension_name"), F.col(spec.business_id).alias("business_id"), "is_current",
            "last_active", "life_cycle_id", "valid_from",
        )
        out = part if out is None else out.unionByName(part)
    return out


# Columns of a fact that are filled from its order, and the order's columns.
RELINKED = {
    "fact_order_item": {"order_date_key": "order_date_key", "customer_key": "customer_key", "restaurant_key": "restaurant_key"},
    "fact_delivery_performance": {
        "delivery_date_key": "order_date_key", "customer_key": "customer_key", "restaurant_key": "restaurant_key",
        "delivery_partner_key": "delivery_partner_key",
    },
    "fact_rating": {"delivery_partner_key": "delivery_partner_key", "customer_key": "customer_key", "restaurant_key": "restaurant_key"},
}


def _relink_sql(name: str, facts_table: str) -> str:
    pairs = RELINKED[name]
    key = facts.FACT_KEYS[name]
    fixed = " OR ".join(f"(f.{c} = -1 AND COALESCE(o.{p}, -1) <> -1)" for c, p in pairs.items())
    return (
        f"SELECT f.{key}, f.order_id, "
        + ", ".join(f"CASE WHEN ({fixed}) AND f.{c} = -1 THEN o.{p} ELSE f.{c} END AS {c}" for c, p in pairs.items())
        + f", CASE WHEN {fixed} THEN true ELSE false END AS relinked FROM {facts_table} f LEFT JOIN fact_order_all o ON o.order_id = f.order_id"
    )


ORPHANED = {
    "fact_order_item": ("fact_item_before", items_fact),
    "fact_delivery_performance": (
        "fact_delivery_orphan", lambda src, t: deliveries_fact(src, "ods_delivery_performance", t),
    ),
    "fact_rating": ("fact_rating_before", ratings_fact),
}


def orphaned(src: Source, name: str, build) -> DataFrame:
    """The stored facts before their late orders came: what a relink looks at and fills."""
    stored_orders(src, "before_order")
    return src.stored(name, lambda: build(src, "before_order").select(facts.FACT_KEYS[name], "order_id", *facts.RELINK[name]))


def _register_relink() -> None:
    for name, (table, build) in ORPHANED.items():
        fragment(f"relinked_{name}", _relink_sql(name, table))

        def run(src: Source, n=name, b=build) -> DataFrame:
            linked = facts.relink(n, orphaned(src, n, b), stored_orders(src, "ods_order"))
            return linked.select(facts.FACT_KEYS[n], "order_id", *facts.RELINK[n], "relinked")

        query(f"f16_relink_{name}", f"SELECT * FROM relinked_{name}")(run)


_register_relink()


@query(
    "f16_relink_preview",
    " UNION ALL ".join(
        f"SELECT '{n}' AS fact_name, CAST(sum(CASE WHEN relinked THEN 1 ELSE 0 END) AS BIGINT) AS rows_to_relink FROM relinked_{n}" for n in ORPHANED
    ),
)
def relink_preview(src: Source) -> DataFrame:
    out = None
    for name, (_, build) in ORPHANED.items():
        part = facts.relink_preview(name, orphaned(src, name, build), stored_orders(src, "ods_order"))
        out = part if out is None else out.unionByName(part)
    return out


# Review aspects: documents are reviews, labelled documents are what the cache knows ------------------------

fragment("doc_reviews", "SELECT doc_id AS rating_key, CAST(1 AS BIGINT) AS batch_id, text AS review_text FROM documents")
fragment(
    "doc_cache",
    "SELECT sha256(lower(trim(d.text))) AS review_hash, min(trim(d.text)) AS review_text, l.quality AS aspect_id, l.toxic + 1 AS sentiment_type_id, "
    "min(d.source || ' / ' || d.lang) AS matched_phrase, 'labels' AS ai_model FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 3, 4",
)


def doc_reviews(src: Source) -> DataFrame:
    return src.table("documents").select(
        F.col("doc_id").alias("rating_key"), F.lit(1).cast("long").alias("batch_id"), F.col("text").alias("review_text")
    )


def doc_cache(src: Source) -> DataFrame:
    labelled = src.table("documents").join(src.table("labels"), "doc_id")
    return (
        labelled.groupBy(
            reviews.text_hash(F.col("text")).alias("review_hash"), F.col("quality").alias("aspect_id"),
            (F.col("toxic") + 1).alias("sentiment_type_id"),
        )
        .agg(
            F.min(F.trim("text")).alias("review_text"),
            F.min(F.concat("source", F.lit(" / "), "lang")).alias("matched_phrase"),
        )
        .select(
            "review_hash", "review_text", "aspect_id", "sentiment_type_id", "matched_phrase",
            F.lit("labels").alias("ai_model"),
        )
    )


@query(
    "f12_fact_review_aspect",
    "SELECT r.rating_key, c.aspect_id, c.sentiment_type_id, c.matched_phrase, r.batch_id FROM doc_reviews r "
    "JOIN doc_cache c ON c.review_hash = sha256(lower(trim(r.review_text)))",
)
def fact_review_aspect(src: Source) -> DataFrame:
    return reviews.build_fact_review_aspect(doc_reviews(src), doc_cache(src))


@query(
    "f12_upsert_review_aspect",
    "WITH s AS (SELECT r.rating_key, c.aspect_id, c.sentiment_type_id, c.matched_phrase, r.batch_id FROM doc_reviews r "
    "JOIN doc_cache c ON c.review_hash = sha256(lower(trim(r.review_text)))), "
    "t AS (SELECT doc_id AS rating_key, quality AS aspect_id, toxic + 1 AS sentiment_type_id, CASE WHEN toxic = 1 THEN NULL ELSE d.source || ' / ' || d.lang END AS matched_phrase, CAST(0 AS BIGINT) AS batch_id "
    "FROM labels JOIN documents d USING (doc_id)) "
    "SELECT COALESCE(t.rating_key, s.rating_key) AS rating_key, COALESCE(t.aspect_id, s.aspect_id) AS aspect_id, COALESCE(t.sentiment_type_id, s.sentiment_type_id) AS sentiment_type_id, "
    "CASE WHEN s.rating_key IS NULL THEN t.matched_phrase ELSE s.matched_phrase END AS matched_phrase, "
    "CASE WHEN t.rating_key IS NOT NULL AND (s.rating_key IS NULL OR t.matched_phrase IS NOT DISTINCT FROM s.matched_phrase) THEN t.batch_id ELSE s.batch_id END AS batch_id, "
    "CASE WHEN t.rating_key IS NULL THEN 'INSERT' WHEN s.rating_key IS NULL THEN 'KEEP' WHEN t.matched_phrase IS DISTINCT FROM s.matched_phrase THEN 'UPDATE' ELSE 'UNCHANGED' END AS merge_action "
    "FROM t FULL JOIN s ON t.rating_key = s.rating_key AND t.aspect_id = s.aspect_id AND t.sentiment_type_id = s.sentiment_type_id",
)
def upsert_review_aspect(src: Source) -> DataFrame:
    phrase = F.when(F.col("toxic") != 1, F.concat("source", F.lit(" / "), "lang"))
    target = src.table("documents").join(src.table("labels"), "doc_id").select(
        F.col("doc_id").alias("rating_key"), F.col("quality").alias("aspect_id"),
        (F.col("toxic") + 1).alias("sentiment_type_id"), phrase.alias("matched_phrase"),
        F.lit(0).cast("long").alias("batch_id"),
    )
    return reviews.upsert_review_aspect(target, fact_review_aspect(src))


fragment(
    "uncached_docs",
    "SELECT DISTINCT trim(review_text) AS review_text, sha256(lower(trim(review_text))) AS review_hash FROM doc_reviews "
    "WHERE length(trim(review_text)) > 0 AND sha256(lower(trim(review_text))) NOT IN (SELECT review_hash FROM doc_cache)",
)


@query("f13_uncached_reviews", "SELECT review_hash, review_text FROM uncached_docs")
def uncached_reviews(src: Source) -> DataFrame:
    return reviews.uncached_reviews(doc_reviews(src), doc_cache(src))


@query(
    "f14_fallback_aspects",
    "SELECT review_hash, review_text, 0 AS aspect_id, 2 AS sentiment_type_id, substring(review_text, 1, 200) AS matched_phrase, 'offline-fallback' AS ai_model FROM uncached_docs",
)
def fallback_aspects(src: Source) -> DataFrame:
    return reviews.fallback_aspects(uncached_reviews(src))


# A request holds fifteen turns of one conversation; replies repeat a turn, change its case, or quote it.
_REQUEST = "CAST(conv_id AS STRING) || '-' || CAST(CAST(floor(turn / 15) AS INT) AS STRING)"
_REPLY = "CASE WHEN role = 'user' THEN lower(text) WHEN turn % 3 = 0 THEN 'You said: ' || text ELSE text || '' END"


@query(
    "f15_match_responses",
    f"WITH q AS (SELECT DISTINCT {_REQUEST} AS request_batch, text AS request_text, sha256(lower(trim(text))) AS request_hash FROM conversations), "
    f"a AS (SELECT {_REQUEST} AS request_batch, {_REPLY} AS review_text, conv_id, turn FROM conversations) "
    "SELECT a.request_batch, a.review_text, a.conv_id, a.turn, "
    "COALESCE((SELECT min(q.request_hash) FROM q WHERE q.request_batch = a.request_batch AND q.request_hash = sha256(lower(trim(a.review_text)))), "
    "(SELECT arg_min(q.request_hash, q.request_text) FROM q WHERE q.request_batch = a.request_batch AND (contains(lower(a.review_text), lower(q.request_text)) OR contains(lower(q.request_text), lower(a.review_text)))), "
    "sha256(lower(trim(a.review_text)))) AS review_hash, "
    "COALESCE((SELECT min(q.request_text) FROM q WHERE q.request_batch = a.request_batch AND q.request_hash = sha256(lower(trim(a.review_text)))), "
    "(SELECT min(q.request_text) FROM q WHERE q.request_batch = a.request_batch AND (contains(lower(a.review_text), lower(q.request_text)) OR contains(lower(q.request_text), lower(a.review_text)))), "
    "a.review_text) AS matched_text FROM a",
)
def match_responses(src: Source) -> DataFrame:
    turns = src.table("conversations")
    requests = turns.selectExpr(f"{_REQUEST} AS request_batch", "text AS request_text")
    replies = turns.selectExpr(f"{_REQUEST} AS request_batch", f"{_REPLY} AS review_text", "conv_id", "turn")
    return reviews.match_responses(replies, requests)


# Serving views --------------------------------------------------------------------------------------------

def _churn_sql(name: str, rule: views.ChurnRule, columns: str) -> str:
    last = f"COALESCE(last_active, {rule.start_column})"
    idle = f"date_diff('day', {last}, DATE '{AS_OF}')"
    lc = "COALESCE(life_cycle_id, 0)"
    return (
        f"SELECT {columns}, CAST(last_active AS VARCHAR) AS last_active, life_cycle_id, life_cycle_id AS life_cycle, "
        f"CAST(CASE WHEN {rule.key} <> -1 THEN {idle} END AS INTEGER) AS days_since_last_active, {rule.key} <> -1 AND {idle} > {rule.churn} AS is_churned, "
        f"CASE WHEN {rule.key} <> -1 AND {idle} > {rule.churn} THEN CAST({last} + {rule.churn} AS VARCHAR) END AS churned_date, "
        f"CASE WHEN {rule.key} = -1 THEN 0 WHEN {idle} > {rule.churn} THEN 4 ELSE {lc} END AS last_status_id, "
        f"CASE WHEN {rule.key} = -1 THEN 0 WHEN {idle} > {rule.churn} THEN 4 ELSE {lc} END AS last_status, "
        f"CASE WHEN {rule.key} = -1 THEN 'Unknown' WHEN {idle} > {rule.churn} THEN 'Churned' "
        f"WHEN {lc} = 2 AND {idle} > {rule.retained_high} THEN 'High' WHEN {lc} <> 2 AND {idle} > {rule.other_high} THEN 'High' "
        f"WHEN {lc} = 2 AND {idle} BETWEEN {rule.retained_medium} AND {rule.retained_high} THEN 'Medium' "
        f"WHEN {lc} <> 2 AND {idle} BETWEEN {rule.other_medium} AND {rule.other_high} THEN 'Medium' "
        f"WHEN {lc} = 2 AND {idle} < {rule.retained_medium} THEN 'Low' WHEN {lc} <> 2 AND {idle} < {rule.other_medium} THEN 'Low' ELSE 'Undefined' END AS churn_risk "
        f"FROM enriched_{name} WHERE is_current"
    )


def _enriched_sql(name: str) -> str:
    key, cycle, start = dimensions.LIFE_CYCLE_COLUMNS[name]
    day_of = "CASE WHEN order_date_key = -1 THEN DATE '1900-01-01' ELSE CAST(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d') AS DATE) END"
    return (
        f"SELECT d.* EXCLUDE (last_active, life_cycle_id), COALESCE(a.last_day, d.last_active) AS last_active, COALESCE(a.cycle, d.life_cycle_id) AS life_cycle_id FROM {name} d LEFT JOIN ("
        f"SELECT f.{key}, l.last_day, CAST(COALESCE(max(f.{cycle}), 0) AS INTEGER) AS cycle FROM fact_order_all f JOIN (SELECT {key}, max({day_of}) AS last_day FROM fact_order_all "
        f"WHERE {key} <> -1 GROUP BY {key}) l ON f.{key} = l.{key} AND {day_of} = l.last_day GROUP BY f.{key}, l.last_day) a ON a.{key} = d.{key} AND d.is_current"
    )


for _name in DIMS:
    fragment(f"enriched_{_name}", _enriched_sql(_name))


def enriched(src: Source, name: str) -> DataFrame:
    return dimensions.enrich(name, src(name), orders_fact(src))


@query("v1_customer_view", _churn_sql("dim_customer", views.ChurnRule("customer_key", "signup_date", 60, 45, 20, 30, 10), "customer_key, customer_id, city, CAST(signup_date AS VARCHAR) AS signup_date, acquisition_channel"))
def customer_view(src: Source) -> DataFrame:
    return views.customer_view(enriched(src, "dim_customer"), day(AS_OF))


@query(
    "v2_restaurant_view",
    _churn_sql(
        "dim_restaurant", views.ChurnRule("restaurant_key", "onboard_date", 60, 45, 15, 21, 8),
        "restaurant_key, restaurant_id, restaurant_name, city, cuisine_type, partner_type, is_active, CAST(onboard_date AS VARCHAR) AS onboard_date, "
        "avg_prep_time_min, min_prep_min, max_prep_min, prep_time_group, prep_time_index",
    ),
)
def restaurant_view(src: Source) -> DataFrame:
    return views.restaurant_view(enriched(src, "dim_restaurant"), day(AS_OF))


@query(
    "v3_delivery_partner_view",
    _churn_sql(
        "dim_delivery_partner", views.ChurnRule("delivery_partner_key", "onboard_date", 30, 30, 15, 15, 7),
        "delivery_partner_key, delivery_partner_id, partner_name, city, vehicle_type, employment_type, is_active, CAST(onboard_date AS VARCHAR) AS onboard_date, "
        "CAST(avg_rating AS DOUBLE) AS avg_rating, rating_type_id, rating_type",
    ),
)
def delivery_partner_view(src: Source) -> DataFrame:
    return views.delivery_partner_view(enriched(src, "dim_delivery_partner"), day(AS_OF))


@query(
    "v4_menu_item_view",
    "SELECT m.menu_item_key, m.menu_item_id, m.restaurant_key, r.restaurant_id, m.item_name, m.category, m.is_veg, CAST(m.price AS DOUBLE) AS price "
    "FROM dim_menu_item m LEFT JOIN dim_restaurant r ON r.restaurant_key = m.restaurant_key",
)
def menu_item_view(src: Source) -> DataFrame:
    return views.menu_item_view(src("dim_menu_item"), src("dim_restaurant"))


@query(
    "v5_lookup_views",
    "SELECT fiscal_year, fiscal_quarter, is_weekend, cust_lc_id, life_cycle, count(*) AS orders FROM (SELECT "
    "CAST(CASE WHEN order_date_key = -1 THEN 1900 WHEN (order_date_key // 100) % 100 >= 4 THEN order_date_key // 10000 ELSE order_date_key // 10000 - 1 END AS INTEGER) AS fiscal_year, "
    "CASE WHEN order_date_key = -1 THEN 'N/A' ELSE 'FQ' || CAST((((order_date_key // 100) % 100 + 8) % 12) // 3 + 1 AS VARCHAR) END AS fiscal_quarter, "
    "CASE WHEN order_date_key = -1 THEN false ELSE dayofweek(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d')) IN (0, 6) END AS is_weekend, cust_lc_id, "
    "CASE cust_lc_id WHEN 0 THEN 'Unknown' WHEN 1 THEN 'New' WHEN 2 THEN 'Retained' WHEN 3 THEN 'Reactivated' END AS life_cycle FROM fact_order_all) GROUP BY ALL",
)
def lookup_views(src: Source) -> DataFrame:
    """Orders by the calendar and life-cycle views they are read through."""
    days = views.calendar_view(cal(src)).select("date_key", "fiscal_year", "fiscal_quarter", "is_weekend")
    cycles = lookups.life_cycles(src.spark).select("lc_id", "life_cycle")
    # Counting on the keys first leaves a few thousand rows to join with the two lookups.
    counted = orders_fact(src).groupBy("order_date_key", "cust_lc_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.join(days, F.col("order_date_key") == F.col("date_key"))
        .join(cycles, F.col("cust_lc_id") == F.col("lc_id"))
        .groupBy("fiscal_year", "fiscal_quarter", "is_weekend", "cust_lc_id", "life_cycle")
        .agg(F.sum("n").alias("orders"))
    )


def _counted(facts_made: DataFrame, view: DataFrame, key: str, view_key: str, *shown: str) -> DataFrame:
    """Facts per row of a lookup view; rows are counted by key before they meet the view."""
    counted = facts_made.groupBy(F.col(key).alias("fact_key")).agg(F.count(F.lit(1)).alias("facts"))
    return counted.join(view, F.col("fact_key") == F.col(view_key)).select(*shown, "facts")


@query(
    "v5_time_view",
    "SELECT hour, hour_12, am_pm, count(*) AS orders FROM (SELECT CAST(order_time_key // 100 AS INTEGER) AS hour, "
    "CAST(CASE WHEN (order_time_key // 100) % 12 = 0 THEN 12 ELSE (order_time_key // 100) % 12 END AS INTEGER) AS hour_12, "
    "CASE WHEN order_time_key >= 1200 THEN 'PM' ELSE 'AM' END AS am_pm FROM fact_order_all WHERE order_time_key <> -1) GROUP BY ALL",
)
def time_view(src: Source) -> DataFrame:
    """Orders by the hours of the time view."""
    clock = views.time_view(calendar.dim_time(src.spark)).filter("time_key <> -1")
    per_minute = _counted(orders_fact(src), clock, "order_time_key", "time_key", "hour", "hour_12", "am_pm")
    return per_minute.groupBy("hour", "hour_12", "am_pm").agg(F.sum("facts").alias("orders"))


@query(
    "v5_rating_type_view",
    "SELECT rating_type_id, CASE rating_type_id WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Excellent' WHEN 2 THEN 'Good' WHEN 3 THEN 'Average' "
    "WHEN 4 THEN 'Poor' WHEN 5 THEN 'Very Bad' END AS rating_type, count(*) AS facts FROM fact_rating_all GROUP BY 1",
)
def rating_type_view(src: Source) -> DataFrame:
    view = views.rating_type_view(lookups.rating_types(src.spark))
    return _counted(ratings_fact(src), view, "rating_type_id", "rating_type_id", "rating_type_id", "rating_type")


@query(
    "v5_sentiment_view",
    "SELECT sentiment_type_id AS sentiment_id, CASE sentiment_type_id WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Positive' WHEN 2 THEN 'Neutral' "
    "WHEN 3 THEN 'Negative' END AS sentiment, count(*) AS facts FROM fact_rating_all GROUP BY 1",
)
def sentiment_view(src: Source) -> DataFrame:
    view = views.sentiment_type_view(lookups.sentiment_types(src.spark))
    return _counted(ratings_fact(src), view, "sentiment_type_id", "sentiment_id", "sentiment_id", "sentiment")


@query(
    "v5_life_cycle_view",
    "SELECT driver_lc_id AS lc_id, CASE driver_lc_id WHEN 1 THEN 'New' WHEN 2 THEN 'Retained' WHEN 3 THEN 'Reactivated' END AS life_cycle, "
    "count(*) AS facts FROM fact_order_all WHERE driver_lc_id IS NOT NULL GROUP BY 1",
)
def life_cycle_view(src: Source) -> DataFrame:
    view = views.life_cycle_view(lookups.life_cycles(src.spark))
    return _counted(orders_fact(src), view, "driver_lc_id", "lc_id", "lc_id", "life_cycle")


@query(
    "v5_aspect_view",
    "SELECT c.aspect_id, CASE c.aspect_id WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Food Quality' END AS aspect, count(*) AS facts "
    "FROM doc_reviews r JOIN doc_cache c ON c.review_hash = sha256(lower(trim(r.review_text))) GROUP BY 1",
)
def aspect_view(src: Source) -> DataFrame:
    return _counted(fact_review_aspect(src), views.aspect_view(lookups.aspects(src.spark)), "aspect_id", "aspect_id", "aspect_id", "aspect")


def _key_date(c: str) -> str:
    return f"CASE WHEN {c} <> -1 THEN CAST(CAST(strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE) AS VARCHAR) END"


def _key_time(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 0 AND 2359 THEN lpad(CAST({c} // 100 AS VARCHAR), 2, '0') || ':' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0') || ':00' END"


_ID_JOINS = (
    "LEFT JOIN dim_customer c ON c.customer_key = f.customer_key LEFT JOIN dim_restaurant r ON r.restaurant_key = f.restaurant_key "
    "LEFT JOIN dim_delivery_partner p ON p.delivery_partner_key = f.delivery_partner_key"
)
_IDS = "f.customer_key, c.customer_id, f.restaurant_key, r.restaurant_id, f.delivery_partner_key, p.delivery_partner_id"


@query(
    "v6_order_view",
    f"SELECT f.order_id, f.order_date_key, {_key_date('f.order_date_key')} AS order_date, f.order_time_key, {_key_time('f.order_time_key')} AS order_time, {_IDS}, "
    + dbl(*[f"f.{c}" for c in MONEY]) + f", f.is_cod, f.is_cancelled, f.cust_lc_id, f.rest_lc_id, f.driver_lc_id FROM fact_order_all f {_ID_JOINS}",
)
def order_view(src: Source) -> DataFrame:
    return views.order_view(orders_fact(src), *(src(n) for n in DIMS))


@query(
    "v7_order_item_view",
    "SELECT f.order_item_id, f.order_id, f.order_date_key, f.customer_key, f.restaurant_key, f.menu_item_key, m.menu_item_id, f.quantity, "
    + dbl("f.unit_price", "f.gross_line_total", "f.item_discount", "f.net_line_total") + " FROM fact_item_all f LEFT JOIN dim_menu_item m ON m.menu_item_key = f.menu_item_key",
)
def order_item_view(src: Source) -> DataFrame:
    return views.order_item_view(items_fact(src), src("dim_menu_item"))


@query(
    "v8_delivery_view",
    f"SELECT f.* EXCLUDE (batch_id, customer_key, restaurant_key, delivery_partner_key) REPLACE (CAST(f.distance_km AS DOUBLE) AS distance_km), {_key_date('f.delivery_date_key')} AS delivery_date, {_IDS} "
    f"FROM fact_delivery_all f {_ID_JOINS}",
)
def delivery_view(src: Source) -> DataFrame:
    return views.delivery_view(deliveries_fact(src), *(src(n) for n in DIMS))


@query(
    "v9_rating_view",
    f"SELECT f.rating_id, f.order_id, f.rating_date_key, {_key_date('f.rating_date_key')} AS review_date, f.rating_time_key, {_key_time('f.rating_time_key')} AS review_time, {_IDS}, "
    f"{dbl('f.rating')}, f.rating_type_id, {dbl('f.sentiment_score')}, f.sentiment_type_id, f.review_text FROM fact_rating_all f {_ID_JOINS}",
)
def rating_view(src: Source) -> DataFrame:
    return views.rating_view(ratings_fact(src), *(src(n) for n in DIMS))


@query(
    "v10_review_aspect_view",
    "SELECT CAST(d.doc_id AS VARCHAR) AS rating_id, c.aspect_id, c.sentiment_type_id AS sentiment_id, c.sentiment_type_id, CASE WHEN d.lang = 'en' THEN '2024-01-15' END AS review_date, c.matched_phrase "
    "FROM documents d JOIN doc_cache c ON c.review_hash = sha256(lower(trim(d.text)))",
)
def review_aspect_view(src: Source) -> DataFrame:
    ratings = src.table("documents").select(
        F.col("doc_id").alias("rating_key"), F.col("doc_id").cast("string").alias("rating_id"),
        F.when(F.col("lang") == "en", 20240115).otherwise(-1).alias("rating_date_key"),
    )
    return views.review_aspect_view(fact_review_aspect(src), ratings)


__all__ = ["before_and_next"]
