"""Gates, clean projections, upserts and warnings over the mapped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import clean, gates, lookups, upsert, warnings
from strataflow.plans import source_maps as M
from strataflow.plans.registry import Source, dbl, fragment, query, txt
from strataflow.spec import ENTITIES

AS_OF = "2001-08-01"
RAW_KEY = "batch_id, source_file_name, source_row_number"


# The oracles' own formats of ids and numbers.
ID_PATTERNS = {
    "customer_id": "^CUST[0-9]{6}$", "restaurant_id": "^REST[0-9]{5}$", "delivery_partner_id": "^DP[0-9]{5}$",
    "menu_item_id": "^MENU[0-9]{5}_[0-9]{4}$", "order_id": "^ORD[0-9]{12}$", "order_item_id": "^ITE[0-9]{15}$",
    "delivery_id": "^DEL[0-9]{12}$", "rating_id": "^RAT[0-9]{12}$",
}
PLAIN_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


# Spark side -----------------------------------------------------------------------------------------------


def master(src: Source, name: str) -> DataFrame:
    """City, channel, cuisine and category come from the tables; the other masters are the seeds."""
    if name in M.MASTERS:
        return src(f"master_{name}")
    return src.once(("master", name), lambda: lookups.master_rows(src.spark, name))


def gated(src: Source, entity: str) -> DataFrame:
    """Raw rows through the gates, with parents as they were before: late and new ones are missing."""
    masters = {c: master(src, c) for c in gates.MASTER_COLUMNS.get(entity, ())}
    parents = {p: src(f"before_{p}") for _, p, _ in gates.PARENT_COLUMNS.get(entity, ())}
    return src.once(
        ("gated", entity),
        lambda: gates.apply_gates(entity, src(f"raw_{entity}"), masters, parents, F.lit(AS_OF).cast("date")),
    )


def cleaned(src: Source, entity: str) -> DataFrame:
    return clean.clean_rows(entity, gates.passed(gated(src, entity)))


def outcome(src: Source, entity: str) -> tuple[DataFrame, DataFrame]:
    """The keys of the clean rows and the errors, from rows that went through the gates once and were stored."""
    rows = src.stored(f"outcome-{entity}", lambda: gated(src, entity).select(*gates.outcome_columns(entity)))
    return clean.clean_rows(entity, gates.passed(rows), wanted=()), gates.quarantined(entity, rows).drop("error_timestamp")


def errors_of(src: Source, entity: str) -> DataFrame:
    return gates.quarantined(entity, gated(src, entity)).drop("error_timestamp")


# Oracle side ----------------------------------------------------------------------------------------------

def _num(c: str, p: int = 18, s: int = 2) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '{PLAIN_NUMBER}') THEN TRY_CAST(trim({c}) AS DECIMAL({p},{s})) END"


def _int(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({c}) AS INTEGER) END"


def _whole(c: str) -> str:
    return f"TRY_CAST(trunc({_num(c)}) AS INTEGER)"


def _date(c: str, day_first: bool = False) -> str:
    formats = [f"TRY_CAST(TRY_STRPTIME(trim({c}), '%m/%d/%Y') AS DATE)"]
    if day_first:
        formats.append(f"TRY_CAST(TRY_STRPTIME(trim({c}), '%d-%m-%Y') AS DATE)")
    return f"COALESCE({', '.join(formats)}, TRY_CAST(trim({c}) AS DATE))"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def _bad_id(c: str) -> str:
    return f"({c} IS NULL OR NOT regexp_matches(trim({c}), '{ID_PATTERNS[c]}'))"


def _yn(c: str) -> str:
    return f"({c} IS NULL OR upper(trim({c})) NOT IN ('Y', 'N'))"


def _no_master(c: str) -> str:
    return (
        f"NOT EXISTS (SELECT 1 FROM master_{c} m WHERE m.is_active AND "
        f"(m.code = upper(trim(r.{c})) OR upper(m.name) = upper(trim(r.{c}))))"
    )


def _orphan(c: str, parent: str) -> str:
    return f"NOT {_bad_id(c)} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c} = upper(trim(r.{c})))"


def _outside(value: str, low, high=None, above: bool = False) -> str:
    cond = f"({value}) {'<=' if above else '<'} {low}"
    return f"({cond} OR ({value}) > {high})" if high is not None else f"({cond})"


for _name in ("vehicle_type", "employment_type", "partner_type"):
    _entries = [e if isinstance(e, tuple) else (e.upper(), e) for e in lookups.MASTERS[_name]]
    fragment(
        f"master_{_name}",
        "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}', true)" for c, n in _entries) + ") v(code, name, is_active)",
    )

REQ, MISS, FMT, RNG, LOG, NF = (
    gates.REQUIRED, gates.MISSING, gates.FORMAT, gates.RANGE, gates.LOGIC, gates.NOT_FOUND
)
_CANCELLED = "EXISTS (SELECT 1 FROM before_order o WHERE o.is_cancelled AND o.order_id = upper(trim(r.order_id)))"
_FUTURE = f"{_date('onboard_date')} > DATE '{AS_OF}'"
_QTY, _PRICE, _DISC, _TOTAL = _int("quantity"), _num("unit_price"), _num("item_discount"), _num("line_total")


def _order_amounts() -> list[tuple]:
    out = []
    for first, column, optional in (
        (35, "subtotal_amount", False), (37, "discount_amount", True), (39, "delivery_fee", True),
        (41, "total_amount", False),
    ):
        present = f" AND NOT {_blank(column)}" if optional else ""
        out.append((f"B{first}", column, FMT, f"({_num(column)}) IS NULL{present}"))
        out.append((f"B{first + 1}", column, RNG, _outside(_num(column), 0)))
    return out


def _delivery_numbers() -> list[tuple]:
    rows = []
    for first, column, low, high, above, optional, skip in (
        (60, "expected_delivery_time_min", 5, 120, False, False, True),
        (62, "actual_delivery_time_min", 5, 180, False, True, True),
        (64, "distance_km", 0, 100, True, False, True),
        (66, "order_item", 0, 100, True, False, True),
        (68, "delivery_item", 0, 100, False, True, True),
        (70, "prep_time", 0, 180, False, True, False),
        (72, "rider_wait_time", 0, 60, False, True, False),
        (74, "travel_time", 0, 180, False, True, False),
    ):
        value = _num(column, 10, 2) if column == "distance_km" else _whole(column)
        bad = f"({value}) IS NULL"
        if optional:
            bad += f" AND NOT {_blank(column)}"
        if skip:
            bad += f" AND NOT {_CANCELLED}"
        rows.append((f"B{first}", column, FMT, bad))
        rows.append((f"B{first + 1}", column, RNG, _outside(value, low, high, above)))
    return rows


CHECKS: dict[str, list[tuple]] = {
    "customer": [
        ("B1", "customer_id", REQ, _bad_id("customer_id")),
        ("B2", "signup_date", FMT, f"{_date('signup_date', True)} IS NULL"),
        ("B3", "city", NF, _no_master("city")),
        ("B4", "acquisition_channel", NF, _no_master("acquisition_channel")),
    ],
    "restaurant": [
        ("B5", "restaurant_id", REQ, _bad_id("restaurant_id")),
        ("B6", "restaurant_name", MISS, _blank("restaurant_name")),
        ("B7", "onboard_date", FMT, f"{_date('onboard_date')} IS NULL"),
        ("B8", "onboard_date", RNG, _FUTURE),
        ("B9", "is_active", FMT, _yn("is_active")),
        ("B10", "city", NF, _no_master("city")),
        ("B11", "cuisine_type", NF, _no_master("cuisine_type")),
        ("B12", "partner_type", NF, _no_master("partner_type")),
    ],
    "delivery_partner": [
        ("B13", "delivery_partner_id", REQ, _bad_id("delivery_partner_id")),
        ("B14", "onboard_date", FMT, f"{_date('onboard_date')} IS NULL"),
        ("B15", "onboard_date", RNG, _FUTURE),
        ("B16", "avg_rating", FMT, f"NOT {_blank('avg_rating')} AND ({_num('avg_rating', 5, 2)}) IS NULL"),
        ("B17", "avg_rating", RNG, _outside(_num("avg_rating", 5, 2), 0, 5)),
        ("B18", "is_active", FMT, _yn("is_active")),
        ("B19", "city", NF, _no_master("city")),
        ("B20", "vehicle_type", NF, _no_master("vehicle_type")),
        ("B21", "employment_type", NF, _no_master("employment_type")),
    ],
    "menu_item": [
        ("B22", "menu_item_id", REQ, _bad_id("menu_item_id")),
        ("B23", "restaurant_id", NF,
         f"{_blank('restaurant_id')} OR NOT EXISTS (SELECT 1 FROM before_restaurant p WHERE p.restaurant_id = upper(trim(r.restaurant_id)))"),
        ("B24", "price", FMT, f"({_num('price', 10, 2)}) IS NULL"),
        ("B25", "price", RNG, _outside(_num("price", 10, 2), 0)),
        ("B26", "is_veg", FMT, _yn("is_veg")),
        ("B27", "category", NF, _no_master("category")),
    ],
    "order": [
        ("B28", "order_id", REQ, _bad_id("order_id")),
        ("B29", "customer_id", REQ, _bad_id("customer_id")),
        ("B30", "restaurant_id", REQ, _bad_id("restaurant_id")),
        ("B31", "delivery_partner_id", REQ, f"NOT {_blank('delivery_partner_id')} AND {_bad_id('delivery_partner_id')}"),
        ("B32", "order_timestamp", FMT, "TRY_CAST(trim(order_timestamp) AS TIMESTAMP) IS NULL"),
        ("B33", "is_cod", FMT, _yn("is_cod")),
        ("B34", "is_cancelled", FMT, _yn("is_cancelled")),
        *_order_amounts(),
    ],
    "order_item": [
        ("B43", "order_item_id", REQ, _bad_id("order_item_id")),
        ("B44", "order_id", REQ, _bad_id("order_id")),
        ("B45", "menu_item_id", REQ, _bad_id("menu_item_id")),
        ("B46", "order_id", NF, _orphan("order_id", "before_order")),
        ("B47", "menu_item_id", NF, _orphan("menu_item_id", "before_menu_item")),
        ("B48", "quantity", FMT, f"({_QTY}) IS NULL"),
        ("B49", "quantity", RNG, f"({_QTY}) <= 0"),
        ("B50", "unit_price", FMT, f"({_PRICE}) IS NULL"),
        ("B51", "unit_price", RNG, f"({_PRICE}) < 0"),
        ("B52", "item_discount", FMT, f"({_DISC}) IS NULL"),
        ("B53", "item_discount", RNG, f"(({_DISC}) < 0 AND ({_QTY}) IS NOT NULL AND ({_PRICE}) IS NOT NULL) OR ({_DISC}) > ({_QTY}) * ({_PRICE})"),
        ("B54", "line_total", FMT, f"({_TOTAL}) IS NULL"),
        ("B55", "line_total", LOG, f"abs(({_TOTAL}) - (({_QTY}) * ({_PRICE}) - ({_DISC}))) > 0.02"),
    ],
    "delivery_performance": [
        ("B56", "delivery_id", REQ, _bad_id("delivery_id")),
        ("B57", "order_id", REQ, _bad_id("order_id")),
        ("B58", "order_id", NF, _orphan("order_id", "before_order")),
        ("B59", "order_id", gates.CANCELLED, _CANCELLED),
        *_delivery_numbers(),
        ("B76", "actual_delivery_time_min", LOG,
         f"{_whole('actual_delivery_time_min')} <> {_whole('prep_time')} + {_whole('travel_time')}"),
        ("B77", "rider_wait_time", LOG, f"{_whole('rider_wait_time')} > {_whole('prep_time')}"),
    ],
    "rating": [
        ("B78", "rating_id", REQ, _bad_id("rating_id")),
        ("B79", "order_id", REQ, _bad_id("order_id")),
        ("B80", "customer_id", REQ, _bad_id("customer_id")),
        ("B81", "restaurant_id", REQ, _bad_id("restaurant_id")),
        ("B82", "order_id", NF, _orphan("order_id", "before_order")),
        ("B83", "customer_id", NF, _orphan("customer_id", "before_customer")),
        ("B84", "restaurant_id", NF, _orphan("restaurant_id", "before_restaurant")),
        ("B85", "rating", FMT, f"({_num('rating', 3, 2)}) IS NULL"),
        ("B86", "rating", RNG, _outside(_num("rating", 3, 2), 1, 5)),
        ("B87", "review_timestamp", FMT, "TRY_CAST(trim(review_timestamp) AS TIMESTAMP) IS NULL"),
        ("B88", "sentiment_score", FMT, f"({_num('sentiment_score', 5, 4)}) IS NULL"),
        ("B89", "sentiment_score", RNG, _outside(_num("sentiment_score", 5, 4), -1, 1)),
    ],
}
for _entity, _checks in CHECKS.items():
    fragment(
        f"err_{_entity}",
        " UNION ALL ".join(
            f"SELECT {RAW_KEY}, 'raw_{_entity}' AS table_name, '{g}' AS gate_id, '{c}' AS column_name, "
            f"'{t}' AS error_type, {c} AS raw_value FROM raw_{_entity} r WHERE {cond}"
            for g, c, t, cond in _checks
        ),
    )


def _display(c: str) -> str:
    return (
        f"COALESCE((SELECT min(m.name) FROM master_{c} m WHERE m.is_active AND (m.code = upper(trim(r.{c})) "
        f"OR upper(m.name) = upper(trim(r.{c})))), trim(r.{c}))"
    )


def _key(c: str) -> str:
    return f"upper(trim({c}))"


def _unnamed(c: str) -> str:
    return f"CASE WHEN {_blank(c)} THEN 'UNKNOWN NAME' ELSE trim({c}) END"


TYPED: dict[str, dict[str, str]] = {
    "customer": {
        "customer_id": _key("customer_id"), "signup_date": _date("signup_date", True), "city": _display("city"),
        "acquisition_channel": _display("acquisition_channel"),
    },
    "restaurant": {
        "restaurant_id": _key("restaurant_id"), "onboard_date": _date("onboard_date"),
        "restaurant_name": "trim(restaurant_name)", "city": _display("city"),
        "cuisine_type": _display("cuisine_type"), "partner_type": _display("partner_type"),
        "avg_prep_time_min": "NULLIF(trim(avg_prep_time_min), '')", "is_active": "upper(trim(is_active)) = 'Y'",
    },
    "delivery_partner": {
        "delivery_partner_id": _key("delivery_partner_id"), "onboard_date": _date("onboard_date"),
        "partner_name": _unnamed("partner_name"), "city": _display("city"),
        "vehicle_type": _display("vehicle_type"), "employment_type": _display("employment_type"),
        "avg_rating": _num("avg_rating", 5, 2), "is_active": "upper(trim(is_active)) = 'Y'",
    },
    "menu_item": {
        "menu_item_id": _key("menu_item_id"), "restaurant_id": _key("restaurant_id"),
        "item_name": _unnamed("item_name"), "category": _display("category"),
        "is_veg": "upper(trim(is_veg)) = 'Y'", "price": _num("price", 10, 2),
    },
    "order": {
        "order_id": _key("order_id"), "customer_id": _key("customer_id"), "restaurant_id": _key("restaurant_id"),
        "delivery_partner_id": f"NULLIF({_key('delivery_partner_id')}, '')",
        "order_timestamp": "TRY_CAST(trim(order_timestamp) AS TIMESTAMP)",
        "subtotal_amount": _num("subtotal_amount"),
        "discount_amount": f"COALESCE({_num('discount_amount')}, 0)",
        "delivery_fee": f"COALESCE({_num('delivery_fee')}, 0)", "total_amount": _num("total_amount"),
        "is_cod": "upper(trim(is_cod)) = 'Y'", "is_cancelled": "upper(trim(is_cancelled)) = 'Y'",
    },
    "order_item": {
        "order_item_id": _key("order_item_id"), "order_id": _key("order_id"), "menu_item_id": _key("menu_item_id"),
        "quantity": _QTY, "unit_price": _PRICE, "item_discount": _DISC, "line_total": _TOTAL,
    },
    "delivery_performance": {
        "delivery_id": _key("delivery_id"), "order_id": _key("order_id"),
        **{
            c: _whole(c)
            for c in (
                "prep_time", "rider_wait_time", "travel_time", "order_item", "expected_delivery_time_min",
                "actual_delivery_time_min", "delivery_item",
            )
        },
        "distance_km": _num("distance_km", 10, 2),
    },
    "rating": {
        "rating_id": _key("rating_id"), "order_id": _key("order_id"), "customer_id": _key("customer_id"),
        "restaurant_id": _key("restaurant_id"), "rating": _num("rating", 3, 2),
        "review_text": "NULLIF(substring(trim(review_text), 1, 4000), '')",
        "review_timestamp": "TRY_CAST(trim(review_timestamp) AS TIMESTAMP)",
        "sentiment_score": _num("sentiment_score", 5, 4),
    },
}
AS_DOUBLE = {
    "avg_rating", "price", "subtotal_amount", "discount_amount", "delivery_fee", "total_amount", "unit_price",
    "item_discount", "line_total", "distance_km", "rating", "sentiment_score",
}
AS_TEXT = {"signup_date", "onboard_date", "order_timestamp", "review_timestamp"}


def shown(columns, prefix: str = "") -> str:
    """Oracle output: decimals as doubles, dates and times as text."""
    return ", ".join(
        dbl(prefix + c) if c in AS_DOUBLE else txt(prefix + c) if c in AS_TEXT else prefix + c for c in columns
    )


for _entity, _columns in TYPED.items():
    _spec = ENTITIES[_entity]
    fragment(
        f"clean_{_entity}",
        "SELECT * EXCLUDE (rn) FROM (SELECT "
        + ", ".join(f"{e} AS {c}" for c, e in _columns.items())
        + f", {RAW_KEY}, row_number() OVER (PARTITION BY batch_id, {_key(_spec.key)} "
        "ORDER BY source_row_number DESC, source_file_name DESC) AS rn "
        f"FROM raw_{_entity} r WHERE NOT EXISTS (SELECT 1 FROM err_{_entity} e WHERE e.batch_id = r.batch_id "
        "AND e.source_file_name = r.source_file_name AND e.source_row_number = r.source_row_number)) WHERE rn = 1",
    )

GATE_NAMES = {
    "customer": "b01_b04_customer_gates", "restaurant": "b05_b12_restaurant_gates",
    "delivery_partner": "b13_b21_delivery_partner_gates", "menu_item": "b22_b27_menu_item_gates",
    "order": "b28_b42_order_gates", "order_item": "b43_b55_order_item_gates",
    "delivery_performance": "b56_b77_delivery_performance_gates", "rating": "b78_b89_rating_gates",
}
CLEAN_NAMES = {e: f"c1_c7_clean_{e}" for e in GATE_NAMES}


def _register_quality() -> None:
    for entity, name in GATE_NAMES.items():
        query(
            name,
            f"SELECT {RAW_KEY}, table_name, gate_id, column_name, error_type, raw_value FROM err_{entity}",
        )(lambda src, e=entity: errors_of(src, e).drop("error_message"))
    for entity, name in CLEAN_NAMES.items():
        columns = [*TYPED[entity], "batch_id", "source_file_name", "source_row_number"]
        query(name, f"SELECT {shown(columns)} FROM clean_{entity}")(lambda src, e=entity: cleaned(src, e))


_register_quality()


@query(
    "b_gate_counts",
    "SELECT table_name, gate_id, column_name, error_type, count(*) AS errors FROM ("
    + " UNION ALL ".join(f"SELECT * FROM err_{e}" for e in GATE_NAMES)
    + ") GROUP BY ALL",
)
def gate_counts(src: Source) -> DataFrame:
    """Errors per gate over all eight entities; each table is counted before the union."""
    out = None
    for entity in GATE_NAMES:
        part = errors_of(src, entity).groupBy("table_name", "gate_id", "column_name", "error_type").agg(
            F.count(F.lit(1)).alias("errors")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "c2_quarantine_split",
    "SELECT r.batch_id, count(*) AS raw_rows, CAST(sum(CASE WHEN e.source_row_number IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS passed_rows, "
    "count(e.source_row_number) AS quarantined_rows "
    "FROM raw_order r LEFT JOIN (SELECT DISTINCT batch_id, source_file_name, source_row_number FROM err_order) e "
    "ON e.batch_id = r.batch_id AND e.source_file_name = r.source_file_name AND e.source_row_number = r.source_row_number "
    "GROUP BY r.batch_id",
)
def quarantine_split(src: Source) -> DataFrame:
    bad = F.size("gate_errors") > 0
    return gated(src, "order").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(~bad).alias("passed_rows"),
        F.count_if(bad).alias("quarantined_rows"),
    )


@query(
    "c3_master_names",
    "SELECT v.match_value, min(v.name) AS name FROM (SELECT code AS match_value, name FROM master_city WHERE is_active "
    "UNION ALL SELECT upper(name), name FROM master_city WHERE is_active) v GROUP BY v.match_value",
)
def master_names(src: Source) -> DataFrame:
    return lookups.match_values(src("master_city"))


# Upserts --------------------------------------------------------------------------------------------------

UPSERTS = {
    "customer": "d2_upsert_customer", "restaurant": "d3_upsert_restaurant", "menu_item": "d4_upsert_menu_item",
    "delivery_partner": "d5_upsert_delivery_partner", "order": "d6_upsert_order",
    "order_item": "d7_upsert_order_item", "delivery_performance": "d8_upsert_delivery_performance",
    "rating": "d9_upsert_rating",
}
fragment(
    "before_order_item",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY source_row_number DESC, "
    "source_file_name DESC) AS rn FROM lines WHERE batch_id < 200001) WHERE rn = 1",
)
fragment(
    "next_order_item",
    "SELECT * EXCLUDE (rn) REPLACE (CASE WHEN quantity > 45 THEN quantity - 1 ELSE quantity END AS quantity) FROM "
    "(SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY source_row_number DESC, source_file_name DESC) AS rn "
    "FROM lines) WHERE rn = 1",
)


def _latest_lines(lines: DataFrame) -> DataFrame:
    return clean.keep_latest(lines, ["order_item_id"])


def before_and_next(src: Source, entity: str) -> tuple[DataFrame, DataFrame]:
    if entity != "order_item":
        return src(f"before_{entity}"), src(f"next_{entity}")
    lines = src("lines")
    smaller = F.when(F.col("quantity") > 45, F.col("quantity") - 1).otherwise(F.col("quantity"))
    return (
        _latest_lines(lines.filter("batch_id < 200001")),
        _latest_lines(lines).withColumn("quantity", smaller),
    )


def _upsert_sql(entity: str) -> str:
    spec = ENTITIES[entity]
    columns = [spec.key, *spec.tracked, "batch_id", "source_file_name", "source_row_number"]
    t, s = f"before_{entity}", f"next_{entity}"
    same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in spec.tracked)
    return (
        f"SELECT {shown(columns, 's.')}, 'INSERT' AS merge_action FROM {s} s WHERE NOT EXISTS (SELECT 1 FROM {t} t WHERE t.{spec.key} = s.{spec.key}) "
        f"UNION ALL SELECT {shown(columns, 's.')}, 'UPDATE' FROM {s} s JOIN {t} t ON t.{spec.key} = s.{spec.key} WHERE NOT ({same}) "
        f"UNION ALL SELECT {shown(columns, 't.')}, 'UNCHANGED' FROM {s} s JOIN {t} t ON t.{spec.key} = s.{spec.key} WHERE {same} "
        f"UNION ALL SELECT {shown(columns, 't.')}, 'KEEP' FROM {t} t WHERE NOT EXISTS (SELECT 1 FROM {s} s WHERE t.{spec.key} = s.{spec.key})"
    )


def _register_upserts() -> None:
    for entity, name in UPSERTS.items():
        fragment(f"merged_{entity}", _upsert_sql(entity))
        query(name, f"SELECT * FROM merged_{entity}")(
            lambda src, e=entity: upsert.upsert_entity(e, *before_and_next(src, e))
        )


_register_upserts()


@query(
    "d1_upsert_actions",
    " UNION ALL ".join(
        f"SELECT '{e}' AS entity, CAST(sum(CASE WHEN merge_action = 'INSERT' THEN 1 ELSE 0 END) AS BIGINT) AS inserted, "
        "CAST(sum(CASE WHEN merge_action = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS updated, "
        f"CAST(sum(CASE WHEN merge_action = 'UNCHANGED' THEN 1 ELSE 0 END) AS BIGINT) AS unchanged FROM merged_{e}"
        for e in UPSERTS
    ),
)
def upsert_actions(src: Source) -> DataFrame:
    """Action counts of all eight upserts."""
    out = None
    for entity in UPSERTS:
        target, source = before_and_next(src, entity)
        merged = upsert.upsert_entity(entity, target, source)
        part = upsert.action_counts(merged).select(F.lit(entity).alias("entity"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# Warnings and remediation ---------------------------------------------------------------------------------

HIGH_VALUE = 400000
_DIFF = "CAST(total_amount - (subtotal_amount - COALESCE(discount_amount, 0) + COALESCE(delivery_fee, 0)) AS DECIMAL(18,2))"
_MONEY0 = "CAST(0 AS DECIMAL(18,2))"
fragment(
    "found_warnings",
    "SELECT batch_id, order_id, 'CUSTOMER' AS entity_name, customer_id AS entity_id, 'ORPHAN_CUSTOMER_DETECTED' AS warning_type, "
    "'Order of the unknown customer ' || customer_id || '; kept, as its revenue counts' AS warning_message "
    "FROM ods_order o WHERE NOT EXISTS (SELECT 1 FROM before_customer p WHERE p.customer_id = o.customer_id) "
    "UNION ALL SELECT batch_id, order_id, 'RESTAURANT', restaurant_id, 'ORPHAN_RESTAURANT_DETECTED', "
    "'Order at the unknown restaurant ' || restaurant_id "
    "FROM ods_order o WHERE NOT EXISTS (SELECT 1 FROM before_restaurant p WHERE p.restaurant_id = o.restaurant_id) "
    "UNION ALL SELECT batch_id, order_id, 'DELIVERY_PARTNER', delivery_partner_id, 'ORPHAN_DELIVERY_PARTNER_DETECTED', "
    "'Order brought by the unknown partner ' || delivery_partner_id "
    "FROM ods_order o WHERE delivery_partner_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM before_delivery_partner p WHERE p.delivery_partner_id = o.delivery_partner_id) "
    "UNION ALL SELECT batch_id, order_id, 'FINANCIAL_INTEGRITY', order_id, 'TOTAL_AMOUNT_MISMATCH', "
    f"'The total of ' || CAST(total_amount AS VARCHAR) || ' is off by ' || CAST({_DIFF} AS VARCHAR) || ' from ' || "
    f"CAST(CAST(subtotal_amount - COALESCE(discount_amount, {_MONEY0}) + COALESCE(delivery_fee, {_MONEY0}) AS DECIMAL(18,2)) AS VARCHAR) || ', which is ' || "
    f"CAST(subtotal_amount AS VARCHAR) || ' less ' || CAST(COALESCE(discount_amount, {_MONEY0}) AS VARCHAR) || ' plus ' || CAST(COALESCE(delivery_fee, {_MONEY0}) AS VARCHAR) "
    f"FROM ods_order WHERE abs({_DIFF}) > 0.01 "
    "UNION ALL SELECT batch_id, order_id, 'ORDER', order_id, 'HIGH_VALUE_ORDER', "
    f"'A large order of ' || CAST(total_amount AS VARCHAR) FROM ods_order WHERE total_amount > {HIGH_VALUE}",
)


def found_warnings(src: Source) -> DataFrame:
    return warnings.order_warnings(
        src("ods_order"), src("before_customer"), src("before_restaurant"), src("before_delivery_partner"),
        high_value=HIGH_VALUE,
    )


@query(
    "d10_order_warnings",
    "SELECT batch_id, 'LOAD_ODS_ORDER' AS step_name, 'ods_order' AS table_name, order_id, entity_name, entity_id, "
    "warning_type, warning_message FROM found_warnings",
)
def order_warnings(src: Source) -> DataFrame:
    return found_warnings(src)


@query(
    "d11_warning_counts",
    "SELECT batch_id, " + ", ".join(
        f"CAST(sum(CASE WHEN warning_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
        for n, t in warnings.WARNING_TYPES.items()
    ) + " FROM found_warnings GROUP BY batch_id",
)
def warning_counts(src: Source) -> DataFrame:
    return warnings.warning_counts(found_warnings(src), ["batch_id"])


@query(
    "d12_placeholder_orders",
    "SELECT upper(trim(raw_value)) AS order_id, 'UNKNOWN' AS customer_id, 'UNKNOWN' AS restaurant_id, 'UNKNOWN' AS delivery_partner_id, "
    "'1900-01-01 00:00:00' AS order_timestamp, 0.0::DOUBLE AS subtotal_amount, 0.0::DOUBLE AS discount_amount, 0.0::DOUBLE AS delivery_fee, "
    "0.0::DOUBLE AS total_amount, false AS is_cod, false AS is_cancelled, min(batch_id) AS batch_id, "
    "'REMEDIATION_DUMMY' AS source_file_name, CAST(0 AS BIGINT) AS source_row_number "
    "FROM err_order_item WHERE column_name = 'order_id' AND error_type = 'MASTER_DATA_NOT_FOUND' GROUP BY 1",
)
def placeholder_orders(src: Source) -> DataFrame:
    return warnings.placeholder_orders(errors_of(src, "order_item"))


@query(
    "d13_rejected_value",
    "SELECT count(*) AS total_rejected_items, count(DISTINCT e.raw_value) AS total_missing_orders, "
    "CAST(sum(TRY_CAST(r.line_total AS DECIMAL(18,2))) AS DOUBLE) AS total_rejected_amount FROM err_order_item e JOIN raw_order_item r "
    "ON e.batch_id = r.batch_id AND e.source_file_name = r.source_file_name AND e.source_row_number = r.source_row_number",
)
def rejected_value(src: Source) -> DataFrame:
    return warnings.rejected_value(errors_of(src, "order_item"), src("raw_order_item"))


@query(
    "d14_cancelled_deliveries",
    "SELECT r.batch_id, r.source_file_name, r.source_row_number, r.delivery_id, r.order_id, o.is_cancelled, "
    "CAST(o.order_timestamp AS VARCHAR) AS order_timestamp, r.expected_delivery_time_min, r.actual_delivery_time_min "
    "FROM (SELECT DISTINCT batch_id, source_file_name, source_row_number FROM err_delivery_performance) e "
    "JOIN raw_delivery_performance r ON e.batch_id = r.batch_id AND e.source_file_name = r.source_file_name AND e.source_row_number = r.source_row_number "
    "LEFT JOIN before_order o ON r.order_id = o.order_id",
)
def cancelled_deliveries(src: Source) -> DataFrame:
    return warnings.cancelled_deliveries(
        errors_of(src, "delivery_performance"), src("raw_delivery_performance"), src("before_order")
    )
