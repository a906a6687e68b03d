"""Data-quality gates: every row is checked once against all gates of its entity.

What a row alone tells is tested in the scan, before any lookup: one bit per gate. So the joins carry that number in
place of the texts that were tested. Lookups are attached as left joins; keys are unique on the lookup side, so the row
count never changes. The bits that are left then become an array; a row is quarantined when it is not empty, and each
element is one error row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import parsing as P
from strataflow.operators.lookups import MasterMatch, attach_master
from strataflow.spec import ENTITIES

REQUIRED = "INVALID_REQUIRED_FIELD"
MISSING = "MISSING_REQUIRED_FIELD"
FORMAT = "INVALID_FORMAT"
RANGE = "INVALID_RANGE"
LOGIC = "INVALID_LOGIC"
NOT_FOUND = "MASTER_DATA_NOT_FOUND"
CANCELLED = "EXCLUDED_ORDER_CANCELLED"
TEXT_LIMIT = 4000


@dataclass(frozen=True)
class Gate:
    gate_id: str
    column: str
    error_type: str
    message: str
    #: Of the row alone.
    fails: Column
    #: Of what was looked up; the gate fails where both hold.
    found: Column | None = None


VALUE = "__value"


def value(column: str) -> Column:
    """The parsed value of a text column; see `parsed`."""
    return F.col(column + VALUE)


_MONEY = ("decimal(18,2)",)
#: Plain numbers per entity, with the casts from text to value.
NUMBERS: dict[str, dict[str, tuple[str, ...]]] = {
    "delivery_partner": {"avg_rating": ("decimal(5,2)",)},
    "menu_item": {"price": ("decimal(10,2)",)},
    "order": {c: _MONEY for c in ("subtotal_amount", "discount_amount", "delivery_fee", "total_amount")},
    "order_item": {c: _MONEY for c in ("unit_price", "item_discount", "line_total")},
    "delivery_performance": {
        **{
            c: (*_MONEY, "int")
            for c in (
                "prep_time", "rider_wait_time", "travel_time", "order_item", "expected_delivery_time_min",
                "actual_delivery_time_min", "delivery_item",
            )
        },
        "distance_km": ("decimal(10,2)",),
    },
    "rating": {"rating": ("decimal(3,2)",), "sentiment_score": ("decimal(5,4)",)},
}

WIDE = ("order", "delivery_performance", "rating")


def other_values(entity: str) -> dict[str, Column]:
    """The dates, times and whole numbers that the gates look at, besides `NUMBERS`."""
    if entity == "customer":
        return {"signup_date": P.as_date("signup_date", day_first=True)}
    if entity in ("restaurant", "delivery_partner"):
        return {"onboard_date": P.as_date("onboard_date")}
    if entity == "order":
        return {"order_timestamp": P.as_timestamp("order_timestamp")}
    if entity == "order_item":
        return {"quantity": P.as_int("quantity")}
    return {"review_timestamp": P.as_timestamp("review_timestamp")} if entity == "rating" else {}


def parsed(entity: str, raw: DataFrame) -> DataFrame:
    """The raw rows with the value of every number, date and time the gates look at. Parsing them in projections of their
    own means each text is parsed once per row, and the gates compare plain values. In wide entities the texts of numbers
    are tested by one expression over their array: spelt out for each, the code of the scan outgrows what the JVM compiles."""
    numbers = NUMBERS.get(entity, {})
    rows, texts = raw, {n: P.plain_number(F.col(n)) for n in numbers}
    if entity in WIDE:
        rows = rows.select("*", F.transform(F.array(*[F.col(n) for n in numbers]), P.plain_number).alias("gate_numbers"))
        texts = {n: F.get("gate_numbers", F.lit(i)) for i, n in enumerate(numbers)}
    values = {n: reduce(Column.try_cast, casts, texts[n]) for n, casts in numbers.items()}
    return rows.select("*", *[c.alias(n + VALUE) for n, c in (values | other_values(entity)).items()]).drop("gate_numbers")


def _sure(condition: Column) -> Column:
    """A comparison with an unparsed value is not a failure of its own."""
    return F.coalesce(condition, F.lit(False))


def _bad_id(gate_id: str, column: str) -> Gate:
    return Gate(
        gate_id, column, REQUIRED, f"{column} is missing or malformed", ~P.well_formed(column)
    )


def _not_in_master(gate_id: str, column: str) -> Gate:
    return Gate(
        gate_id, column, NOT_FOUND, f"{column} names nothing that is known", F.lit(True),
        F.col(MasterMatch(column, column).result).isNull(),
    )


def _absent(gate_id: str, column: str, found: str) -> Gate:
    """Only a well-formed id is worth looking up; malformed ones fail their own gate."""
    return Gate(
        gate_id, column, NOT_FOUND, f"{column} names nothing that is known",
        P.well_formed(column), F.col(found).isNull(),
    )


def _not_yes_no(gate_id: str, column: str) -> Gate:
    return Gate(gate_id, column, FORMAT, f"{column} has to be Y or N", ~P.is_yes_or_no(column))


def _not_date(gate_id: str, column: str) -> Gate:
    return Gate(
        gate_id, column, FORMAT, f"{column} is no date", value(column).isNull()
    )


def _not_timestamp(gate_id: str, column: str) -> Gate:
    return Gate(
        gate_id, column, FORMAT, f"{column} is no time", value(column).isNull()
    )


def _future(gate_id: str, column: str, as_of: Column) -> Gate:
    return Gate(
        gate_id, column, RANGE, f"{column} lies ahead", _sure(value(column) > as_of)
    )


def _not_number(gate_id: str, column: str, optional: bool = False, unless=None) -> Gate:
    fails = value(column).isNull()
    if optional:
        fails = fails & ~P.blank(column)
    return Gate(gate_id, column, FORMAT, f"{column} is no number", fails, None if unless is None else ~unless)


def _out_of(
    gate_id: str, column: str, low, high=None, message: str | None = None, above: bool = False
) -> Gate:
    """Outside [low, high]; with `above` the lower end itself fails too."""
    fails = (value(column) <= low) if above else (value(column) < low)
    if high is not None:
        fails = fails | (value(column) > high)
        text = f"{column} lies outside {low} to {high}"
    else:
        text = f"{column} has to be {'above' if above else 'at least'} {low}"
    return Gate(gate_id, column, RANGE, message or text, _sure(fails))


def customer_gates(_: Column) -> list[Gate]:
    return [
        _bad_id("B1", "customer_id"),
        _not_date("B2", "signup_date"),
        _not_in_master("B3", "city"),
        _not_in_master("B4", "acquisition_channel"),
    ]


def restaurant_gates(as_of: Column) -> list[Gate]:
    return [
        _bad_id("B5", "restaurant_id"),
        Gate("B6", "restaurant_name", MISSING, "restaurant_name is missing", P.blank("restaurant_name")),
        _not_date("B7", "onboard_date"),
        _future("B8", "onboard_date", as_of),
        _not_yes_no("B9", "is_active"),
        _not_in_master("B10", "city"),
        _not_in_master("B11", "cuisine_type"),
        _not_in_master("B12", "partner_type"),
    ]


def delivery_partner_gates(as_of: Column) -> list[Gate]:
    return [
        _bad_id("B13", "delivery_partner_id"),
        _not_date("B14", "onboard_date"),
        _future("B15", "onboard_date", as_of),
        _not_number("B16", "avg_rating", optional=True),
        _out_of("B17", "avg_rating", 0, 5),
        _not_yes_no("B18", "is_active"),
        _not_in_master("B19", "city"),
        _not_in_master("B20", "vehicle_type"),
        _not_in_master("B21", "employment_type"),
    ]


def menu_item_gates(_: Column, lowest_price: float = 0, highest_price: float | None = None) -> list[Gate]:
    return [
        _bad_id("B22", "menu_item_id"),
        Gate(
            "B23", "restaurant_id", NOT_FOUND, "restaurant_id value does not exists in reference master", F.lit(True),
            P.blank("restaurant_id") | F.col("restaurant_found").isNull(),
        ),
        _not_number("B24", "price"),
        _out_of("B25", "price", lowest_price, highest_price),
        _not_yes_no("B26", "is_veg"),
        _not_in_master("B27", "category"),
    ]


def order_gates(_: Column) -> list[Gate]:
    gates = [
        _bad_id("B28", "order_id"),
        _bad_id("B29", "customer_id"),
        _bad_id("B30", "restaurant_id"),
        Gate(
            "B31", "delivery_partner_id", REQUIRED, "delivery_partner_id is null, empty, or invalid format",
            ~P.blank("delivery_partner_id") & ~P.well_formed("delivery_partner_id"),
        ),
        _not_timestamp("B32", "order_timestamp"),
        _not_yes_no("B33", "is_cod"),
        _not_yes_no("B34", "is_cancelled"),
    ]
    numbers = (
        ("B35", "B36", "subtotal_amount", False),
        ("B37", "B38", "discount_amount", True),
        ("B39", "B40", "delivery_fee", True),
        ("B41", "B42", "total_amount", False),
    )
    for format_id, range_id, column, optional in numbers:
        gates.append(_not_number(format_id, column, optional))
        gates.append(_out_of(range_id, column, 0))
    return gates


def order_item_gates(_: Column) -> list[Gate]:
    quantity, price, discount, total = (
        value(c) for c in ("quantity", "unit_price", "item_discount", "line_total")
    )
    gross = quantity * price
    return [
        _bad_id("B43", "order_item_id"),
        _bad_id("B44", "order_id"),
        _bad_id("B45", "menu_item_id"),
        _absent("B46", "order_id", "order_found"),
        _absent("B47", "menu_item_id", "menu_item_found"),
        _not_number("B48", "quantity"),
        _out_of("B49", "quantity", 0, above=True),
        _not_number("B50", "unit_price"),
        _out_of("B51", "unit_price", 0),
        _not_number("B52", "item_discount"),
        Gate(
            "B53", "item_discount", RANGE, "Item discount is less than 0 or exceeds the total item amount",
            _sure(gross.isNotNull() & ((discount < 0) | (discount > gross))),
        ),
        _not_number("B54", "line_total"),
        Gate(
            "B55", "line_total", LOGIC,
            "line_total does not match the calculated value within the allowed tolerance",
            _sure(F.abs(total - (gross - discount)) > F.lit("0.02").cast("decimal(3,2)")),
        ),
    ]


def delivery_performance_gates(_: Column) -> list[Gate]:
    cancelled = _sure(F.col("order_cancelled"))
    actual, prep, wait, travel = (
        value(c) for c in ("actual_delivery_time_min", "prep_time", "rider_wait_time", "travel_time")
    )
    return [
        _bad_id("B56", "delivery_id"),
        _bad_id("B57", "order_id"),
        _absent("B58", "order_id", "order_found"),
        Gate("B59", "order_id", CANCELLED, "The order is cancelled, so nothing was delivered", F.lit(True), cancelled),
        _not_number("B60", "expected_delivery_time_min", unless=cancelled),
        _out_of("B61", "expected_delivery_time_min", 5, 120),
        _not_number("B62", "actual_delivery_time_min", optional=True, unless=cancelled),
        _out_of("B63", "actual_delivery_time_min", 5, 180),
        _not_number("B64", "distance_km", unless=cancelled),
        _out_of("B65", "distance_km", 0, 100, above=True),
        _not_number("B66", "order_item", unless=cancelled),
        _out_of("B67", "order_item", 0, 100, above=True),
        _not_number("B68", "delivery_item", optional=True, unless=cancelled),
        _out_of("B69", "delivery_item", 0, 100),
        _not_number("B70", "prep_time", optional=True),
        _out_of("B71", "prep_time", 0, 180),
        _not_number("B72", "rider_wait_time", optional=True),
        _out_of("B73", "rider_wait_time", 0, 60),
        _not_number("B74", "travel_time", optional=True),
        _out_of("B75", "travel_time", 0, 180),
        Gate(
            "B76", "actual_delivery_time_min", LOGIC,
            "prep_time and travel_time do not add up to actual_delivery_time_min", _sure(actual != prep + travel),
        ),
        Gate("B77", "rider_wait_time", LOGIC, "rider_wait_time exceeds prep_time", _sure(wait > prep)),
    ]


def rating_gates(_: Column) -> list[Gate]:
    return [
        _bad_id("B78", "rating_id"),
        _bad_id("B79", "order_id"),
        _bad_id("B80", "customer_id"),
        _bad_id("B81", "restaurant_id"),
        _absent("B82", "order_id", "order_found"),
        _absent("B83", "customer_id", "customer_found"),
        _absent("B84", "restaurant_id", "restaurant_found"),
        _not_number("B85", "rating"),
        _out_of("B86", "rating", 1, 5),
        _not_timestamp("B87", "review_timestamp"),
        _not_number("B88", "sentiment_score"),
        _out_of("B89", "sentiment_score", -1, 1),
    ]


GATES: dict[str, Callable[[Column], list[Gate]]] = {
    "customer": customer_gates,
    "restaurant": restaurant_gates,
    "delivery_partner": delivery_partner_gates,
    "menu_item": menu_item_gates,
    "order": order_gates,
    "order_item": order_item_gates,
    "delivery_performance": delivery_performance_gates,
    "rating": rating_gates,
}

# Columns resolved against a master, and columns resolved against a typed parent table.
MASTER_COLUMNS = {
    "customer": ("city", "acquisition_channel"),
    "restaurant": ("city", "cuisine_type", "partner_type"),
    "delivery_partner": ("city", "vehicle_type", "employment_type"),
    "menu_item": ("category",),
}
PARENT_COLUMNS = {
    "menu_item": (("restaurant_id", "restaurant", "restaurant_found"),),
    "order_item": (("order_id", "order", "order_found"), ("menu_item_id", "menu_item", "menu_item_found")),
    "delivery_performance": (("order_id", "order", "order_found"),),
    "rating": (
        ("order_id", "order", "order_found"),
        ("customer_id", "customer", "customer_found"),
        ("restaurant_id", "restaurant", "restaurant_found"),
    ),
}


def _attach_parent(df: DataFrame, column: str, parent: DataFrame, found: str, with_cancelled: bool) -> DataFrame:
    """Left join on the parent's unique business key; AQE splits a hot key on the probing side. Rows are sorted by a hash
    first: ids of one kind begin with the same letters and digits."""
    keep = [F.col(column).alias(found)]
    if with_cancelled:
        keep.append(F.col("is_cancelled").alias("order_cancelled"))
    side = parent.select(*keep)
    wanted = P.key_text(column)
    return df.join(side, (F.xxhash64(wanted) == F.xxhash64(found)) & (wanted == F.col(found)), "left")


def attach_lookups(
    entity: str, raw: DataFrame, masters: Mapping[str, DataFrame], parents: Mapping[str, DataFrame]
) -> DataFrame:
    df = raw
    for column in MASTER_COLUMNS.get(entity, ()):
        df = attach_master(df, MasterMatch(column, column), masters[column])
    for column, parent, found in PARENT_COLUMNS.get(entity, ()):
        df = _attach_parent(df, column, parents[parent], found, entity == "delivery_performance")
    return df


def apply_gates(
    entity: str,
    raw: DataFrame,
    masters: Mapping[str, DataFrame] | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
    **options,
) -> DataFrame:
    """The raw rows with their lookups, the values parsed from their texts and `gate_errors`, the positions of failed gates;
    nothing is dropped. `gate_texts` holds the tested texts of rows that failed, besides those that are looked up."""
    gates = GATES[entity](as_of if as_of is not None else F.current_date(), **options)
    checked = parsed(entity, raw)
    checked = checked.select("*", _bits((i, g.fails) for i, g in enumerate(gates)).alias(FAILED))
    # Texts are kept for rows that may become error rows alone; they come out of the bits, so a lookup carries no others.
    kept = _kept_texts(entity, gates)
    if kept:
        told = sum(1 << i for i, g in enumerate(gates) if g.column in kept)
        texts = F.when(F.col(FAILED).bitwiseAND(F.lit(told).cast("long")) != 0, F.array(*[F.col(c) for c in kept]))
        checked = checked.select("*", texts.alias(TEXTS))
    checked = attach_lookups(entity, checked, masters or {}, parents or {})
    alone = F.lit(sum(1 << i for i, g in enumerate(gates) if g.found is None)).cast("long")
    looked_up = _bits((i, g.found) for i, g in enumerate(gates) if g.found is not None)
    left = checked.select("*", F.col(FAILED).bitwiseAND(alone.bitwiseOR(looked_up)).alias(LEFT))
    positions = F.filter(F.array(*[F.lit(i) for i in range(1, len(gates) + 1)]), lambda p: F.getbit(F.col(LEFT), p - 1) == 1)
    errors = F.when(F.col(LEFT) == 0, F.array().cast("array<int>")).otherwise(positions)
    return left.select("*", errors.alias("gate_errors")).drop(FAILED, LEFT)


FAILED, LEFT, TEXTS = "gate_failed", "gate_left", "gate_texts"


def _bits(conditions: Iterable[tuple[int, Column]]) -> Column:
    """A number with one bit per condition that holds."""
    bits = [F.when(c, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in conditions]
    return reduce(Column.bitwiseOR, bits, F.lit(0).cast("long"))


def _kept_texts(entity: str, gates: Iterable[Gate]) -> list[str]:
    """The columns of gates besides those that are looked up, which stay as they are."""
    looked_up = {*MASTER_COLUMNS.get(entity, ()), *(c for c, _, _ in PARENT_COLUMNS.get(entity, ()))}
    return list(dict.fromkeys(g.column for g in gates if g.column not in looked_up))


def outcome_columns(entity: str) -> list[str]:
    """What `quarantined` needs of the gated rows, and the business key: enough to tell errors and to count clean rows."""
    looked_up = (*MASTER_COLUMNS.get(entity, ()), *(c for c, _, _ in PARENT_COLUMNS.get(entity, ())))
    lineage = ("batch_id", "source_file_name", "source_row_number")
    return list(dict.fromkeys((ENTITIES[entity].key, *looked_up, *lineage, TEXTS, "gate_errors")))


def quarantined(entity: str, gated: DataFrame, at: Column | None = None) -> DataFrame:
    """One error row per failed gate.

    The outer explode keeps the optimizer from testing the array in a filter below the projection, where
    every gate would be evaluated a second time.
    """
    gates = GATES[entity](F.current_date())
    kept = _kept_texts(entity, gates)
    position = F.col("gate_position")

    def text_of(values) -> Column:
        return F.element_at(F.array(*values), position)

    def tested(column: str) -> Column:
        return F.get(TEXTS, F.lit(kept.index(column))) if column in kept else F.col(column)

    tests: dict[str, list[int]] = {}
    for i, g in enumerate(gates, start=1):
        tests.setdefault(g.column, []).append(i)
    raw_value = F.coalesce(*[F.when(position.isin(*at), tested(c)) for c, at in tests.items()])

    failed = gated.select("*", F.explode_outer("gate_errors").alias("gate_position"))
    return failed.filter(position.isNotNull()).select(
        "batch_id", "source_file_name", "source_row_number",
        F.lit(ENTITIES[entity].raw_table).alias("table_name"),
        text_of(F.lit(g.gate_id) for g in gates).alias("gate_id"),
        text_of(F.lit(g.column) for g in gates).alias("column_name"),
        text_of(F.lit(g.error_type) for g in gates).alias("error_type"),
        text_of(F.lit(g.message) for g in gates).alias("error_message"),
        F.substring(raw_value, 1, TEXT_LIMIT).alias("raw_value"),
        (at if at is not None else F.localtimestamp()).alias("error_timestamp"),
    )


def passed(gated: DataFrame) -> DataFrame:
    """Rows without any error: the quarantine key is the row itself (batch, file, row number).

    A plain filter on the array would sink below the parsing projection and parse each text once per gate.
    The filter on an exploded mark stays above it.
    """
    rows = [c for c in gated.columns if c not in ("gate_errors", TEXTS)]
    mark = F.explode_outer(F.when(F.size("gate_errors") == 0, F.array(F.lit(True))))
    return gated.select(*rows, mark.alias("clean")).filter("clean").select(*rows)
