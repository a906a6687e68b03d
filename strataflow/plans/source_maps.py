"""The given tables seen as the eight source entities, their typed tables and the control tables.

Each map is a list of plain SQL expressions over one base table. Spark runs them through `selectExpr`; the
oracle runs the very same text, so both sides of a check start from equal rows and differ only in the
operator under test. Damage (blank ids, bad dates, negative amounts) hangs on value ranges of the base rows;
no base row is left out to make a check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Part:
    base: str
    columns: dict[str, str]
    where: str | None = None


def pad(value: str, width: int) -> str:
    """Zero-padded text that grows instead of cutting when the number is wider."""
    text = f"CAST({value} AS STRING)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


def whole(value: str) -> str:
    return f"CAST(floor({value}) AS INT)"


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


CUST = f"'CUST' || {pad('c_custkey', 6)}"
REST = f"'REST' || {pad('s_suppkey', 5)}"
PARTNER = f"'DP' || {pad('s_suppkey', 5)}"
MENU = f"'MENU' || {pad('p_partkey % 100', 5)} || '_' || {pad('CAST(floor(p_partkey / 100) AS BIGINT)', 4)}"
ORDER = f"'ORD' || {pad('o_orderkey', 12)}"
ORDER_CUST = f"'CUST' || {pad('o_custkey', 6)}"
ORDER_REST = f"'REST' || {pad('o_custkey % 100', 5)}"
ORDER_PARTNER = f"'DP' || {pad('o_orderkey % 100', 5)}"
LINE_NUMBER = "(l_orderkey * 10 + l_linenumber)"
LINE = f"'ITE' || {pad(LINE_NUMBER, 15)}"
LINE_ORDER = f"'ORD' || {pad('l_orderkey', 12)}"
LINE_MENU = f"'MENU' || {pad('l_partkey % 100', 5)} || '_' || {pad('CAST(floor(l_partkey / 100) AS BIGINT)', 4)}"
LINE_ROW = f"({LINE_NUMBER} * 1000000 + l_partkey + 2)"
EVENT_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
ORDER_MONTH = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)"
SHIP_MONTH = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT)"
ORDER_MINUTE = "CAST(o_custkey % 1440 AS INT)"
DISCOUNT_CENTS = "CAST(round(l_discount * 100) AS INT)"
TAX_CENTS = "CAST(round(l_tax * 100) AS INT)"


def lineage(batch: str, file: str, row: str) -> dict[str, str]:
    return {"batch_id": f"CAST({batch} AS BIGINT)", "source_file_name": file, "source_row_number": f"CAST({row} AS BIGINT)"}


def _customer_part(file: str, channel: str, where: str | None = None) -> Part:
    day, month = pad("1 + c_custkey % 28", 2), pad("1 + c_nationkey % 12", 2)
    return Part(
        "customer",
        {
            "customer_id": f"CASE WHEN c_acctbal < -950 THEN 'C' || {text('c_custkey')} "
                           f"WHEN c_acctbal > 9000 THEN '  ' || {CUST} || ' ' ELSE {CUST} END",
            "signup_date": "CASE WHEN c_acctbal BETWEEN -950 AND -900 THEN '' "
                           "WHEN c_acctbal BETWEEN -900 AND -850 THEN '31/31/1994' "
                           f"WHEN c_mktsegment = 'HOUSEHOLD' THEN {month} || '/' || {day} || '/1994' "
                           f"WHEN c_mktsegment = 'MACHINERY' THEN {day} || '-' || {month} || '-1994' "
                           f"ELSE '1994-' || {month} || '-' || {day} END",
            "city": "CASE WHEN c_acctbal BETWEEN -850 AND -800 THEN 'ATLANTIS' "
                    f"WHEN c_acctbal > 8000 THEN 'n' || {text('c_nationkey')} "
                    f"WHEN c_acctbal > 6000 THEN ' nation_' || {text('c_nationkey')} || ' ' "
                    f"ELSE 'NATION_' || {text('c_nationkey')} END",
            "acquisition_channel": channel,
            **lineage("199501", f"'{file}'", "c_custkey + 2"),
        },
        where,
    )


RAW: dict[str, list[Part]] = {
    # The second file hands in the building segment again, under another channel: the later file wins.
    "raw_customer": [
        _customer_part(
            "customer_19950131.csv",
            "CASE WHEN c_acctbal BETWEEN -800 AND -780 THEN NULL ELSE lower(c_mktsegment) END",
        ),
        _customer_part("customer_19950228.csv", "'MACHINERY'", "c_mktsegment = 'BUILDING'"),
    ],
    "raw_restaurant": [
        Part(
            "supplier",
            {
                "restaurant_id": f"CASE WHEN s_acctbal < -900 THEN 'R' ELSE {REST} END",
                "onboard_date": "CASE WHEN s_acctbal BETWEEN 100 AND 300 THEN '12/31/2090' "
                                "WHEN s_acctbal BETWEEN 300 AND 400 THEN 'soon' "
                                f"ELSE {pad('1 + s_nationkey % 12', 2)} || '/15/1994' END",
                "restaurant_name": "CASE WHEN s_acctbal BETWEEN -500 AND 0 THEN '  ' ELSE ' ' || s_name || ' ' END",
                "city": f"CASE WHEN s_acctbal BETWEEN 500 AND 700 THEN 'ATLANTIS' ELSE 'Nation_' || {text('s_nationkey')} END",
                "cuisine_type": "CASE WHEN s_acctbal BETWEEN 700 AND 800 THEN 'Mud' WHEN s_acctbal > 5000 THEN 'asia' ELSE 'R0' END",
                "partner_type": "CASE WHEN s_acctbal BETWEEN 800 AND 900 THEN '' WHEN s_acctbal > 4000 THEN 'cloud kitchen' ELSE 'Restaurant' END",
                "avg_prep_time_min": "CASE WHEN s_acctbal < 2000 THEN '<=15' WHEN s_acctbal < 4000 THEN '16-25' "
                                     "WHEN s_acctbal < 6000 THEN '26-40' WHEN s_acctbal < 9000 THEN '>40' ELSE ' ' END",
                "is_active": "CASE WHEN s_acctbal BETWEEN 900 AND 1000 THEN '1' WHEN s_acctbal > 3000 THEN ' y' ELSE 'N' END",
                **lineage("199501", "'restaurant_19950131.csv'", "s_suppkey + 2"),
            },
        )
    ],
    "raw_delivery_partner": [
        Part(
            "supplier",
            {
                "delivery_partner_id": f"CASE WHEN s_acctbal < -900 THEN 'DP' ELSE {PARTNER} END",
                "onboard_date": "CASE WHEN s_acctbal BETWEEN 100 AND 300 THEN '2090-12-31' "
                                "WHEN s_acctbal BETWEEN 300 AND 400 THEN NULL "
                                f"ELSE '1994-' || {pad('1 + s_nationkey % 12', 2)} || '-20' END",
                "partner_name": "CASE WHEN s_acctbal > 9000 THEN '' ELSE s_name END",
                "city": f"CASE WHEN s_acctbal BETWEEN 500 AND 700 THEN 'ATLANTIS' ELSE 'N' || {text('s_nationkey')} END",
                "vehicle_type": "CASE WHEN s_acctbal BETWEEN 700 AND 800 THEN 'Sled' WHEN s_acctbal > 5000 THEN 'ev bike' ELSE 'Electric Scooter' END",
                "employment_type": "CASE WHEN s_acctbal BETWEEN 800 AND 900 THEN 'Never' WHEN s_acctbal > 5000 THEN 'full-time' ELSE 'CONTRACT' END",
                "avg_rating": "CASE WHEN s_acctbal < 0 THEN '' WHEN s_acctbal BETWEEN 1000 AND 1200 THEN 'good' "
                              "WHEN s_acctbal BETWEEN 1200 AND 1400 THEN '5.5' "
                              f"ELSE {text(whole('s_acctbal / 2000'))} || '.' || {pad('s_suppkey % 100', 2)} END",
                "is_active": "CASE WHEN s_acctbal BETWEEN 900 AND 1000 THEN NULL WHEN s_acctbal > 3000 THEN 'Y' ELSE 'n ' END",
                **lineage("199501", "'delivery_partner_19950131.csv'", "s_suppkey + 2"),
            },
        )
    ],
    "raw_menu_item": [
        Part(
            "part",
            {
                "menu_item_id": f"CASE WHEN p_size = 50 THEN 'MENU' ELSE {MENU} END",
                "restaurant_id": f"CASE WHEN p_size = 49 THEN '' ELSE 'REST' || {pad('p_partkey % 100', 5)} END",
                "item_name": "CASE WHEN p_size = 48 THEN ' ' ELSE p_name || ' ' END",
                "category": "CASE WHEN p_size = 47 THEN 'Stones' ELSE lower(p_type) END",
                "is_veg": "CASE WHEN p_size = 46 THEN 'maybe' WHEN p_size > 20 THEN 'y' ELSE 'N' END",
                "price": f"CASE WHEN p_size = 45 THEN 'free' WHEN p_size = 44 THEN '-1.00' WHEN p_size = 43 THEN '' "
                         f"ELSE ' ' || {text(money('p_retailprice'))} END",
                **lineage("199501", "'menu_item_19950131.csv'", "p_partkey + 2"),
            },
        )
    ],
    "raw_order": [
        Part(
            "orders",
            {
                "order_id": f"CASE WHEN o_totalprice > 498000 THEN 'ORDER-' || {text('o_orderkey')} ELSE {ORDER} END",
                "customer_id": f"CASE WHEN o_totalprice BETWEEN 496000 AND 498000 THEN 'GUEST' ELSE ' ' || {ORDER_CUST} END",
                "restaurant_id": f"CASE WHEN o_totalprice BETWEEN 494000 AND 496000 THEN '' ELSE {ORDER_REST} END",
                "delivery_partner_id": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' ' "
                                       f"WHEN o_totalprice BETWEEN 492000 AND 494000 THEN 'DPX' ELSE {ORDER_PARTNER} END",
                "order_timestamp": "CASE WHEN o_totalprice BETWEEN 490000 AND 492000 THEN 'yesterday' "
                                   f"ELSE {text('CAST(o_orderdate AS DATE)')} || ' ' || {pad(whole(ORDER_MINUTE + ' / 60'), 2)} "
                                   f"|| ':' || {pad(ORDER_MINUTE + ' % 60', 2)} || ':00' END",
                "subtotal_amount": "CASE WHEN o_totalprice BETWEEN 488000 AND 490000 THEN 'n/a' "
                                   "WHEN o_totalprice BETWEEN 486000 AND 488000 THEN '-5' "
                                   f"ELSE {text(money('o_totalprice'))} END",
                "discount_amount": "CASE WHEN o_totalprice BETWEEN 484000 AND 486000 THEN 'ten' "
                                   "WHEN o_totalprice BETWEEN 482000 AND 484000 THEN '-10.00' "
                                   "WHEN o_orderpriority = '1-URGENT' THEN '' ELSE '10.005' END",
                "delivery_fee": "CASE WHEN o_totalprice BETWEEN 480000 AND 482000 THEN '1e2' "
                                "WHEN o_totalprice BETWEEN 478000 AND 480000 THEN '-0.01' "
                                "WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE '5' END",
                "total_amount": "CASE WHEN o_totalprice BETWEEN 476000 AND 478000 THEN '' "
                                "WHEN o_totalprice BETWEEN 474000 AND 476000 THEN '-1' "
                                f"ELSE {text(money('o_totalprice'))} END",
                "is_cod": "CASE WHEN o_totalprice BETWEEN 472000 AND 474000 THEN 'yes' WHEN o_orderstatus = 'P' THEN ' y ' ELSE 'N' END",
                "is_cancelled": "CASE WHEN o_totalprice BETWEEN 470000 AND 472000 THEN NULL "
                                "WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Y' ELSE 'n' END",
                **lineage(ORDER_MONTH, f"'order_' || {text(ORDER_MONTH)} || '28.csv'", "o_orderkey + 2"),
            },
        )
    ],
    "raw_order_item": [
        Part(
            "lineitem",
            {
                "order_item_id": f"CASE WHEN l_tax = 0.08 AND l_quantity = 49 THEN 'ITE-7' ELSE {LINE} END",
                "order_id": f"CASE WHEN l_tax = 0.08 AND l_quantity = 50 THEN 'ORD12' ELSE ' ' || {LINE_ORDER} END",
                "menu_item_id": f"CASE WHEN l_tax = 0.08 AND l_quantity = 48 THEN 'MENU00001-0001' ELSE {LINE_MENU} END",
                "restaurant_id": f"'REST' || {pad('l_suppkey', 5)}",
                "quantity": "CASE WHEN l_tax = 0.07 AND l_quantity = 1 THEN '0' WHEN l_tax = 0.07 AND l_quantity = 2 THEN 'two' "
                            f"WHEN l_tax = 0.07 AND l_quantity = 3 THEN '3.0' ELSE {text('CAST(l_quantity AS INT)')} END",
                "unit_price": "CASE WHEN l_tax = 0.06 AND l_quantity = 1 THEN '-3' WHEN l_tax = 0.06 AND l_quantity = 2 THEN '' "
                              f"ELSE {text(money('l_extendedprice'))} END",
                "item_discount": "CASE WHEN l_tax = 0.05 AND l_quantity = 1 THEN '-1' WHEN l_tax = 0.05 AND l_quantity = 2 THEN '99999999' "
                                 f"WHEN l_tax = 0.05 AND l_quantity = 3 THEN 'x' ELSE {text(DISCOUNT_CENTS)} || '.00' END",
                "line_total": "CASE WHEN l_tax = 0.04 AND l_quantity = 1 THEN '' WHEN l_tax = 0.04 AND l_quantity = 2 THEN '1.00' ELSE "
                              + text(money(f"CAST(l_quantity AS INT) * {money('l_extendedprice')} - {money(DISCOUNT_CENTS)}"))
                              + " END",
                **lineage(SHIP_MONTH, f"'order_item_' || {text(SHIP_MONTH)} || '28.csv'", LINE_ROW),
            },
        )
    ],
    "raw_delivery_performance": [
        Part(
            "lineitem",
            {
                "delivery_id": f"CASE WHEN l_quantity = 50 AND l_tax = 0 THEN 'DEL' ELSE 'DEL' || {pad(LINE_NUMBER, 12)} END",
                "order_id": f"CASE WHEN l_quantity = 49 AND l_tax = 0 THEN '' ELSE {LINE_ORDER} END",
                "prep_time": "CASE WHEN l_quantity = 48 AND l_tax = 0 THEN 'long' WHEN l_quantity = 47 AND l_tax = 0 THEN '200' "
                             f"ELSE {text('CAST(l_quantity AS INT)')} || '.4' END",
                "rider_wait_time": "CASE WHEN l_quantity = 46 AND l_tax = 0 THEN '?' WHEN l_quantity = 45 AND l_tax = 0 THEN '61' "
                                   f"ELSE {text(TAX_CENTS)} END",
                "travel_time": "CASE WHEN l_quantity = 44 AND l_tax = 0 THEN '..' WHEN l_quantity = 43 AND l_tax = 0 THEN '181' "
                               f"ELSE {text(DISCOUNT_CENTS + ' * 5')} END",
                "order_item": "CASE WHEN l_quantity = 42 AND l_tax = 0 THEN '' WHEN l_quantity = 41 AND l_tax = 0 THEN '0' "
                              f"ELSE {text('CAST(l_quantity AS INT)')} END",
                "expected_delivery_time_min": "CASE WHEN l_quantity = 40 AND l_tax = 0 THEN NULL WHEN l_quantity = 39 AND l_tax = 0 THEN '4' "
                                              f"ELSE {text('20 + ' + TAX_CENTS + ' * 5')} END",
                "actual_delivery_time_min": "CASE WHEN l_quantity = 38 AND l_tax = 0 THEN 'now' WHEN l_quantity = 37 AND l_tax = 0 THEN '4' "
                                            "WHEN l_quantity = 36 AND l_tax = 0 THEN '' "
                                            f"ELSE {text('CAST(l_quantity AS INT) + ' + DISCOUNT_CENTS + ' * 5')} END",
                "delivery_item": "CASE WHEN l_quantity = 35 AND l_tax = 0 THEN 'all' WHEN l_quantity = 34 AND l_tax = 0 THEN '101' "
                                 "WHEN l_quantity = 33 AND l_tax = 0 THEN '' "
                                 f"ELSE {text('CAST(l_quantity AS INT)')} END",
                "distance_km": "CASE WHEN l_quantity = 32 AND l_tax = 0 THEN '' WHEN l_quantity = 31 AND l_tax = 0 THEN '100.01' "
                               f"ELSE {text(TAX_CENTS)} || '.' || {pad('l_suppkey % 100', 2)} END",
                **lineage(SHIP_MONTH, f"'delivery_performance_' || {text(SHIP_MONTH)} || '28.csv'", LINE_ROW),
            },
        )
    ],
    "raw_rating": [
        Part(
            "events",
            {
                "rating_id": f"CASE WHEN value > 300 THEN 'RAT' ELSE 'RAT' || {pad('event_id', 12)} END",
                "order_id": f"CASE WHEN value BETWEEN 280 AND 300 THEN 'ORD' ELSE 'ORD' || {pad('event_id', 12)} END",
                "customer_id": f"CASE WHEN value BETWEEN 260 AND 280 THEN '' ELSE 'CUST' || {pad('user_id', 6)} END",
                "restaurant_id": f"CASE WHEN value BETWEEN 240 AND 260 THEN 'R1' ELSE 'REST' || {pad('user_id % 100', 5)} END",
                "rating": "CASE WHEN value BETWEEN 220 AND 240 THEN 'great' WHEN value BETWEEN 200 AND 220 THEN '0.50' "
                          "WHEN value BETWEEN 190 AND 200 THEN '10' "
                          f"ELSE {text(f'1 + CAST(floor({EVENT_K} / 25) AS INT)')} || '.' || {pad(f'({EVENT_K} % 25) * 4', 2)} END",
                "review_text": "CASE event_type WHEN 'view' THEN ' Great taste! ' WHEN 'click' THEN 'Tasty but a bit late' "
                               "WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE 'Crisp number ' || props END",
                "review_timestamp": "CASE WHEN value BETWEEN 180 AND 190 THEN 'today' WHEN value BETWEEN 170 AND 180 THEN '' "
                                    f"ELSE {text('CAST(ts AS DATE)')} || 'T10:30:00' END",
                "sentiment_score": "CASE WHEN value BETWEEN 160 AND 170 THEN '' WHEN value BETWEEN 150 AND 160 THEN '1.5' "
                                   f"ELSE (CASE WHEN {EVENT_K} < 50 THEN '-0.' ELSE '0.' END) || {pad(f'abs({EVENT_K} * 2 - 99)', 2)} END",
                **lineage("202401", "'rating_20240131.csv'", "event_id + 2"),
            },
        )
    ],
}

# Typed tables, one row per business key. Cancelled: finished urgent orders. Open orders have no partner when
# none is specified.
CANCELLED = "(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"
ODS: dict[str, list[Part]] = {
    "ods_customer": [
        Part(
            "customer",
            {
                "customer_id": CUST,
                "signup_date": "CAST(DATE '1994-01-01' + CAST(c_custkey % 730 AS INT) AS DATE)",
                "city": f"'NATION_' || {text('c_nationkey')}",
                "acquisition_channel": "c_mktsegment",
                **lineage("199501", "'customer_19950131.csv'", "c_custkey + 2"),
            },
        )
    ],
    "ods_restaurant": [
        Part(
            "supplier",
            {
                "restaurant_id": REST,
                "onboard_date": "CAST(DATE '1994-06-01' + CAST(s_suppkey % 365 AS INT) AS DATE)",
                "restaurant_name": "s_name",
                "city": f"'NATION_' || {text('s_nationkey')}",
                "cuisine_type": "CASE WHEN s_acctbal > 5000 THEN 'Pizza' ELSE 'Goan' END",
                "partner_type": "CASE WHEN s_acctbal > 3000 THEN 'Restaurant' ELSE 'Home Chef' END",
                "avg_prep_time_min": "CASE WHEN s_acctbal < 2000 THEN '<=15' WHEN s_acctbal < 4000 THEN '16-25' "
                                     "WHEN s_acctbal < 6000 THEN '26-40' WHEN s_acctbal < 8000 THEN '>40' ELSE NULL END",
                "is_active": "s_acctbal > 0",
                **lineage("199501", "'restaurant_19950131.csv'", "s_suppkey + 2"),
            },
        )
    ],
    "ods_delivery_partner": [
        Part(
            "supplier",
            {
                "delivery_partner_id": PARTNER,
                "onboard_date": "CAST(DATE '1994-09-01' + CAST(s_suppkey % 365 AS INT) AS DATE)",
                "partner_name": "s_name",
                "city": f"'NATION_' || {text('s_nationkey')}",
                "vehicle_type": "CASE WHEN s_acctbal > 5000 THEN 'Bike' ELSE 'Car' END",
                "employment_type": "CASE WHEN s_acctbal > 7000 THEN 'Contract' ELSE 'Full-Time' END",
                "avg_rating": "CASE WHEN s_acctbal < 0 THEN CAST(NULL AS DECIMAL(5,2)) ELSE "
                              f"CAST({text(whole('s_acctbal / 2000'))} || '.' || {pad('s_suppkey % 100', 2)} AS DECIMAL(5,2)) END",
                "is_active": "s_acctbal > 0",
                **lineage("199501", "'delivery_partner_19950131.csv'", "s_suppkey + 2"),
            },
        )
    ],
    "ods_menu_item": [
        Part(
            "part",
            {
                "menu_item_id": MENU,
                "restaurant_id": f"'REST' || {pad('p_partkey % 100', 5)}",
                "item_name": "p_name",
                "category": "p_type",
                "is_veg": "p_size > 20",
                "price": money("p_retailprice"),
                **lineage("199501", "'menu_item_19950131.csv'", "p_partkey + 2"),
            },
        )
    ],
    "ods_order": [
        Part(
            "orders",
            {
                "order_id": ORDER,
                "customer_id": ORDER_CUST,
                "restaurant_id": ORDER_REST,
                "delivery_partner_id": f"CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE {ORDER_PARTNER} END",
                "order_timestamp": f"o_orderdate + {ORDER_MINUTE} * INTERVAL '1' MINUTE",
                "subtotal_amount": money("o_totalprice"),
                "discount_amount": f"CASE WHEN o_orderpriority = '1-URGENT' THEN {money('0')} "
                                   f"WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS DECIMAL(18,2)) ELSE {money('12.5')} END",
                "delivery_fee": f"CASE WHEN o_orderstatus = 'O' THEN {money('4.75')} ELSE {money('0')} END",
                "total_amount": f"CASE WHEN o_orderpriority = '2-HIGH' THEN {money('o_totalprice')} "
                                f"WHEN o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'O' THEN {money('o_totalprice')} "
                                f"ELSE CAST({money('o_totalprice')} - {money('12.5')} AS DECIMAL(18,2)) END",
                "is_cod": "o_orderstatus = 'P'",
                "is_cancelled": CANCELLED,
                **lineage(ORDER_MONTH, f"'order_' || {text(ORDER_MONTH)} || '28.csv'", "o_orderkey + 2"),
            },
        )
    ],
    # Several lines may share a number; as in a clean table, only the newest row of a key is kept: see `lines`.
    "ods_delivery_performance": [
        Part(
            "orders",
            {
                "delivery_id": f"'DEL' || {pad('o_orderkey', 12)}",
                "order_id": ORDER,
                "prep_time": "CAST(5 + o_custkey % 70 AS INT)",
                "rider_wait_time": "CAST(o_custkey % 5 AS INT)",
                "travel_time": "CAST(o_orderkey % 60 AS INT)",
                "order_item": "CAST(1 + o_custkey % 9 AS INT)",
                "expected_delivery_time_min": "CAST(20 + o_orderkey % 45 AS INT)",
                "actual_delivery_time_min": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN CAST(NULL AS INT) "
                                            "ELSE CAST(5 + o_custkey % 70 + o_orderkey % 60 AS INT) END",
                "delivery_item": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN CAST(o_custkey % 9 AS INT) "
                                 "ELSE CAST(1 + o_custkey % 9 AS INT) END",
                "distance_km": "CAST(CAST(o_orderkey % 12 AS DECIMAL(10,2)) + CAST(o_custkey % 2 AS DECIMAL(10,2)) * CAST(0.25 AS DECIMAL(10,2)) AS DECIMAL(10,2))",
                **lineage(ORDER_MONTH, f"'delivery_performance_' || {text(ORDER_MONTH)} || '28.csv'", "o_orderkey + 2"),
            },
            f"NOT {CANCELLED}",
        )
    ],
    "ods_rating": [
        Part(
            "events",
            {
                "rating_id": f"'RAT' || {pad('event_id', 12)}",
                "order_id": f"CASE WHEN event_type = 'error' THEN 'ORD999999999999' ELSE 'ORD' || {pad('event_id', 12)} END",
                "customer_id": f"'CUST' || {pad('user_id', 6)}",
                "restaurant_id": f"'REST' || {pad('user_id % 200', 5)}",
                "rating": f"CAST(CAST(1 + floor({EVENT_K} / 25) AS DECIMAL(3,2)) + CAST({EVENT_K} % 25 AS DECIMAL(4,2)) * CAST(0.04 AS DECIMAL(3,2)) AS DECIMAL(3,2))",
                "review_text": "CASE event_type WHEN 'view' THEN 'Great taste!' WHEN 'click' THEN 'Tasty but a bit late' "
                               "WHEN 'purchase' THEN 'Crisp number ' || props ELSE NULL END",
                "review_timestamp": "ts",
                "sentiment_score": f"CAST(CAST({EVENT_K} * 2 - 99 AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,4))",
                **lineage("202401", "'rating_20240131.csv'", "event_id + 2"),
            },
        )
    ],
}

# Order lines before the last-row-per-key rule (a given line number can occur more than once).
LINES: dict[str, list[Part]] = {
    "lines": [
        Part(
            "lineitem",
            {
                "order_item_id": LINE,
                "order_id": LINE_ORDER,
                "menu_item_id": LINE_MENU,
                "quantity": "CAST(l_quantity AS INT)",
                "unit_price": money("l_extendedprice"),
                "item_discount": money(DISCOUNT_CENTS),
                "line_total": money(f"CAST(l_quantity AS INT) * {money('l_extendedprice')} - {money(DISCOUNT_CENTS)}"),
                **lineage(SHIP_MONTH, f"'order_item_' || {text(SHIP_MONTH)} || '28.csv'", LINE_ROW),
            },
        )
    ]
}

MASTERS: dict[str, list[Part]] = {
    "city": [Part("nation", {"code": f"'N' || {text('n_nationkey')}", "name": "n_name", "is_active": "n_nationkey <> 24"})],
    "acquisition_channel": [
        Part("customer", {"code": "substring(c_mktsegment, 1, 4)", "name": "c_mktsegment", "is_active": "c_mktsegment <> 'FURNITURE'"})
    ],
    "cuisine_type": [Part("region", {"code": f"'R' || {text('r_regionkey')}", "name": "r_name", "is_active": "r_regionkey < 4"})],
    "category": [Part("part", {"code": "substring(p_type, 1, 3)", "name": "p_type", "is_active": "p_type <> 'PROMO'"})],
}

# Control tables. Batches are months of orders; steps are single orders, errors returned lines, warnings all
# other lines, dimension changes single events.
CONTROL: dict[str, list[Part]] = {
    "etl_log": [
        Part(
            "orders",
            {
                "log_id": "o_orderkey",
                "batch_id": ORDER_MONTH,
                "process_name": "CASE o_orderpriority WHEN '1-URGENT' THEN 'STG_TO_RAW' WHEN '2-HIGH' THEN 'RAW_TO_ODS' "
                                "WHEN '3-MEDIUM' THEN 'ODS_TO_DWH' WHEN '4-NOT SPECIFIED' THEN 'DWH_RECONCILIATION' ELSE 'DWH_DIM_ENRICHMENT' END",
                "step_name": "'LOAD_' || substring(o_orderpriority, 3, 10) || '_' || o_orderstatus",
                "start_time": f"o_orderdate + {ORDER_MINUTE} * INTERVAL '1' MINUTE",
                "end_time": f"CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_orderdate + ({ORDER_MINUTE} * 60 + CAST(o_orderkey % 9 AS INT)) * INTERVAL '1' SECOND END",
                "status": "CASE WHEN o_totalprice > 490000 THEN 'FAILED' WHEN o_totalprice > 450000 THEN 'PARTIAL' "
                          "WHEN o_totalprice > 440000 THEN 'RUNNING' ELSE 'SUCCESS' END",
                "rows_processed": "CAST(floor(o_totalprice / 10) AS BIGINT)",
                "rows_inserted": "CAST(floor(o_totalprice / 10) AS BIGINT) - o_custkey % 50",
                "rows_rejected": "o_custkey % 50",
                "message": "o_orderpriority",
            },
        )
    ],
    "etl_error": [
        Part(
            "lineitem",
            {
                "error_id": LINE_ROW,
                "batch_id": SHIP_MONTH,
                "source_file_name": f"CASE WHEN l_quantity = 50 THEN NULL ELSE 'file_' || {text(SHIP_MONTH)} || '28.csv' END",
                "source_row_number": "CAST(l_orderkey + 2 AS BIGINT)",
                "table_name": "CASE l_linenumber WHEN 1 THEN 'raw_customer' WHEN 2 THEN 'raw_restaurant' WHEN 3 THEN 'raw_order_item' "
                              "WHEN 4 THEN 'raw_order' WHEN 5 THEN 'raw_delivery_performance' WHEN 6 THEN 'raw_rating' ELSE NULL END",
                "column_name": "CASE WHEN l_tax = 0 THEN NULL ELSE 'column_' || " + text(TAX_CENTS) + " END",
                "error_type": f"CASE {DISCOUNT_CENTS} WHEN 0 THEN 'MASTER_DATA_NOT_FOUND' WHEN 1 THEN 'INVALID_FORMAT' WHEN 2 THEN 'UNEXPECTED_NULL' "
                              "WHEN 3 THEN 'DUPLICATE_KEY' WHEN 4 THEN 'FILE_VALIDATION_ERROR' WHEN 5 THEN 'EXCLUDED_ORDER_CANCELLED' ELSE 'INVALID_RANGE' END",
                "error_message": "CASE WHEN l_quantity = 49 THEN NULL WHEN l_quantity = 48 THEN '' ELSE l_linestatus || ' row' END",
                "raw_value": f"CASE WHEN l_quantity = 47 THEN '' ELSE {text('l_partkey')} END",
                "error_timestamp": "l_shipdate",
            },
            "l_returnflag = 'R'",
        )
    ],
    "etl_warning": [
        Part(
            "lineitem",
            {
                "warning_id": LINE_ROW,
                "batch_id": SHIP_MONTH,
                "step_name": "'LOAD_ODS_ORDER'",
                "table_name": "CASE WHEN l_quantity = 50 THEN NULL ELSE 'ods_order' END",
                "order_id": LINE_ORDER,
                "entity_name": "CASE l_linenumber WHEN 1 THEN 'CUSTOMER' WHEN 2 THEN 'RESTAURANT' WHEN 3 THEN 'DELIVERY_PARTNER' "
                               "WHEN 4 THEN 'ORDER' WHEN 5 THEN 'FINANCIAL_INTEGRITY' WHEN 6 THEN 'ORDER_ITEM' ELSE NULL END",
                "entity_id": text("l_suppkey"),
                "warning_type": "CASE l_linenumber WHEN 1 THEN 'ORPHAN_CUSTOMER_DETECTED' WHEN 2 THEN 'ORPHAN_RESTAURANT_DETECTED' "
                                "WHEN 3 THEN 'ORPHAN_DELIVERY_PARTNER_DETECTED' WHEN 4 THEN 'HIGH_VALUE_ORDER' ELSE 'TOTAL_AMOUNT_MISMATCH' END",
                "warning_message": "CASE WHEN l_quantity = 1 THEN NULL ELSE 'line ' || " + text("l_linenumber") + " END",
                "warning_timestamp": "l_shipdate",
            },
            "l_returnflag <> 'R'",
        )
    ],
    "dim_change_log": [
        Part(
            "events",
            {
                "batch_id": f"CAST(199501 + {EVENT_K} % 12 AS BIGINT)",
                "dimension_name": "CASE event_type WHEN 'view' THEN 'dim_customer' WHEN 'click' THEN 'dim_restaurant' ELSE 'dim_delivery_partner' END",
                "business_id": text("user_id"),
                "surrogate_key_old": "user_id",
                "surrogate_key_new": "user_id + 1000",
                "change_type": "'SCD2_VERSION'",
                "column_name": "CASE WHEN value > 50 THEN 'city' ELSE 'is_active' END",
                "old_value": text("event_id"),
                "new_value": "event_type",
                "effective_date": "CAST(ts AS DATE)",
            },
        )
    ],
}

# Dimensions before a batch: single versions, ids with history, and rows the batch does not mention.
# Machinery customers moved before; where the nation is high their current version starts on the effective day,
# so a change corrects it in place. Customers who signed up late are unknown yet.
EFFECTIVE = "1997-01-01"
BATCH = "199701"
LATE_SIGNUP = "c_custkey % 730 >= 600"
SIGNUP = "CAST(DATE '1994-01-01' + CAST(c_custkey % 730 AS INT) AS DATE)"
MOVED = "c_mktsegment = 'MACHINERY'"
OPEN = "DATE '9999-12-31'"


def _dim_customer(key: str, city: str, valid_from: str, valid_to: str, current: str, where: str) -> Part:
    return Part(
        "customer",
        {
            "customer_key": f"CAST({key} AS BIGINT)",
            "customer_id": CUST,
            "city": city,
            "signup_date": SIGNUP,
            "acquisition_channel": "c_mktsegment",
            "last_active": f"CASE WHEN c_nationkey < 5 THEN {SIGNUP} ELSE CAST(DATE '1996-03-01' + CAST(c_custkey % 300 AS INT) AS DATE) END",
            "life_cycle_id": "CASE WHEN c_nationkey < 5 THEN 0 WHEN c_nationkey < 15 THEN 2 ELSE 3 END",
            "valid_from": f"CAST({valid_from} AS DATE)",
            "valid_to": f"CAST({valid_to} AS DATE)",
            "is_current": current,
            "batch_id": "CAST(199601 AS BIGINT)",
        },
        where,
    )


def _dim_supplier(name: str, key: str, city: str, valid_from: str, valid_to: str, current: str, where: str) -> Part:
    start = "1994-06-01" if name == "restaurant" else "1994-09-01"
    onboard = f"CAST(DATE '{start}' + CAST(s_suppkey % 365 AS INT) AS DATE)"
    tail = {
        "last_active": onboard,
        "life_cycle_id": "CASE WHEN s_nationkey < 12 THEN 0 ELSE 2 END",
        "valid_from": f"CAST({valid_from} AS DATE)",
        "valid_to": f"CAST({valid_to} AS DATE)",
        "is_current": current,
        "batch_id": "CAST(199601 AS BIGINT)",
    }
    typed = ODS[f"ods_{name}"][0].columns
    if name == "restaurant":
        band = typed["avg_prep_time_min"]

        def prep(values: tuple, kind: str) -> str:
            names = ("<=15", "16-25", "26-40", ">40")
            return f"CAST(CASE ({band}) " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in zip(names, values)) + f" END AS {kind})"

        columns = {
            "restaurant_key": f"CAST({key} AS BIGINT)", "restaurant_id": REST, "restaurant_name": "s_name",
            "city": city, "cuisine_type": typed["cuisine_type"], "partner_type": typed["partner_type"],
            "is_active": typed["is_active"], "onboard_date": onboard, "avg_prep_time_min": band,
            "min_prep_min": prep((0, 16, 26, 41), "INT"), "max_prep_min": prep((15, 25, 40, 60), "INT"),
            "prep_time_group": prep(("'Fast'", "'Moderate'", "'Slow'", "'Very Slow'"), "STRING"),
            "prep_time_index": prep((1, 2, 3, 4), "INT"),
        }
    else:
        score = typed["avg_rating"]

        def rating(kind: str, *values) -> str:
            steps = (("4.60", "5.00"), ("4.00", "4.59"), ("3.00", "3.99"), ("2.00", "2.99"), ("1.00", "1.99"))
            return "CAST(CASE " + " ".join(
                f"WHEN ({score}) BETWEEN {a} AND {b} THEN {v}" for (a, b), v in zip(steps, values)
            ) + f" END AS {kind})"

        columns = {
            "delivery_partner_key": f"CAST({key} AS BIGINT)", "delivery_partner_id": PARTNER, "partner_name": "s_name",
            "city": city, "vehicle_type": typed["vehicle_type"], "employment_type": typed["employment_type"],
            "is_active": typed["is_active"], "onboard_date": onboard, "avg_rating": score,
            "rating_type_id": rating("INT", 1, 2, 3, 4, 5),
            "rating_type": rating("STRING", "'Excellent'", "'Good'", "'Average'", "'Poor'", "'Very Bad'"),
        }
    return Part("supplier", {**columns, **tail}, where)


NATION = f"'NATION_' || {text('c_nationkey')}"
S_NATION = f"'NATION_' || {text('s_nationkey')}"
S_MOVED = "s_acctbal > 6000"
S_LATE = "s_acctbal < 0"


def _supplier_versions(name: str) -> list[Part]:
    start = "1994-06-01" if name == "restaurant" else "1994-09-01"
    onboard = f"DATE '{start}' + CAST(s_suppkey % 365 AS INT)"
    return [
        _dim_supplier(name, "s_suppkey + 1", S_NATION, onboard, OPEN, "true", f"NOT {S_LATE} AND NOT {S_MOVED}"),
        _dim_supplier(name, "s_suppkey + 1", "'ELSEWHERE'", onboard, "DATE '1996-06-30'", "false", S_MOVED),
        _dim_supplier(
            name, "s_suppkey + 1 + 1000000000000", S_NATION,
            f"CASE WHEN s_nationkey > 12 THEN DATE '{EFFECTIVE}' ELSE DATE '1996-07-01' END", OPEN, "true", S_MOVED,
        ),
    ]


DIMENSIONS: dict[str, list[Part]] = {
    "dim_customer": [
        _dim_customer("c_custkey + 1", NATION, SIGNUP, OPEN, "true", f"NOT ({LATE_SIGNUP}) AND NOT {MOVED}"),
        _dim_customer("c_custkey + 1", "'ELSEWHERE'", SIGNUP, "DATE '1996-06-30'", "false", f"NOT ({LATE_SIGNUP}) AND {MOVED}"),
        _dim_customer(
            "c_custkey + 1 + 1000000000000", NATION,
            f"CASE WHEN c_nationkey > 12 THEN DATE '{EFFECTIVE}' ELSE DATE '1996-07-01' END", OPEN, "true",
            f"NOT ({LATE_SIGNUP}) AND {MOVED}",
        ),
    ],
    "dim_restaurant": _supplier_versions("restaurant"),
    "dim_delivery_partner": _supplier_versions("delivery_partner"),
    "dim_menu_item": [
        Part(
            "part",
            {
                "menu_item_key": "CAST(p_partkey + 1 AS BIGINT)",
                "menu_item_id": MENU,
                "restaurant_key": "CAST(CASE WHEN p_size > 40 THEN -1 ELSE p_partkey % 100 + 1 END AS BIGINT)",
                "item_name": "CASE WHEN p_size > 30 THEN NULL ELSE p_name END",
                "category": "p_type",
                "is_veg": "p_size > 20",
                "price": money("p_retailprice"),
                "batch_id": "CAST(199601 AS BIGINT)",
            },
            "p_brand <> 'Brand#2'",
        )
    ],
}


def _changed(name: str, **changes: str) -> list[Part]:
    """The typed table as the next batch delivers it: some columns hold new values."""
    part = ODS[name][0]
    return [Part(part.base, {**part.columns, **changes, "batch_id": f"CAST({BATCH} AS BIGINT)"}, part.where)]


# The next delivery of every entity, for upserts and dimension loads.
NEXT: dict[str, list[Part]] = {
    "next_customer": _changed(
        "ods_customer",
        city=f"CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'MOVED' WHEN c_acctbal > 9000 THEN NULL ELSE {NATION} END",
        acquisition_channel="CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'REFERRAL' ELSE c_mktsegment END",
    ),
    "next_restaurant": _changed(
        "ods_restaurant",
        city=f"CASE WHEN s_acctbal > 5000 THEN 'MOVED' ELSE {S_NATION} END",
        restaurant_name="CASE WHEN s_acctbal BETWEEN 3000 AND 5500 THEN 'New ' || s_name ELSE s_name END",
        is_active="s_acctbal > 1000",
        avg_prep_time_min="CASE WHEN s_nationkey = 3 THEN '>40' WHEN s_acctbal < 2000 THEN '<=15' WHEN s_acctbal < 8000 THEN '16-25' ELSE NULL END",
    ),
    "next_delivery_partner": _changed(
        "ods_delivery_partner",
        city=f"CASE WHEN s_acctbal > 7000 THEN 'MOVED' ELSE {S_NATION} END",
        vehicle_type="CASE WHEN s_acctbal > 4000 THEN 'Bike' ELSE 'Car' END",
        avg_rating="CASE WHEN s_acctbal BETWEEN 1000 AND 3000 THEN CAST(4.75 AS DECIMAL(5,2)) ELSE "
                   f"{ODS['ods_delivery_partner'][0].columns['avg_rating']} END",
    ),
    "next_menu_item": _changed(
        "ods_menu_item",
        price=f"CASE WHEN p_size < 5 THEN {money('99.5')} ELSE {money('p_retailprice')} END",
        item_name="CASE WHEN p_size = 7 THEN NULL ELSE p_name END",
    ),
    "next_order": _changed(
        "ods_order",
        delivery_fee=f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {money('0')} END",
        is_cancelled=f"{CANCELLED} OR o_totalprice < 3000",
    ),
    "next_delivery_performance": _changed(
        "ods_delivery_performance", travel_time="CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderkey % 60 AS INT) END",
    ),
    "next_rating": _changed(
        "ods_rating", review_text="CASE event_type WHEN 'view' THEN 'Great taste!' WHEN 'click' THEN NULL ELSE 'Crisp number ' || props END",
    ),
}

# What was known before: late sign-ups, late orders and recent events had not arrived.
BEFORE: dict[str, list[Part]] = {
    name.replace("ods_", "before_"): [Part(ODS[name][0].base, ODS[name][0].columns, where)]
    for name, where in {
        "ods_customer": f"NOT ({LATE_SIGNUP})",
        "ods_restaurant": f"NOT {S_LATE}",
        "ods_delivery_partner": f"NOT {S_LATE}",
        "ods_menu_item": "p_brand <> 'Brand#2'",
        "ods_order": "o_orderdate < DATE '2000-01-01'",
        "ods_delivery_performance": f"NOT {CANCELLED} AND o_orderdate < DATE '2000-01-01'",
        "ods_rating": "ts < DATE '2024-01-20'",
    }.items()
}

ALL: dict[str, list[Part]] = {
    **RAW, **ODS, **LINES, **CONTROL, **DIMENSIONS, **NEXT, **BEFORE,
    **{f"master_{n}": p for n, p in MASTERS.items()},
}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once; later reads need no footer job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def rows(table_of: Callable[[str], DataFrame], name: str) -> DataFrame:
    """A mapped table as a DataFrame over the given tables."""
    out = None
    for part in ALL[name]:
        df = table_of(part.base)
        if part.where:
            df = df.filter(part.where)
        df = df.selectExpr(*[f"{e} AS {n}" for n, e in part.columns.items()])
        out = df if out is None else out.unionByName(df)
    return out.distinct() if name in ("master_acquisition_channel", "master_category") else out


def sql(name: str) -> str:
    """The same mapped table as a SELECT."""
    distinct = "DISTINCT " if name in ("master_acquisition_channel", "master_category") else ""
    return " UNION ALL ".join(
        f"SELECT {distinct}" + ", ".join(f"{e} AS {n}" for n, e in p.columns.items())
        + f" FROM {p.base}" + (f" WHERE {p.where}" if p.where else "")
        for p in ALL[name]
    )
