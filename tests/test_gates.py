"""One passing row and one failing row per gate, the quarantine key, and the last row per key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow.operators import clean, gates, lookups
from strataflow.plans import queries_quality as Q
from strataflow.plans.registry import Source
from strataflow.spec import ENTITIES

GOOD = {
    "customer": dict(customer_id="CUST000001", signup_date="01/31/2026", city="pune", acquisition_channel="Social"),
    "restaurant": dict(
        restaurant_id="REST00001", onboard_date="2026-01-05", restaurant_name=" Thali ", city="DELHI",
        cuisine_type="goan", partner_type="Home Chef", avg_prep_time_min="16-25", is_active="y",
    ),
    "delivery_partner": dict(
        delivery_partner_id="DP00001", onboard_date="1/5/2026", partner_name="", city="Pune",
        vehicle_type="EV BIKE", employment_type="Contract", avg_rating="4.567", is_active="N",
    ),
    "menu_item": dict(
        menu_item_id="MENU00001_0001", restaurant_id="REST00001", item_name="", category="shakes", is_veg="Y",
        price="10.50",
    ),
    "order": dict(
        order_id="ORD000000000001", customer_id="CUST000001", restaurant_id="REST00001", delivery_partner_id="",
        order_timestamp="2026-02-01 10:11:12", subtotal_amount="100", discount_amount="", delivery_fee="5.5",
        total_amount="105.50", is_cod="N", is_cancelled="n",
    ),
    "order_item": dict(
        order_item_id="ITE000000000000001", order_id="ORD000000000001", menu_item_id="MENU00001_0001",
        restaurant_id="REST00001", quantity="2", unit_price="50", item_discount="1", line_total="99.01",
    ),
    "delivery_performance": dict(
        delivery_id="DEL000000000001", order_id="ORD000000000001", prep_time="20.0", rider_wait_time="5",
        travel_time="15", order_item="2", expected_delivery_time_min="30", actual_delivery_time_min="35",
        delivery_item="2", distance_km="3.5",
    ),
    "rating": dict(
        rating_id="RAT000000000001", order_id="ORD000000000001", customer_id="CUST000001",
        restaurant_id="REST00001", rating="4.5", review_text=" Great ", review_timestamp="2026-02-02T01:02:03",
        sentiment_score="-0.5",
    ),
}
BAD = {
    "customer": {"B1": ("customer_id", "CUST1"), "B2": ("signup_date", ""), "B3": ("city", "Atlantis"), "B4": ("acquisition_channel", None)},
    "restaurant": {
        "B5": ("restaurant_id", "rest00001"), "B6": ("restaurant_name", "  "), "B7": ("onboard_date", "31/12/2025"),
        "B8": ("onboard_date", "2026-12-31"), "B9": ("is_active", "1"), "B10": ("city", ""),
        "B11": ("cuisine_type", "Mud"), "B12": ("partner_type", "Stall"),
    },
    "delivery_partner": {
        "B13": ("delivery_partner_id", "DP1"), "B14": ("onboard_date", "?"), "B15": ("onboard_date", "12/31/2026"),
        "B16": ("avg_rating", "good"), "B17": ("avg_rating", "5.01"), "B18": ("is_active", ""),
        "B19": ("city", "X"), "B20": ("vehicle_type", "Sled"), "B21": ("employment_type", "Never"),
    },
    "menu_item": {
        "B22": ("menu_item_id", "MENU00001-0001"), "B23": ("restaurant_id", "REST99999"), "B24": ("price", "free"),
        "B25": ("price", "-0.01"), "B26": ("is_veg", "?"), "B27": ("category", "Stones"),
    },
    "order": {
        "B28": ("order_id", "ORD1"), "B29": ("customer_id", ""), "B30": ("restaurant_id", "R"),
        "B31": ("delivery_partner_id", "DPX"), "B32": ("order_timestamp", "yesterday"), "B33": ("is_cod", "x"),
        "B34": ("is_cancelled", None), "B35": ("subtotal_amount", ""), "B36": ("subtotal_amount", "-1"),
        "B37": ("discount_amount", "ten"), "B38": ("discount_amount", "-1"), "B39": ("delivery_fee", "1e2"),
        "B40": ("delivery_fee", "-0.01"), "B41": ("total_amount", "n/a"), "B42": ("total_amount", "-2"),
    },
    "order_item": {
        "B43": ("order_item_id", "ITE1"), "B44": ("order_id", "ORD12"), "B45": ("menu_item_id", "MENU00001_001"),
        "B46": ("order_id", "ORD000000000009"), "B47": ("menu_item_id", "MENU00001_0009"), "B48": ("quantity", "2.0"),
        "B49": ("quantity", "0"), "B50": ("unit_price", ""), "B51": ("unit_price", "-50"), "B52": ("item_discount", "x"),
        "B53": ("item_discount", "101"), "B54": ("line_total", None), "B55": ("line_total", "99.03"),
    },
    "delivery_performance": {
        "B56": ("delivery_id", "DEL1"), "B57": ("order_id", ""), "B58": ("order_id", "ORD000000000009"),
        "B59": ("order_id", "ORD000000000002"), "B60": ("expected_delivery_time_min", ""),
        "B61": ("expected_delivery_time_min", "121"), "B62": ("actual_delivery_time_min", "x"),
        "B63": ("actual_delivery_time_min", "181"), "B64": ("distance_km", ""), "B65": ("distance_km", "100.01"),
        "B66": ("order_item", ""), "B67": ("order_item", "0"), "B68": ("delivery_item", "x"),
        "B69": ("delivery_item", "101"), "B70": ("prep_time", "x"), "B71": ("prep_time", "181"),
        "B72": ("rider_wait_time", "x"), "B73": ("rider_wait_time", "61"), "B74": ("travel_time", "x"),
        "B75": ("travel_time", "181"), "B76": ("actual_delivery_time_min", "36"), "B77": ("rider_wait_time", "21"),
    },
    "rating": {
        "B78": ("rating_id", "RAT1"), "B79": ("order_id", "ORD"), "B80": ("customer_id", ""), "B81": ("restaurant_id", "R"),
        "B82": ("order_id", "ORD000000000009"), "B83": ("customer_id", "CUST000009"), "B84": ("restaurant_id", "REST00009"),
        "B85": ("rating", "10"), "B86": ("rating", "0.99"), "B87": ("review_timestamp", ""),
        "B88": ("sentiment_score", ""), "B89": ("sentiment_score", "1.0001"),
    },
}
AS_OF = dt.date(2026, 3, 1)


@pytest.fixture(scope="module")
def masters(spark):
    return {n: lookups.master_rows(spark, n) for n in lookups.MASTERS}


@pytest.fixture(scope="module")
def parents(spark):
    return {
        "order": spark.createDataFrame(
            [("ORD000000000001", False), ("ORD000000000002", True)], "order_id string, is_cancelled boolean"
        ),
        "menu_item": spark.createDataFrame([("MENU00001_0001",)], "menu_item_id string"),
        "customer": spark.createDataFrame([("CUST000001",)], "customer_id string"),
        "restaurant": spark.createDataFrame([("REST00001",)], "restaurant_id string"),
    }


def raw_rows(spark, entity, rows):
    columns = ENTITIES[entity].columns
    schema = ", ".join(f"{c} string" for c in columns) + ", batch_id long, source_file_name string, source_row_number long"
    data = [tuple(r.get(c) for c in columns) + r["at"] for r in rows]
    return spark.createDataFrame(data, schema)


def gate_rows(spark, entity, rows, masters, parents):
    return gates.apply_gates(entity, raw_rows(spark, entity, rows), masters, parents, F.lit(AS_OF))


def test_all_gates_are_covered():
    ids = [g for entity in BAD.values() for g in entity]
    assert ids == [f"B{i}" for i in range(1, 90)]


@pytest.mark.parametrize("entity", list(GOOD))
def test_each_gate_passes_and_fails(spark, masters, parents, entity):
    rows = [{**GOOD[entity], "at": (1, "a.csv", 2)}]
    names = list(BAD[entity])
    for i, (column, value) in enumerate(BAD[entity].values()):
        rows.append({**GOOD[entity], column: value, "at": (1, "a.csv", 3 + i)})
    gated = gate_rows(spark, entity, rows, masters, parents)
    found = {}
    for e in gates.quarantined(entity, gated).collect():
        found.setdefault(e.source_row_number, set()).add(e.gate_id)
    assert 2 not in found
    for i, gate_id in enumerate(names):
        assert gate_id in found[3 + i], (gate_id, found[3 + i])


def test_row_can_fail_several_gates(spark, masters, parents):
    row = {**GOOD["order"], "order_id": "", "is_cod": "?", "total_amount": "-1", "at": (1, "a.csv", 2)}
    gated = gate_rows(spark, "order", [row], masters, parents)
    assert {e.gate_id for e in gates.quarantined("order", gated).collect()} == {"B28", "B33", "B42"}


def test_cancelled_orders_skip_number_formats(spark, masters, parents):
    row = {
        **GOOD["delivery_performance"], "order_id": "ORD000000000002", "actual_delivery_time_min": "x",
        "expected_delivery_time_min": "", "distance_km": "", "order_item": "", "delivery_item": "x", "at": (1, "a.csv", 2),
    }
    gated = gate_rows(spark, "delivery_performance", [row], masters, parents)
    assert {e.gate_id for e in gates.quarantined("delivery_performance", gated).collect()} == {"B59"}


def test_price_limits_are_parameters(spark, masters, parents):
    raw = raw_rows(spark, "menu_item", [{**GOOD["menu_item"], "price": "1000.01", "at": (1, "a.csv", 2)}])
    day = F.lit(AS_OF)
    assert gates.passed(gates.apply_gates("menu_item", raw, masters, parents, day)).count() == 1
    capped = gates.apply_gates("menu_item", raw, masters, parents, day, lowest_price=0, highest_price=1000)
    assert gates.passed(capped).count() == 0


def test_bad_row_of_one_file_spares_the_other(spark, masters, parents):
    rows = [
        {**GOOD["customer"], "customer_id": "CUST000005", "at": (1, "customer_20260131.csv", 5)},
        {**GOOD["customer"], "city": "Atlantis", "at": (1, "customer_20260228.csv", 5)},
    ]
    left = gates.passed(gate_rows(spark, "customer", rows, masters, parents)).collect()
    assert [r.customer_id for r in left] == ["CUST000005"]


def test_clean_rows(spark, masters, parents):
    rows = [
        {**GOOD["customer"], "city": "delhi", "at": (1, "a.csv", 9)},
        {**GOOD["customer"], "customer_id": " CUST000001 ", "signup_date": "31-01-2026", "at": (1, "a.csv", 12)},
        {**GOOD["customer"], "city": "Chennai", "at": (2, "b.csv", 2)},
    ]
    gated = gate_rows(spark, "customer", rows, masters, parents)
    got = {(r.batch_id, r.city, r.signup_date, r.source_row_number) for r in clean.clean_rows("customer", gates.passed(gated)).collect()}
    day = dt.date(2026, 1, 31)
    assert got == {(1, "Pune", day, 12), (2, "Chennai", day, 2)}


def test_clean_defaults(spark, masters, parents):
    def one(entity, **changes):
        rows = [{**GOOD[entity], **changes, "at": (1, "a.csv", 2)}]
        return clean.clean_rows(entity, gates.passed(gate_rows(spark, entity, rows, masters, parents))).first()

    partner = one("delivery_partner")
    assert (partner.partner_name, str(partner.avg_rating), partner.vehicle_type) == ("UNKNOWN NAME", "4.57", "Electric Bike")
    assert one("menu_item").category == "Milkshakes & Smoothies" and one("menu_item").item_name == "UNKNOWN NAME"
    order = one("order")
    assert order.delivery_partner_id is None and str(order.discount_amount) == "0.00" and not order.is_cancelled
    assert one("delivery_performance", prep_time="20.9", travel_time="15.2", actual_delivery_time_min="35.7").prep_time == 20
    rating = one("rating", review_text=" " + "x" * 5000)
    assert len(rating.review_text) == 4000 and one("rating", review_text="  ").review_text is None


def test_same_number_in_two_files_takes_the_later_file(spark):
    df = spark.createDataFrame(
        [("k", 5, "a.csv", "old"), ("k", 5, "b.csv", "new")],
        "key string, source_row_number long, source_file_name string, v string",
    )
    assert [r.v for r in clean.keep_latest(df, ["key"]).collect()] == ["new"]


def test_master_spelling_shared_by_two_entries_keeps_the_row_count(spark):
    master = spark.createDataFrame(
        [("PIZZA", "Pizza", True), ("X", "pizza", True), ("OLD", "Old", False)], "code string, name string, is_active boolean"
    )
    values = {r.match_value: r.name for r in lookups.match_values(master).collect()}
    assert values == {"PIZZA": "Pizza", "X": "pizza"}


def test_lookups_carry_no_tested_texts(spark, masters, parents):
    """What a row alone tells is known before its parents are looked up: counting errors takes no text through the joins."""
    gated = gate_rows(spark, "order_item", [{**GOOD["order_item"], "at": (1, "a.csv", 2)}], masters, parents)
    counted = gated.select("batch_id", "gate_errors")
    plan = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last_join = max(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    carried = plan[last_join + 1]
    assert "gate_failed" in carried and "gate_texts" not in carried
    assert not any("unit_price" in line for line in plan[:last_join])


def test_texts_of_errors_come_from_failed_rows_alone(spark, masters, parents):
    bad = {"quantity": " two ", "order_id": "ORD999999999999", "at": (1, "a.csv", 3)}
    rows = [{**GOOD["order_item"], "at": (1, "a.csv", 2)}, {**GOOD["order_item"], **bad}]
    gated = gate_rows(spark, "order_item", rows, masters, parents)
    assert gated.filter(F.col(gates.TEXTS).isNotNull()).count() == 1
    found = {(e.column_name, e.raw_value) for e in gates.quarantined("order_item", gated).collect()}
    assert found == {("order_id", "ORD999999999999"), ("quantity", " two ")}


def test_outcome_passes_the_gates_once(spark):
    src = Source(spark, "/root/testdata/sf0.001")
    clean_keys, errors = Q.outcome(src, "order_item")
    assert {p.split("/strataflow/")[-1].split("-")[0] for p in clean_keys.inputFiles() + errors.inputFiles()} == {"outcome"}
    assert clean_keys.count() == Q.cleaned(src, "order_item").count()
