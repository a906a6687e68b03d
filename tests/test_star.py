"""Upserts, SCD2 sequences, point-in-time keys, life cycles, delivery KPIs, reviews, relinking."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataflow.functions import bands, calendar
from strataflow.operators import dimensions, facts, lookups, reviews, scd2, surrogate, upsert, views, warnings
from strataflow.plans import queries_star
from strataflow.plans.registry import Source

D = dt.date
CUSTOMER = "customer_id string, city string, signup_date date, acquisition_channel string, batch_id long"


def lit(day):
    return F.lit(day).cast("date")


def test_upsert_actions(spark):
    schema = "id string, v int, batch_id long"
    target = spark.createDataFrame([("a", 1, 1), ("b", None, 1), ("c", 3, 1), ("d", 4, 1)], schema)
    source = spark.createDataFrame([("a", 1, 2), ("b", 2, 2), ("c", None, 2), ("e", 5, 2)], schema)
    merged = upsert.upsert(target, source, ["id"], ["v"])
    got = {(r.id, r.v, r.batch_id, r.merge_action) for r in merged.collect()}
    assert got == {
        ("a", 1, 1, "UNCHANGED"), ("b", 2, 2, "UPDATE"), ("c", None, 2, "UPDATE"), ("d", 4, 1, "KEEP"),
        ("e", 5, 2, "INSERT"),
    }
    counts = upsert.action_counts(merged).first()
    assert (counts.inserted, counts.updated, counts.unchanged) == (1, 2, 1)


def test_upsert_twice_changes_nothing(spark):
    schema = "id string, v int, batch_id long"
    target = spark.createDataFrame([("a", 1, 1)], schema)
    source = spark.createDataFrame([("a", 2, 2), ("b", 3, 2)], schema)
    once = upsert.upsert(target, source, ["id"], ["v"]).drop("merge_action")
    twice = upsert.upsert(once, source, ["id"], ["v"])
    assert {r.merge_action for r in twice.collect()} == {"UNCHANGED"}
    assert sorted(map(tuple, twice.drop("merge_action").collect())) == sorted(map(tuple, once.collect()))


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("C"), F.col("id")).alias("bid"), F.lit(None).cast("long").alias("k"))
    one = {r.bid: r.k for r in surrogate.assign_keys(df.repartition(7), "bid", "k", 11).collect()}
    two = {r.bid: r.k for r in surrogate.assign_keys(df.repartition(3), "bid", "k", 11).collect()}
    assert sorted(one.values()) == list(range(11, 5011))
    assert one == two


def load(spark, dim, rows, effective):
    source = spark.createDataFrame(rows, CUSTOMER)
    out = dimensions.load_dimension("dim_customer", dim, source, lit(effective))
    stored = spark.createDataFrame(out.drop("scd_action").select(*dim.columns).collect(), dimensions.DIMENSION_TYPES["dim_customer"])
    log = scd2.change_log(scd2.CUSTOMER, dim, source, lit(effective), keyed=stored).collect()
    return stored, log


def versions(dim, cid):
    rows = dim.filter(F.col("customer_id") == cid).orderBy("valid_from", "valid_to").collect()
    return [(r.city, r.valid_from, r.valid_to, r.is_current) for r in rows]


def test_scd2_sequence(spark):
    end = D(9999, 12, 31)
    dim = dimensions.empty_dimension(spark, "dim_customer")
    first = [("C1", "Pune", D(2026, 1, 1), "Paid", 1), ("C2", "Delhi", None, "Paid", 1), ("C3", None, D(2026, 1, 3), "Paid", 1)]
    dim, log = load(spark, dim, first, D(2026, 1, 5))
    assert versions(dim, "C1") == [("Pune", D(2026, 1, 1), end, True)]
    assert versions(dim, "C2") == [("Delhi", D(1900, 1, 1), end, True)]
    assert log == [] and {r.customer_key for r in dim.collect()} == {-1, 1, 2, 3}
    # A tracked change, a change from NULL, and one id without news.
    dim, log = load(spark, dim, [("C1", "Goa", D(2026, 1, 1), "Paid", 2), ("C3", "Goa", D(2026, 1, 3), "Paid", 2)], D(2026, 2, 1))
    assert versions(dim, "C1") == [("Pune", D(2026, 1, 1), D(2026, 1, 31), False), ("Goa", D(2026, 2, 1), end, True)]
    assert versions(dim, "C3")[0] == (None, D(2026, 1, 3), D(2026, 1, 31), False)
    assert {(x.business_id, x.change_type, x.old_value, x.new_value) for x in log} == {
        ("C1", scd2.VERSION, "Pune", "Goa"), ("C3", scd2.VERSION, None, "Goa"),
    }
    assert all(x.surrogate_key_new not in (None, x.surrogate_key_old) for x in log)
    # The same day again: corrected in place, the key stays.
    keys = {r.customer_key for r in dim.collect()}
    dim, log = load(spark, dim, [("C1", "Surat", D(2026, 1, 1), "Paid", 3)], D(2026, 2, 1))
    assert versions(dim, "C1")[1] == ("Surat", D(2026, 2, 1), end, True)
    assert [(x.change_type, x.surrogate_key_old == x.surrogate_key_new) for x in log] == [(scd2.CORRECTION, True)]
    assert {r.customer_key for r in dim.collect()} == keys
    # Type 1 only, then nothing new.
    dim, log = load(spark, dim, [("C1", "Surat", D(2026, 1, 2), "Social", 4)], D(2026, 3, 1))
    row = dim.filter("customer_id = 'C1' AND is_current").first()
    assert (row.signup_date, row.acquisition_channel, row.valid_from, log) == (D(2026, 1, 2), "Social", D(2026, 2, 1), [])
    again, log = load(spark, dim, [("C1", "Surat", D(2026, 1, 2), "Social", 5)], D(2026, 3, 1))
    assert sorted(map(str, again.collect())) == sorted(map(str, dim.collect())) and log == []
    current = dim.filter("is_current").groupBy("customer_id").count().filter("count > 1")
    assert current.isEmpty()


def test_point_in_time_edges(spark):
    dim = spark.createDataFrame(
        [(1, "C", D(2026, 1, 10), D(2026, 1, 31)), (2, "C", D(2026, 2, 1), D(9999, 12, 31))],
        "customer_key long, customer_id string, valid_from date, valid_to date",
    )
    days = [D(2026, 1, 9), D(2026, 1, 10), D(2026, 1, 31), D(2026, 2, 1)]
    orders = spark.createDataFrame([("C", d) for d in days], "customer_id string, day date")
    got = {r.day: r.customer_key for r in facts.point_in_time(orders, dim, "customer_id", "customer_key", "day").collect()}
    assert [got[d] for d in days] == [None, 1, 1, 2]


ORDER = (
    "order_id string, customer_id string, restaurant_id string, delivery_partner_id string, order_timestamp timestamp_ntz, "
    "subtotal_amount decimal(18,2), discount_amount decimal(18,2), delivery_fee decimal(18,2), total_amount decimal(18,2), "
    "is_cod boolean, is_cancelled boolean, batch_id long"
)


def order(oid, day, customer="C1", partner="P1", hour=9):
    ten = Decimal("10.00")
    return (oid, customer, "R1", partner, dt.datetime(day.year, day.month, day.day, hour, 5), ten, None, None, ten, False, False, 1)


def empty_dims(spark):
    return [dimensions.empty_dimension(spark, n) for n in dimensions.SOURCES]


def test_life_cycles(spark):
    start = D(2026, 1, 1)
    days = {"a": start, "b": start + dt.timedelta(60), "c": start + dt.timedelta(121), "d": start + dt.timedelta(121)}
    orders = spark.createDataFrame(
        [order(o, d) for o, d in days.items()] + [order("x", start, "C2", None), order("y", start + dt.timedelta(31), "C3", "P9"), order("z", start, "C4", "P9")], ORDER
    )
    fact = facts.build_fact_order(orders, calendar.dim_date(spark), *empty_dims(spark))
    got = {r.order_id: (r.cust_lc_id, r.rest_lc_id, r.driver_lc_id) for r in fact.collect()}
    assert got["a"] == (1, 1, 1) and got["b"][0] == 2 and got["c"][0] == got["d"][0] == 3
    assert got["b"][2] == 3 and got["x"][2] is None and got["z"][2] == 1 and got["y"][2] == 3
    row = fact.filter("order_id = 'a'").first()
    assert (row.order_date_key, row.order_time_key, row.customer_key, row.net_order_value) == (20260101, 905, -1, Decimal("10.00"))


def test_life_cycle_uses_cached_activity(spark):
    dim = dimensions.empty_dimension(spark, "dim_customer")
    rows = [("C1", "Pune", D(2025, 1, 1), "Paid", 1), ("C2", "Pune", D(2025, 1, 1), "Paid", 1)]
    dim, _ = load(spark, dim, rows, D(2025, 2, 1))
    known = F.col("customer_id") == "C1"
    dim = dim.withColumn("life_cycle_id", F.when(known, 2).otherwise(0)).withColumn("last_active", lit("2025-12-20"))
    orders = spark.createDataFrame([order("a", D(2026, 1, 1)), order("b", D(2026, 1, 1), "C2")], ORDER)
    _, restaurants, partners = empty_dims(spark)
    fact = facts.build_fact_order(orders, calendar.dim_date(spark), dim, restaurants, partners)
    assert {r.order_id: r.cust_lc_id for r in fact.collect()} == {"a": 2, "b": 1}


def test_days_outside_the_calendar_are_unknown(spark):
    orders = spark.createDataFrame([order("a", D(2030, 1, 1))], ORDER)
    fact = facts.build_fact_order(orders, calendar.dim_date(spark), *empty_dims(spark))
    assert fact.first().order_date_key == -1


def test_delivery_kpis(spark):
    cases = {
        # prep, travel, expected, actual, ordered, delivered, max_prep -> ontime, infull, otif, reason, late, prep_late
        "ontime": ((20, 10, 30, 30, 2, 2, 25), (True, True, True, None, None, None)),
        "prep": ((40, 10, 40, 50, 2, 2, 25), (False, True, False, "Prep-Time", 10, 15)),
        "both": ((30, 30, 40, 60, 2, 1, 25), (False, False, False, "Both", 20, 5)),
        "travel": ((20, 40, 40, 60, 2, 3, 25), (False, True, False, "Travel-Time", 20, None)),
        "unknown_rest": ((90, 10, 40, 100, 2, 2, None), (False, True, False, "Travel-Time", 60, None)),
        "no_actual": ((20, 10, 40, None, 2, 2, 25), (False, True, False, None, None, None)),
    }
    schema = (
        "id string, prep_time int, travel_time int, expected_delivery_time_min int, actual_delivery_time_min int, "
        "order_item int, delivery_item int, max_prep int, distance_km decimal(10,2)"
    )
    df = spark.createDataFrame([(n, *v, Decimal("1.00")) for n, (v, _) in cases.items()], schema)
    kpis = facts.delivery_kpis(F.col("max_prep"))
    got = {r.id: r for r in df.select("id", *[c.alias(n) for n, c in kpis.items()]).collect()}
    for name, (_, want) in cases.items():
        r = got[name]
        assert (r.is_ontime, r.is_infull, r.is_otif, r.late_reason, r.late_time, r.prep_late_time) == want, name


def test_bins_are_upper_inclusive(spark):
    edges, labels = bands.ACTUAL_BINS
    values = [30, 31, 45, 46, 55, 56, 65, 66, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [r.b for r in df.select(bands.bins(F.col("v"), edges, labels).alias("b")).collect()]
    assert got == [labels[0], labels[1], labels[1], labels[2], labels[2], labels[3], labels[3], labels[4], None]


def test_rating_bands(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("5.00", "4.60", "4.59", "1.00", "0.99")], "v decimal(5,2)")
    got = [r.b for r in df.select(bands.band(F.col("v"), lookups.RATING_TYPES, 1).alias("b")).collect()]
    assert got == ["Excellent", "Excellent", "Good", "Very Bad", None]


CACHE = "review_hash string, review_text string, aspect_id int, sentiment_type_id int, matched_phrase string, ai_model string"


def cache(spark, *rows):
    df = spark.createDataFrame([(t, a, s, p) for t, a, s, p in rows], "t string, a int, s int, p string")
    return df.select(
        reviews.text_hash(F.col("t")).alias("review_hash"), F.col("t").alias("review_text"), F.col("a").alias("aspect_id"),
        F.col("s").alias("sentiment_type_id"), F.col("p").alias("matched_phrase"), F.lit("m").alias("ai_model"),
    )


def test_review_hash_is_the_published_one(spark):
    got = spark.range(1).select(reviews.text_hash(F.lit(" Great taste! ")).alias("h")).first().h
    assert got == "1fc2c56bd65e405fb9480fae8f2aeedf30a24e9b520698b3314b134c678e593a"


def test_review_aspects_and_fallback(spark):
    known = cache(spark, ("Tasty but a bit late", 1, 1, "Tasty"), ("Tasty but a bit late", 2, 3, "a bit late"))
    ratings = spark.createDataFrame(
        [(1, " tasty BUT a bit late ", 1), (2, "x" * 500, 1), (3, None, 1), (4, "  ", 1)], "rating_key long, review_text string, batch_id long"
    )
    rows = reviews.build_fact_review_aspect(ratings, known)
    assert {(r.rating_key, r.aspect_id) for r in rows.collect()} == {(1, 1), (1, 2)}
    fresh = reviews.fallback_aspects(reviews.uncached_reviews(ratings, known)).collect()
    assert [(len(r.review_text), len(r.matched_phrase), r.aspect_id, r.sentiment_type_id, r.ai_model) for r in fresh] == [
        (500, 200, 0, 2, "offline-fallback")
    ]
    first = reviews.merge_review_aspect(None, rows)
    again = reviews.merge_review_aspect(first, rows)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.select(*first.columns).collect()))
    assert sorted(r.review_aspect_key for r in first.collect()) == [1, 2]


def test_response_matching(spark):
    asked = spark.createDataFrame([(1, "Cold food"), (1, "Very late"), (2, "Cold food")], "request_batch int, request_text string")
    replies = spark.createDataFrame(
        [(1, "cold FOOD "), (1, "It was very late!"), (1, "late"), (2, "Very late"), (2, None)], "request_batch int, review_text string"
    )
    got = {(r.request_batch, r.review_text): r.matched_text for r in reviews.match_responses(replies, asked).collect()}
    assert got == {
        (1, "cold FOOD "): "Cold food", (1, "It was very late!"): "Very late", (1, "late"): "Very late",
        (2, "Very late"): "Very late", (2, None): None,
    }


def test_request_batches_hold_fifteen_texts(spark):
    from strataflow.sources.aspect_cache import request_batches

    texts = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("review_hash"), F.col("id").cast("string").alias("review_text"))
    sizes = [r["count"] for r in request_batches(texts).groupBy("request_batch").count().collect()]
    assert sum(sizes) == 100 and max(sizes) <= 15


def test_relink_only_fills_unknown_keys(spark):
    items = spark.createDataFrame(
        [("i1", "o1", -1, -1, -1, 7), ("i2", "o1", 20260101, 5, -1, 7), ("i3", "o9", -1, -1, -1, 7), ("i4", "o1", 1, 2, 3, 7)],
        "order_item_id string, order_id string, order_date_key int, customer_key long, restaurant_key long, menu_item_key long",
    )
    orders = spark.createDataFrame(
        [("o1", 20260202, 11, 12, 13)], "order_id string, order_date_key int, customer_key long, restaurant_key long, delivery_partner_key long"
    )
    linked = facts.relink("fact_order_item", items, orders)
    got = {r.order_item_id: (r.order_date_key, r.customer_key, r.restaurant_key, r.relinked) for r in linked.collect()}
    assert got == {
        "i1": (20260202, 11, 12, True), "i2": (20260101, 5, 12, True), "i3": (-1, -1, -1, False), "i4": (1, 2, 3, False),
    }
    assert facts.relink_preview("fact_order_item", items, orders).first().rows_to_relink == 2


def test_enrich_takes_highest_cycle_of_last_day(spark):
    dim = dimensions.empty_dimension(spark, "dim_customer")
    dim, _ = load(spark, dim, [("C1", "Pune", D(2026, 1, 1), "Paid", 1), ("C2", "Pune", D(2026, 1, 1), "Paid", 1)], D(2026, 2, 1))
    key = dim.filter("customer_id = 'C1'").first().customer_key
    fact = spark.createDataFrame(
        [(key, 20260201, 3, 1), (key, 20260301, 1, 1), (key, 20260301, 2, 1), (-1, 20260401, 3, 1)],
        "customer_key long, order_date_key int, cust_lc_id int, batch_id long",
    )
    rows = {r.customer_id: r for r in dimensions.enrich("dim_customer", dim, fact, 1).collect()}
    assert (rows["C1"].last_active, rows["C1"].life_cycle_id) == (D(2026, 3, 1), 2)
    assert (rows["C2"].last_active, rows["C2"].life_cycle_id) == (D(2026, 1, 1), 0)
    assert rows["UNKNOWN"].life_cycle_id == 0


@pytest.mark.parametrize(
    "idle,cycle,want", [(61, 2, "Churned"), (60, 2, "High"), (46, 2, "High"), (45, 2, "Medium"), (20, 2, "Medium"), (19, 2, "Low"), (31, 1, "High"), (30, 1, "Medium"), (10, 1, "Medium"), (9, 1, "Low")]
)
def test_churn_risk(spark, idle, cycle, want):
    dim = dimensions.empty_dimension(spark, "dim_customer").withColumn("customer_key", F.lit(1).cast("long"))
    dim = dim.withColumn("life_cycle_id", F.lit(cycle)).withColumn("last_active", F.date_sub(lit("2026-06-01"), idle))
    row = views.customer_view(dim, lit("2026-06-01")).first()
    assert (row.churn_risk, row.is_churned, row.last_status) == (want, idle > 60, 4 if idle > 60 else cycle)


def test_unknown_member_view(spark):
    row = views.customer_view(dimensions.empty_dimension(spark, "dim_customer"), lit("2026-06-01")).first()
    assert (row.churn_risk, row.days_since_last_active, row.is_churned, row.last_status) == ("Unknown", None, False, 0)


def test_order_warnings(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "C1", "R1", None, Decimal("10"), None, None, Decimal("10"), 1),
            ("o2", "C9", "R9", "P9", Decimal("6000"), Decimal("1"), Decimal("2"), Decimal("6001.02"), 1),
        ],
        "order_id string, customer_id string, restaurant_id string, delivery_partner_id string, subtotal_amount decimal(18,2), "
        "discount_amount decimal(18,2), delivery_fee decimal(18,2), total_amount decimal(18,2), batch_id long",
    )
    parents = [spark.createDataFrame([(v,)], f"{c} string") for c, v in (("customer_id", "C1"), ("restaurant_id", "R1"), ("delivery_partner_id", "P1"))]
    found = warnings.order_warnings(orders, *parents)
    assert {(r.order_id, r.warning_type) for r in found.collect()} == {("o2", t) for t in warnings.WARNING_TYPES.values()}
    message = found.filter("warning_type = 'TOTAL_AMOUNT_MISMATCH'").first().warning_message
    assert message == "The total of 6001.02 is off by 0.02 from 6001.00, which is 6000.00 less 1.00 plus 2.00"
    kept = warnings.replace_warnings(found, found, 1)
    assert kept.count() == found.count()


def test_relink_and_key_checks_work_order_facts_out_once(spark):
    src = Source(spark, "/root/testdata/sf0.001")
    name, (_, build) = "fact_rating", queries_star.ORPHANED["fact_rating"]
    queries_star.orphaned(src, name, build)
    for table in ("before_order", "ods_order"):
        queries_star.stored_orders(src, table)
        assert all(f"/strataflow/fact_{table}-" in f for f in queries_star.orders_fact(src, table).inputFiles())
