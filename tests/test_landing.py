"""File contract, row numbers, replacement, the whole batch with reruns and late parents, retention, streams."""

import csv
import datetime as dt
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators import audits, dimensions, facts, kpis, lookups, maintenance, monitoring, reviews
from strataflow.operators import views
from strataflow.plans import monthly, queries_landing
from strataflow.plans.registry import Source
from strataflow.sources import aspect_cache, landing, pieces
from strataflow.sources.tables import Warehouse
from strataflow.spec import ENTITIES
from strataflow.streaming import jobs

AS_OF = "2026-04-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def write(folder, name, *lines, bom=False):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(lines) + "\n" if lines else "", encoding="utf-8-sig" if bom else "utf-8")


CUSTOMER_HEADER = "customer_id,signup_date,city,acquisition_channel"


def check(spark, folder):
    files = landing.discover_files(spark, str(folder))
    return landing.check_files(files, landing.file_heads(spark, str(folder)))


def test_column_counts_and_keys():
    counts = {e: len(s.columns) for e, s in ENTITIES.items()}
    assert counts == {
        "customer": 4, "delivery_partner": 8, "delivery_performance": 10, "menu_item": 6, "order": 11, "order_item": 8,
        "rating": 8, "restaurant": 8,
    }
    assert [e for e, s in ENTITIES.items() if s.candidate_key_only] == ["delivery_performance"]
    assert all(s.key in s.required for s in ENTITIES.values())


def test_file_contract(spark, tmp_path):
    write(tmp_path, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2026-01-01,Pune,Paid", bom=True)
    write(tmp_path, "customer_20260201.csv", "city,customer_id,signup_date", "Pune,CUST000001,2026-01-01")
    write(tmp_path, "customer_20260202.csv", "customer_id,city,phone", "CUST000001,Pune,1")
    write(tmp_path, "customer_20260203.csv", CUSTOMER_HEADER)
    write(tmp_path, "customer_20260204.csv")
    write(tmp_path, "people_20260131.csv", "a", "1")
    write(tmp_path, "order_item_20260131.CSV", "a", "1")
    write(tmp_path, "notes.txt", "a")
    got = {r.file_name: (r.entity, r.is_valid, list(r.errors)) for r in check(spark, tmp_path).collect()}
    assert got["customer_20260131.csv"] == ("customer", True, [])
    assert got["customer_20260201.csv"] == ("customer", True, [])
    assert got["customer_20260202.csv"] == (
        "customer", False, ["Missing required columns: signup_date", "Unexpected columns: phone"]
    )
    assert got["customer_20260203.csv"] == ("customer", False, ["CSV file contains no data rows"])
    assert got["customer_20260204.csv"] == ("customer", False, ["File is empty"])
    assert got["people_20260131.csv"] == (None, False, ["Invalid filename: people_20260131.csv"])
    assert got["order_item_20260131.CSV"][0] is None
    assert "notes.txt" not in got
    summary = landing.validation_summary(check(spark, tmp_path)).first()
    assert (summary.total_files, summary.valid_files, summary.invalid_files) == (7, 2, 5)
    routes = {r.file_name: (r.route, r.month_folder, r.target_name) for r in landing.route_files(check(spark, tmp_path), 4).collect()}
    assert routes["customer_20260131.csv"] == ("processed", "2026_01", "customer_20260131_batch4.csv")
    assert routes["customer_20260202.csv"] == ("rejected", "2026_02", "customer_20260202_batch4.csv")


@pytest.mark.parametrize("breaking", [None, ()])
def test_row_numbers_across_blocks(spark, tmp_path, breaking):
    lines = [f"CUST{i:06d},2026-01-01,Pune,\"Pa\"\"id, {i}\"" for i in range(3000)]
    write(tmp_path, "customer_20260131.csv", CUSTOMER_HEADER, *lines, bom=True)
    write(tmp_path, "customer_20260228.csv", "city,customer_id,signup_date", "Pune,CUST900000,", ",CUST900001,x")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        checked = check(spark, tmp_path)
        assert landing.breaking_files(checked) == set()
        rows = landing.land_entity(spark, ENTITIES["customer"], landing.headers_of(checked, "customer"), 7, as_of(), breaking).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    first = {r.source_row_number: r for r in rows if r.source_file_name == "customer_20260131.csv"}
    assert sorted(first) == list(range(2, 3002))
    assert all(r.customer_id == f"CUST{n - 2:06d}" and r.acquisition_channel == f'Pa"id, {n - 2}' for n, r in first.items())
    second = sorted((r.source_row_number, r.customer_id, r.signup_date, r.city, r.acquisition_channel) for r in rows if r.source_file_name != "customer_20260131.csv")
    assert second == [(2, "CUST900000", "", "Pune", None), (3, "CUST900001", "x", "", None)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    header = ",".join(ENTITIES["rating"].columns)
    write(tmp_path, "rating_20260131.csv", header, 'RAT1,O,C,R,5,"two\nlines",2026-01-01,0', "RAT2,O,C,R,5,one,2026-01-01,0")
    rows = landing.land_entity(
        spark, ENTITIES["rating"], {str(tmp_path / "rating_20260131.csv"): ENTITIES["rating"].columns}, 1
    ).orderBy("source_row_number").collect()
    assert [(r.rating_id, r.review_text, r.source_row_number) for r in rows] == [("RAT1", "two\nlines", 2), ("RAT2", "one", 3)]


def breaking_rows(n):
    """Ratings whose texts hold line breaks, quotes, separators and blank lines."""
    rng = random.Random(n)
    texts = ["plain", "", "two\nlines", 'a "quoted"\nword', "blank\n\n \nlines,\n", "carriage\r\nreturn", ',",\n"', '"\n"']
    return [(f"RAT{i:012d}", "O", "C", "R", "5", rng.choice(texts) * rng.randint(1, 4), "2026-01-01", str(i)) for i in range(n)]


@pytest.mark.parametrize("size", ["4096", "100m"])
def test_splits_of_files_with_line_breaks(spark, tmp_path, size):
    """One file cut into many splits gives the rows and numbers that a reader of the whole file finds; a quote within an
    unquoted field is a plain character, blank lines are no records."""
    rows = breaking_rows(4000)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(ENTITIES["rating"].columns)
    writer.writerows(rows[:2000])
    out.write('RATX,O,C,R,5,5" wide,2026-01-01,0\n \n\n')
    csv.writer(out, lineterminator="\r\n").writerows(rows[2000:])
    (tmp_path / "rating_20260131.csv").write_text(out.getvalue(), encoding="utf-8-sig", newline="")
    want = rows[:2000] + [("RATX", "O", "C", "R", "5", '5" wide', "2026-01-01", "0")] + rows[2000:]
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        checked = check(spark, tmp_path)
        headers = landing.headers_of(checked, "rating")
        assert landing.breaking_files(checked) == set(headers)
        got = landing.land_entity(spark, ENTITIES["rating"], headers, 1, as_of(), landing.breaking_files(checked)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {r.source_row_number: tuple(r[c] for c in ENTITIES["rating"].columns) for r in got}
    assert len(got) == len(want) and found == dict(enumerate(want, 2))


def test_a_quote_that_is_never_closed(spark, tmp_path):
    write(tmp_path, "customer_20260131.csv", CUSTOMER_HEADER, 'CUST000001,"open', *["CUST000002,2026-01-01,Pune,Paid"] * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Exception, match="a quote is not closed"):
            pieces.csv_records(spark, str(tmp_path / "customer_20260131.csv")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", ["4096", "100m"])
@pytest.mark.parametrize("indent", [None, 1])
def test_splits_of_a_list_file(spark, tmp_path, size, indent):
    """A list in one line or in many, its texts full of brackets, quotes and backslashes, cut into many splits."""
    entries = [[f"h{i}", text + '[["\\]' * (i % 3), i % 7, 1, "]" * (i % 2), None] for i, (_, _, _, _, _, text, _, _) in enumerate(breaking_rows(2000))]
    (tmp_path / "cache.json").write_text(json.dumps(entries, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ]\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [tuple(r) for r in aspect_cache.read_cache(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=str) == sorted(map(tuple, entries), key=str)


def test_texts_of_split_files_are_written_once(spark, tmp_path, monkeypatch):
    """States and numbers are worked out without the texts, in lists and in delimited files."""
    entries = [[f"h{i}", f'[{i}] "text" ' * 20, i, 1, "]" * (i % 2), "m"] for i in range(300)]
    (tmp_path / "cache.json").write_text(json.dumps(entries), encoding="utf-8")
    write(tmp_path, "customer_20260131.csv", CUSTOMER_HEADER, *[f'CUST{i:06},2026-01-01,"Pu\nne",Paid' for i in range(300)])
    written, store = [], pieces.stored

    def counted(spark, rows, name):
        written.append("value" in rows.columns)
        return store(spark, rows, name)

    monkeypatch.setattr(pieces, "stored", counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lists = [tuple(r) for r in aspect_cache.read_cache(spark, str(tmp_path / "cache.json")).collect()]
        of_lists, written[:] = sum(written), []
        records = pieces.csv_records(spark, str(tmp_path / "customer_20260131.csv")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(lists, key=str) == sorted(map(tuple, entries), key=str) and of_lists == 1
    assert sorted(r.record for r in records) == list(range(1, 302)) and sum(written) == 1


def test_lists_of_a_cache(spark, tmp_path):
    """Every range is a list of its own, in order, also of one entry or of entries without a text."""
    rows = [("h", None if i % 50 == 0 else f'text {i % 90:03} "]['[: 5 + i % 11], i, 1, None, "m") for i in range(200)]
    cache = spark.createDataFrame(rows, "review_hash string, review_text string, aspect_id int, sentiment_type_id int, matched_phrase string, ai_model string")
    for name, kept in (("all", cache.repartition(3)), ("one", cache.filter("aspect_id = 7"))):
        aspect_cache.write_cache_lists(kept, str(tmp_path / name), 4)
        files = sorted((tmp_path / name).glob("part=*/*.txt"))
        lists = [json.loads(f.read_text(encoding="utf-8")) for f in files]
        assert len({f.parent for f in files}) == len(files) and all(lists)
        got = [(e[1], e[2]) for entries in lists for e in entries]
        assert got == sorted((t or "", i) for _, t, i, *_ in rows if name == "all" or i == 7)
        assert len(lists) == (4 if name == "all" else 1)


def test_lists_grow_in_number(spark, monkeypatch):
    """A file is one task's work, so there are more of them where there are more texts."""
    asked = []
    write_lists = aspect_cache.write_cache_lists
    monkeypatch.setattr(queries_landing, "FILE_BYTES", 100_000)
    monkeypatch.setattr(aspect_cache, "write_cache_lists", lambda cache, path, files: (asked.append(files), write_lists(cache, path, files)))
    folder = "/root/testdata/sf0.001"
    rows = queries_landing.cache_list_file(Source(spark, folder))
    size = sum(len((r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect())
    assert rows.count() and asked == [max(4, -(-size // 100_000))] and asked[0] > 4


ORDER_HEADER = ",".join(ENTITIES["order"].columns)
ITEM_HEADER = ",".join(ENTITIES["order_item"].columns)
DELIVERY_HEADER = ",".join(ENTITIES["delivery_performance"].columns)
RATING_HEADER = ",".join(ENTITIES["rating"].columns)


def month_one(folder):
    write(folder, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid", "CUST000002,2025-12-05,DELHI,social", "CUST000003,bad,Pune,Paid", bom=True)
    write(folder, "restaurant_20260131.csv", ",".join(ENTITIES["restaurant"].columns), "REST00001,2025-12-01,Thali,Pune,Goan,Restaurant,16-25,Y")
    write(folder, "delivery_partner_20260131.csv", ",".join(ENTITIES["delivery_partner"].columns), "DP00001,2025-12-01,Ravi,Pune,Bike,Contract,4.7,Y")
    write(folder, "menu_item_20260131.csv", ",".join(ENTITIES["menu_item"].columns), "MENU00001_0001,REST00001,Idli,Idli,Y,50")
    write(
        folder, "order_20260131.csv", ORDER_HEADER,
        "ORD000000000001,CUST000001,REST00001,DP00001,2026-01-10 12:30:00,100,0,5,105,Y,N",
        "ORD000000000002,CUST000002,REST00001,,2026-01-11 08:00:00,50,5,0,45,N,N",
        "ORD000000000003,CUST000009,REST00001,DP00001,2026-01-12 20:00:00,9000,0,0,9000,N,Y",
    )
    write(
        folder, "order_item_20260131.csv", ITEM_HEADER,
        "ITE000000000000001,ORD000000000001,MENU00001_0001,REST00001,2,50,0,100",
        "ITE000000000000002,ORD000000000002,MENU00001_0001,REST00001,1,50,5,45",
        "ITE000000000000009,ORD000000000099,MENU00001_0001,REST00001,1,50,0,50",
    )
    write(
        folder, "delivery_performance_20260131.csv", DELIVERY_HEADER,
        "DEL000000000001,ORD000000000001,30,5,15,2,40,45,2,2.5", "DEL000000000003,ORD000000000003,,,,,,,,",
    )
    write(folder, "rating_20260131.csv", RATING_HEADER, "RAT000000000001,ORD000000000001,CUST000001,REST00001,4.8,Tasty but a bit late,2026-01-10 14:00:00,0.3")


def month_two(folder):
    write(folder, "customer_20260228.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Goa,Paid", "CUST000002,2025-12-05,Delhi,Direct", "CUST000009,2026-02-01,Pune,Paid")
    write(
        folder, "order_20260228.csv", ORDER_HEADER,
        "ORD000000000004,CUST000001,REST00001,DP00001,2026-02-20 12:30:00,100,0,5,105,Y,N",
        "ORD000000000002,CUST000002,REST00001,,2026-01-11 08:00:00,60,5,0,55,N,N",
    )
    write(folder, "order_item_20260228.csv", ITEM_HEADER, "ITE000000000000002,ORD000000000002,MENU00001_0001,REST00001,1,60,5,55")


def dump(wh, name):
    table = wh.current(name)
    return sorted(str(r.asDict()) for r in table.select(sorted(table.columns)).collect())


CITIES = {"city": [("PUNE", "Pune"), ("DELHI", "Delhi"), ("GOA", "Goa")]}


@pytest.fixture(scope="module")
def two_months(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    masters = {n: lookups.master_rows(spark, n) for n in lookups.MASTERS}
    masters["city"] = spark.createDataFrame([(c, n, True) for c, n in CITIES["city"]], "code string, name string, is_active boolean")
    entries = [("Tasty but a bit late", 1, 1, "Tasty"), ("Tasty but a bit late", 2, 3, "a bit late")]
    cache = spark.createDataFrame(
        [(None, t, a, s, p, "m") for t, a, s, p in entries],
        "review_hash string, review_text string, aspect_id int, sentiment_type_id int, matched_phrase string, ai_model string",
    ).withColumn("review_hash", F.sha2(F.lower("review_text"), 256))
    month_one(root / "drop1")
    month_two(root / "drop2")

    def run(batch, drop):
        return monthly.run_month(spark, str(root / "wh"), str(root / drop), batch, as_of(), cache, masters)

    run(1, "drop1")
    return root, run, run(2, "drop2")


TABLES = (
    "ods/ods_customer", "ods/ods_order", "dwh/dim_customer", "dwh/dim_restaurant", "dwh/dim_delivery_partner",
    "dwh/dim_menu_item", "dwh/fact_order", "dwh/fact_order_item", "dwh/fact_delivery_performance", "dwh/fact_rating",
    "dwh/fact_review_aspect",
)


def test_typed_tables(two_months):
    wh = two_months[2].warehouse
    customers = {r.customer_id: (r.city, r.acquisition_channel, r.batch_id) for r in wh.current("ods/ods_customer").collect()}
    assert customers == {"CUST000001": ("Goa", "Paid", 2), "CUST000002": ("Delhi", "Direct", 2), "CUST000009": ("Pune", "Paid", 2)}
    errors = {(r.batch_id, r.table_name, r.error_type) for r in wh.read("control/etl_error").collect()}
    assert errors == {
        (1, "raw_customer", "INVALID_FORMAT"), (1, "raw_order_item", "MASTER_DATA_NOT_FOUND"),
        (1, "raw_delivery_performance", "EXCLUDED_ORDER_CANCELLED"),
    }
    warned = {(r.order_id, r.warning_type) for r in wh.read("control/etl_warning").filter("batch_id = 1").collect()}
    assert warned == {("ORD000000000003", "ORPHAN_CUSTOMER_DETECTED"), ("ORD000000000003", "HIGH_VALUE_ORDER")}


def test_dimensions_and_facts(two_months):
    wh = two_months[2].warehouse
    dim = wh.current("dwh/dim_customer")
    seen = [(r.city, r.valid_from, r.valid_to, r.is_current) for r in dim.filter("customer_id = 'CUST000001'").orderBy("valid_from").collect()]
    assert seen == [
        ("Pune", dt.date(2025, 12, 1), dt.date(2026, 1, 10), False), ("Goa", dt.date(2026, 1, 11), dt.date(9999, 12, 31), True)
    ]
    log = [(r.business_id, r.old_value, r.new_value, r.change_type) for r in wh.read("control/dim_change_log").filter("batch_id = 2").collect()]
    assert log == [("CUST000001", "Pune", "Goa", "SCD2_VERSION")]
    orders = {r.order_id: r for r in wh.current("dwh/fact_order").collect()}
    assert len(orders) == 4 and sorted(r.order_key for r in orders.values()) == [1, 2, 3, 4]
    assert orders["ORD000000000003"].customer_key == -1 and str(orders["ORD000000000002"].net_order_value) == "55.00"
    assert (orders["ORD000000000001"].cust_lc_id, orders["ORD000000000004"].cust_lc_id) == (1, 2)
    active = dim.filter("customer_id = 'CUST000001' AND is_current").first()
    assert (active.last_active, active.life_cycle_id) == (dt.date(2026, 2, 20), 2)
    delivery = wh.current("dwh/fact_delivery_performance").first()
    assert (delivery.late_reason, delivery.late_time, delivery.delivery_key) == ("Prep-Time", 5, 1)
    aspects = {(r.rating_key, r.aspect_id) for r in wh.current("dwh/fact_review_aspect").collect()}
    assert aspects == {(1, 1), (1, 2)}


def test_batch_close_and_audits(two_months):
    run = two_months[2]
    batches = {r.batch_id: (r.status, r.total_records, r.success_records, r.error_records) for r in run.warehouse.read("control/etl_batch").collect()}
    assert batches == {1: ("PARTIAL", 15, 12, 3), 2: ("SUCCESS", 6, 6, 0)}
    results = monthly.verify_month(run)
    audits.raise_on_failure(results)
    assert results.count() > 45


def test_rerun_changes_nothing(two_months):
    root, run, _ = two_months
    wh = Warehouse(two_months[2].spark, str(root / "wh"))
    before = {t: dump(wh, t) for t in TABLES}
    run(2, "drop2")
    after = Warehouse(wh.spark, str(root / "wh"))
    assert {t: dump(after, t) for t in TABLES} == before and after.parts("dwh/fact_order") != wh.parts("dwh/fact_order")


def test_rerun_replaces_with_less(spark, tmp_path):
    """A mended bad row, a mended bad file and an entity that is no longer delivered leave nothing behind."""
    drop, wh = tmp_path / "drop", str(tmp_path / "wh")

    def run():
        return monthly.run_month(spark, wh, str(drop), 1, as_of())

    def error_types(run):
        return sorted(r.error_type for r in run.control("etl_error", 1).collect())

    write(drop, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid", "CUST000002,no date,Pune,Paid")
    write(drop, "delivery_partner_20260131.csv", ",".join(ENTITIES["delivery_partner"].columns), "DP00001,2025-12-01,Asha,Pune,Bike,Full-Time,4.5,Y")
    first = run()
    assert error_types(first) and first.control("etl_batch").first().status == "PARTIAL"
    assert first.typed("delivery_partner") is not None
    write(drop, "customer_20260201.csv", "customer_id", "CUST000001")
    assert error_types(run()) == ["FILE_VALIDATION_ERROR"]
    (drop / "customer_20260201.csv").unlink()
    (drop / "delivery_partner_20260131.csv").unlink()
    write(drop, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid", "CUST000002,2025-12-02,Pune,Paid")
    last = run()
    batch = last.control("etl_batch").first()
    assert (batch.status, batch.error_records, batch.source_file_count) == ("SUCCESS", 0, 1)
    assert error_types(last) == [] and last.raw("delivery_partner").isEmpty() and last.typed("delivery_partner") is None
    assert last.typed("customer").count() == 2


def test_monitoring_runs_on_what_a_batch_writes(two_months):
    run = two_months[2]
    wh = run.warehouse
    batches, log, errors, found = (run.control(n) for n in ("etl_batch", "etl_log", "etl_error", "etl_warning"))
    changes = run.control("dim_change_log")
    raw = {s.label: wh.read(f"raw/{s.raw_table}") for s in ENTITIES.values()}
    raw = {k: v for k, v in raw.items() if v is not None}
    ods = {s.label: run.typed(e) for e, s in ENTITIES.items() if run.typed(e) is not None}
    dwh = {"Order": wh.current("dwh/fact_order"), "Rating": wh.current("dwh/fact_rating")}
    overview = monitoring.pipeline_overview(batches, as_of())
    steps = monitoring.step_performance(log, batches)
    error_view, warning_view = monitoring.error_view(errors, batches), monitoring.warning_view(found, batches)
    layers = monitoring.layer_reconciliation(batches, raw, ods, dwh, errors, found)
    views_made = [
        overview, steps, error_view, warning_view, layers, monitoring.scd2_audit_view(changes, batches),
        monitoring.batch_close(batches, errors), monitoring.batch_ledger(raw["Order"], errors),
        monitoring.close_stale_steps(log, "LOAD_ODS_ORDER", as_of()), monitoring.error_rows(errors), monitoring.warning_rows(found),
        monitoring.batch_metrics(batches, wh.current("dwh/fact_order"), run.dimension("dim_customer"), changes),
        monitoring.active_batch(batches, raw["Order"]), monitoring.guardrails(raw["Order"], ods["Order"], log, as_of()),
        audits.raw_vs_log({"order": run.raw("order")}, run.control("etl_log", 2)),
        kpis.latest_batch(overview), kpis.row_totals(error_view, warning_view, changes, layers, steps), kpis.sums(overview, steps, layers),
    ]
    assert all(view.count() > 0 for view in views_made)
    assert {r.batch_id for r in overview.collect()} == {1, 2} and steps.filter("log_id IS NULL").isEmpty()


def test_stored_activity_equals_the_full_scan(two_months):
    """Dimensions enriched from stored maxima of months are those that a scan of all orders gives."""
    run = two_months[2]
    orders = run.warehouse.current("dwh/fact_order")
    activity = run.warehouse.current("dwh/activity")
    for name, (key, lifecycle, _) in dimensions.LIFE_CYCLE_COLUMNS.items():
        active = orders.filter(F.col("batch_id") == 2).select(key).filter(F.col(key) != -1)
        stored = dimensions.stored_activity(name, activity, active)
        assert sorted(map(str, stored.collect())) == sorted(map(str, dimensions.last_activity(orders, key, lifecycle, 2).collect()))
        again = dimensions.enrich(name, run.dimension(name), orders, 2)
        assert sorted(map(str, again.collect())) == sorted(map(str, run.dimension(name).collect()))
    assert {p.value for p in run.warehouse.parts("dwh/activity")} == {"202601", "202602"}
    plan = orders._jdf.queryExecution().toString()
    written = run.warehouse.written_by("dwh/fact_order", 2).inputFiles()
    assert plan and len(written) <= len(orders.inputFiles())


def test_a_late_parent_opens_only_the_months_of_its_orphans(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    run = monthly.BatchRun(spark, wh, 2, as_of())
    order_type = "order_id string, order_date_key int, customer_key long, restaurant_key long, delivery_partner_key long, batch_id long, month_key int"
    item_type = "order_item_id string, order_id string, order_date_key int, customer_key long, restaurant_key long, order_item_key long, batch_id long, month_key int"
    items = [(f"I{m}{i}", f"O{m}{i}", 20260101 + 100 * m, 5, 6, 10 * m + i, 1, 202601 + m) for m in range(3) for i in range(3)]
    items += [("I9", "LATE", -1, -1, -1, 99, 1, -1), ("I8", "NEVER", -1, -1, -1, 98, 1, -1), ("I7", "LATE", 20260105, -1, 6, 97, 1, 202601)]
    rows = spark.createDataFrame(items, item_type)
    wh.publish_parts("dwh/fact_order_item", rows, "month_key", 1, key="order_item_id")
    wh.publish_parts("dwh/fact_order_item_orphans", facts.orphans("fact_order_item", rows), "month_key", 1)
    before = {p.value: p.path for p in wh.parts("dwh/fact_order_item")}
    wh.publish_parts("dwh/fact_order", spark.createDataFrame([("LATE", 20260105, 5, 6, 7, 2, 202601)], order_type), "month_key", 2, key="order_id")
    run.relink()
    after = {p.value: p.path for p in wh.parts("dwh/fact_order_item")}
    assert after["202602"] == before["202602"] and after["202603"] == before["202603"] and after["202601"] != before["202601"]
    got = {r.order_item_id: (r.order_date_key, r.customer_key, r.restaurant_key, r.order_item_key) for r in wh.current("dwh/fact_order_item").collect()}
    assert len(got) == 12 and got["I9"] == (20260105, 5, 6, 99) and got["I7"] == (20260105, 5, 6, 97) and got["I8"][1] == -1
    assert [r.order_item_id for r in wh.current("dwh/fact_order_item_orphans").collect()] == ["I8"]


def test_one_batch_reads_the_stored_cache(two_months):
    """Aspects that an earlier batch has stored are found without the cache being given again."""
    spark, wh = two_months[2].spark, two_months[2].warehouse
    assert wh.current("ref/review_aspect_cache").filter("aspect_id = 1").count() == 1
    parts = {p.value for p in wh.parts("ref/review_aspect_cache")}
    assert parts == {r.p for r in wh.current("ref/review_aspect_cache").selectExpr("substring(review_hash, 1, 1) AS p").distinct().collect()} and spark


def test_known_texts_meet_no_exchange_before_the_cache(spark):
    """The first exchanges carry hashes; texts are looked up for the hashes that are new."""
    ratings = spark.createDataFrame([(f"text {i % 50}",) for i in range(500)], "review_text string")
    cache = ratings.limit(30).select(F.sha2(F.lower(F.trim("review_text")), 256).alias("review_hash"))
    found = reviews.uncached_reviews(ratings, cache)
    known = {r.review_hash for r in cache.collect()}
    assert {r.review_hash for r in found.collect()} == {r[0] for r in ratings.select(F.sha2("review_text", 256)).collect()} - known
    plan = found._jdf.queryExecution().executedPlan().toString()
    anti = plan[plan.rindex("LeftAnti"):]
    assert "review_text" not in "".join(line for line in anti.splitlines() if "Exchange" in line)


def test_bad_file_fails_the_batch(spark, tmp_path):
    write(tmp_path / "drop", "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid")
    write(tmp_path / "drop", "customer_20260201.csv", "customer_id", "CUST000001")
    run = monthly.run_month(spark, str(tmp_path / "wh"), str(tmp_path / "drop"), 1, as_of())
    assert run.raw("customer") is None
    assert [r.error_type for r in run.warehouse.read("control/etl_error").collect()] == ["FILE_VALIDATION_ERROR"]
    assert run.warehouse.read("control/etl_batch").first().status == "FAILED"
    routes = {r.file_name: r.route for r in run.warehouse.read("control/file_manifest").collect()}
    assert routes["customer_20260201.csv"] == "rejected"


def test_a_batch_that_dies_is_taken_over(spark, tmp_path, monkeypatch):
    """The log shows the step that was running; the next run closes it, and further runs repeat."""
    drop, wh = tmp_path / "drop", str(tmp_path / "wh")
    write(drop, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid")
    write(drop, "delivery_partner_20260131.csv", ",".join(ENTITIES["delivery_partner"].columns), "DP00001,2025-12-01,Asha,Pune,Bike,Full-Time,4.5,Y")

    def steps():
        log = Warehouse(spark, wh).read("control/etl_log").orderBy("log_id").collect()
        return [(r.log_id - 1000, r.step_name, r.status, r.end_time is None) for r in log]

    def killed(entity, *rest, real=monthly.gates.apply_gates):
        if entity == "delivery_partner":
            raise RuntimeError("killed")
        return real(entity, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(monthly.gates, "apply_gates", killed)
        with pytest.raises(RuntimeError, match="killed"):
            monthly.run_month(spark, wh, str(drop), 1, as_of())
    batch = Warehouse(spark, wh).read("control/etl_batch").first()
    assert (batch.status, batch.end_time) == ("RUNNING", None)
    done, (number, stale, status, is_open) = steps()[:-1], steps()[-1]
    assert (status, is_open) == ("RUNNING", True) and "PARTNER" in stale and number == len(done) + 1
    assert {s for _, _, s, _ in done} == {"SUCCESS"} and not any(o for *_, o in done)
    assert monitoring.active_batch(*[Warehouse(spark, wh).read("control/etl_batch")] * 2).first().batch_id == 1

    last = monthly.run_month(spark, wh, str(drop), 1, as_of())
    assert last.control("etl_batch").first().status == "SUCCESS"
    after = steps()
    assert after[0] == (1, stale, "FAILED", False) and [s for _, _, s, _ in after[1:]] == ["SUCCESS"] * 4
    assert last.control("etl_log", 1).filter("log_id = 1001").first().message == monitoring.STALE_MESSAGE
    monthly.run_month(spark, wh, str(drop), 1, as_of())
    assert steps() == after


def test_guardrails_stop_a_batch(spark, tmp_path):
    """Orders that all are rejected stop the batch before the star schema; another entity's are raised at its end."""
    drop, wh = tmp_path / "drop", str(tmp_path / "wh")
    write(drop, "customer_20260131.csv", CUSTOMER_HEADER, "CUST000001,2025-12-01,Pune,Paid")
    write(drop, "order_20260131.csv", ORDER_HEADER, "ORD000000000001,CUST000001,REST00001,,no date,100,0,5,105,Y,N")
    with pytest.raises(monitoring.GuardrailError, match="raw_orders"):
        monthly.run_month(spark, wh, str(drop), 1, as_of())
    held = Warehouse(spark, wh)
    batch = held.read("control/etl_batch").first()
    assert (batch.status, batch.total_records, batch.error_records) == ("FAILED", 2, 1)
    assert held.current("dwh/dim_customer") is None and held.current("ods/ods_customer").count() == 1
    (drop / "order_20260131.csv").unlink()
    write(drop, "delivery_partner_20260131.csv", ",".join(ENTITIES["delivery_partner"].columns), "DP00001,no date,Asha,Pune,Bike,Full-Time,4.5,Y")
    with pytest.raises(monitoring.GuardrailError, match="failed steps.*PARTNER"):
        monthly.run_month(spark, wh, str(drop), 1, as_of())
    held = Warehouse(spark, wh)
    assert held.read("control/etl_batch").first().status == "PARTIAL" and held.current("dwh/dim_customer").count() == 2


def test_raw_load_goes_on_after_a_failure(spark, tmp_path):
    run = monthly.BatchRun(spark, Warehouse(spark, str(tmp_path)), 1, as_of())
    good = spark.createDataFrame([("CUST000001", 1)], "customer_id string, batch_id long")
    bad = good.withColumn("x", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(monthly.RawLoadError, match="rating"):
        run.load_raw({"rating": bad, "customer": good})
    assert run.raw("customer").count() == 1
    errors = run.control("etl_error", 1).collect()
    assert [(e.table_name, e.error_type) for e in errors] == [("rating", "RAW_LOAD_ERROR")] and "broken" in errors[0].error_message
    assert {(e["step_name"], e["status"]) for e in run.log} == {("LOAD_RAW_RATING", "FAILED"), ("LOAD_RAW_CUSTOMER", "SUCCESS")}
    with pytest.raises(monthly.NoStagedRows):
        run.load_raw({"customer": good.limit(0)})


def test_merge_moves_rows_between_parts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))

    def rows(*data):
        return spark.createDataFrame(data, "id string, v int, month int")

    def merge(target, source):
        if target is None:
            return source
        return target.join(source, "id", "left_anti").select(*source.columns).unionByName(source)

    assert wh.merge_parts("t", rows(("a", 1, 1), ("b", 1, 1), ("c", 1, 2)), "id", "month", merge, 1) == {"1", "2"}
    assert wh.merge_parts("t", rows(("c", 2, 1)), "id", "month", merge, 2) == {"1", "2"}
    assert sorted((r.id, r.v, r.month) for r in wh.current("t").collect()) == [("a", 1, 1), ("b", 1, 1), ("c", 2, 1)]


def _files(root):
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("*.parquet") if "table_versions" not in str(p)}


def _keyed(spark, *data):
    return spark.createDataFrame(data, "id string, v int, _home int")


def _newest(target, source):
    return source if target is None else target.join(source, "id", "left_anti").select(*source.columns).unionByName(source)


def test_untouched_parts_stay(spark, tmp_path):
    """A batch writes the parts of its keys and points to the folders of the rest; a purge keeps the last versions."""
    wh = Warehouse(spark, str(tmp_path))
    wh.merge_parts("t", _keyed(spark, *[(f"a{i}", 1, 1) for i in range(5)]), "id", "_home", _newest, 1)
    wh.merge_parts("t", _keyed(spark, *[(f"b{i}", 1, 2) for i in range(5)]), "id", "_home", _newest, 2)
    before = _files(tmp_path)
    wh.merge_parts("t", _keyed(spark, ("c1", 1, 3)), "id", "_home", _newest, 3)
    third = _files(tmp_path)
    assert {p: third[p] for p in before} == before and len(wh.parts("t")) == 3
    old = {p.value: p.path for p in wh.parts("t", 3)}
    wh.merge_parts("t", _keyed(spark, ("b1", 2, 4)), "id", "_home", lambda t, s: _newest(t, s), 4)
    now = {p.value: p.path for p in wh.parts("t")}
    assert now["1"] == old["1"] and "2" in old and now["3"] and wh.current("t").count() == 11 and "_home" not in wh.current("t").columns
    assert {r.id: r.v for r in wh.current("t").collect()}["b1"] == 2
    assert {r.id: r.v for r in wh.current("t", before=4).collect()}["b1"] == 1
    assert wh.purge_versions(2) == 0 and wh.current("t", before=4).count() == 11
    assert wh.purge_versions(1) == 1 and wh.current("t").count() == 11 and wh.current("t", before=4) is None
    assert wh.purge_versions(1) == 0 and Warehouse(spark, str(tmp_path)).current("t").count() == 11


def test_a_load_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch):
    """Between the writes of its months, and between the writes and the publication."""
    wh = Warehouse(spark, str(tmp_path))
    wh.merge_parts("t", _keyed(spark, ("a", 1, 1), ("b", 1, 2)), "id", "_home", _newest, 1)
    new = _keyed(spark, ("a", 2, 1), ("b", 2, 2), ("c", 2, 3))

    def broken(target, source):
        rows = _newest(target, source).repartition(3, "_home")
        return rows.withColumn("v", F.when(F.col("_home") == 3, F.raise_error(F.lit("the third month fails")).cast("int")).otherwise(F.col("v")))

    with pytest.raises(Exception, match="the third month"):
        wh.merge_parts("t", new, "id", "_home", broken, 2)
    monkeypatch.setattr(wh, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        wh.merge_parts("t", new, "id", "_home", _newest, 2)
    fresh = Warehouse(spark, str(tmp_path))
    assert sorted(map(tuple, fresh.current("t").collect())) == [("a", 1), ("b", 1)]
    fresh.merge_parts("t", new, "id", "_home", _newest, 2)
    assert sorted(map(tuple, fresh.current("t").collect())) == [("a", 2), ("b", 2), ("c", 2)]


def test_cache_file_round_trip(spark, tmp_path):
    (tmp_path / "cache.json").write_text('[["h1", "Say \\"hi\\", you\\n[x]", 1, 2, "hi", "m"], ["h2", "ü", 0, 3, "", "m"]]', encoding="utf-8")
    cache = aspect_cache.read_cache(spark, str(tmp_path / "cache.json"))
    assert {(r.review_hash, r.aspect_id) for r in cache.collect()} == {("h1", 1), ("h2", 0)}
    more = aspect_cache.add_missing(cache, cache.withColumn("aspect_id", F.lit(1)))
    assert sorted((r.review_hash, r.aspect_id) for r in more.collect()) == [("h1", 1), ("h2", 0), ("h2", 1)]
    aspect_cache.write_cache(more, str(tmp_path / "out"))
    back = aspect_cache.read_cache_rows(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, more.collect()))


def test_retention(spark):
    old, new = dt.datetime(2025, 1, 1), dt.datetime(2026, 3, 31)
    control = {
        "etl_batch": spark.createDataFrame([(1, old, "SUCCESS"), (2, old, "RUNNING"), (3, new, "SUCCESS"), (4, old, "PARTIAL")], "batch_id long, start_time timestamp_ntz, status string"),
        "etl_error": spark.createDataFrame([(1, new), (2, old), (3, new)], "batch_id long, error_timestamp timestamp_ntz"),
        "etl_warning": spark.createDataFrame([(4, new)], "batch_id long, warning_timestamp timestamp_ntz"),
        "etl_log": spark.createDataFrame([(1, old), (2, new)], "batch_id long, start_time timestamp_ntz"),
    }
    left = maintenance.purge_control(control, as_of(), 30)
    ids = {n: sorted(r.batch_id for r in df.collect()) for n, df in left.items()}
    assert ids == {"etl_batch": [2, 3], "etl_error": [3], "etl_warning": [], "etl_log": [2]}
    only = maintenance.purge_control(control, as_of(), 30, error_only=True)
    assert only["etl_batch"].count() == 4 and only["etl_log"].count() == 2
    with pytest.raises(ValueError):
        maintenance.purge_control(control, as_of(), 0)
    rows = spark.createDataFrame([(1, new), (2, new), (2, old), (4, new)], "batch_id long, load_timestamp timestamp_ntz")
    assert sorted(r.batch_id for r in maintenance.purge_transient(rows, control["etl_batch"], as_of()).collect()) == [2, 4]


def test_hours_count_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, 59), dt.datetime(2026, 1, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(monitoring.boundaries("HOUR", F.col("a"), F.col("b")).alias("h"), monitoring.boundaries("SECOND", F.col("a"), F.col("b")).alias("s")).first()
    assert (row.h, row.s) == (1, 120)


def test_guardrails_raise(spark):
    raw = spark.createDataFrame([(1,), (1,)], "batch_id long")
    log = spark.createDataFrame([("FAILED", dt.datetime(2026, 3, 31))], "status string, start_time timestamp_ntz")
    monitoring.enforce_guardrails(monitoring.guardrails(raw, raw, log, as_of()))
    with pytest.raises(monitoring.GuardrailError):
        monitoring.enforce_guardrails(monitoring.guardrails(raw, raw.limit(0), log, as_of()))
    late = F.lit("2026-03-31 01:59:00").cast("timestamp_ntz")
    with pytest.raises(monitoring.GuardrailError):
        monitoring.enforce_guardrails(monitoring.guardrails(raw, raw, log, late))


def test_clustered_rewrite_spreads_a_hot_day(spark, tmp_path):
    facts = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 20260101).otherwise(20260101 + F.col("id") % 28).cast("int").alias("k"), "id")
    maintenance.rewrite_clustered(facts, "k", str(tmp_path / "t"), 8)
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 20000 and max(r["count"] for r in files) < 6000


def test_late_parent_stream(spark, tmp_path):
    def events(name, rows):
        spark.createDataFrame(rows, "id long, k long, t timestamp").coalesce(1).write.parquet(str(tmp_path / name))

    def at(minute):
        return dt.datetime(2026, 1, 1, 0, 0) + dt.timedelta(minutes=minute)

    events("c", [(1, 1, at(0)), (2, 2, at(0)), (3, 3, at(600))])
    events("p", [(10, 1, at(30)), (20, 2, at(90)), (30, 9, at(600))])
    schema = spark.read.parquet(str(tmp_path / "c")).schema
    children = jobs.file_stream(spark, str(tmp_path / "c"), schema)
    parents = jobs.file_stream(spark, str(tmp_path / "p"), schema).selectExpr("id AS pid", "k AS pk", "t AS pt")
    linked = jobs.link_late_parents(children, parents, "k", "pk", "t", "pt", {"pid": "parent"}, "INTERVAL 1 HOUR")
    jobs.run_available(linked, str(tmp_path / "state"), output=str(tmp_path / "out"))
    got = {r.id: r.parent for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: 10, 2: -1}


def test_one_user_with_a_third_of_all_events(spark, tmp_path):
    """The state of a stream join is dealt by key and hour: a user with a third of the events spreads over the tasks, and
    the pairs are those of a plain join."""
    def events(name, shift, n):
        rows = spark.range(n).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("k"),
            F.timestamp_seconds(F.lit(1767225600) + (F.col("id") * 7919 + shift) % (F.lit(30) * 3600)).alias("t"),
        )
        rows.coalesce(1).write.parquet(str(tmp_path / name))
        return rows

    left, right = events("c", 0, 240), events("p", 1234, 150)
    schema = spark.read.parquet(str(tmp_path / "c")).schema
    children = jobs.file_stream(spark, str(tmp_path / "c"), schema)
    parents = jobs.file_stream(spark, str(tmp_path / "p"), schema).selectExpr("id AS pid", "k AS pk", "t AS pt")
    linked = jobs.link_late_parents(children, parents, "k", "pk", "t", "pt", {"pid": "parent"}, "INTERVAL 1 HOUR")
    jobs.run_available(linked, str(tmp_path / "state"), output=str(tmp_path / "out"))
    got = sorted((r.id, r.parent) for r in spark.read.parquet(str(tmp_path / "out")).filter("parent >= 0").collect())
    near = (F.col("c.k") == F.col("p.k")) & (F.abs(F.unix_seconds("c.t") - F.unix_seconds("p.t")) <= 3600)
    assert got == sorted(map(tuple, left.alias("c").join(right.alias("p"), near).select("c.id", "p.id").collect()))
    buckets = left.filter("k = 0").select(F.floor(F.unix_seconds("t") / 3600)).distinct().count()
    assert buckets > 20


def test_unknown_members_go_around_the_joins(spark):
    """Facts without a key, or with that of the unknown member, are dealt by their own id and keep its name."""
    rows = [(f"O{i}", None if i % 3 == 0 else -1 if i % 3 == 1 else i) for i in range(60)]
    made = spark.createDataFrame(rows, "order_id string, customer_key long")
    members = spark.createDataFrame([(-1, "UNKNOWN"), *((i, f"C{i}") for i in range(1, 40))], "customer_key long, customer_id string")
    got = {r.order_id: r.customer_id for r in views._ids(made, "order_id", (members, "customer_key", "customer_id")).collect()}
    assert got == {o: None if k is None else "UNKNOWN" if k == -1 else f"C{k}" if k < 40 else None for o, k in rows}
    plan = views._ids(made, "order_id", (members, "customer_key", "customer_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(order_id" in plan and "scalar-subquery" in plan


def test_view_columns_carry_surrogates(two_months):
    wh = two_months[2].warehouse
    dims = [wh.current(f"dwh/{n}") for n in ("dim_customer", "dim_restaurant", "dim_delivery_partner")]
    view = views.order_view(wh.current("dwh/fact_order"), *dims)
    assert view.columns[0] == "order_key" and view.count() == 4


@pytest.mark.parametrize("values, numbers, kept, dense", [
    (["a", "b", "b", "c", "d"], [2, 3, 4, 5, 6], True, True),
    (["a", "b", "c", "b", "d"], [2, 3, 4, 5, 6], False, True),
    (["a", "c", "b", "c", "d"], [2, 3, 4, 5, 6], False, True),
    (["a", None, "b", None, "a"], [2, 3, 4, 5, 6], True, True),
    (["a", "b", "b", "c", "d"], [2, 3, 3, 5, 6], True, False),
])
def test_order_of_a_file_is_checked_by_blocks(spark, values, numbers, kept, dense):
    rows = spark.createDataFrame([("f", n, v) for n, v in zip(numbers, values)], "source_file_name string, source_row_number long, value string")
    checked = queries_landing.file_order(rows, F.col("value"), block=2)
    windows = [x for x in checked._jdf.queryExecution().analyzed().toString().splitlines() if "Window" in x and "value" in x]
    assert windows and all("block" in x for x in windows)
    found = checked.first()
    assert (found.n, found.low, found.high) == (5, 2, 6)
    assert found.ordered is kept and (found.numbers == found.n) is dense


def test_files_grow_in_number_where_a_query_leaves_it_open(spark, monkeypatch):
    src = Source(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries_landing, "FILE_ROWS", 100)
    landed = queries_landing.landed_text(src)
    assert landed.count() == src.table("orders").count()
    assert len({r.f for r in queries_landing.landed_orders(src, 9).select(F.col("source_file_name").alias("f")).distinct().collect()}) == 9
    files = []
    monkeypatch.setattr(queries_landing, "landed_orders", lambda s, n=4, real=queries_landing.landed_orders: files.append(n) or real(s, n))
    queries_landing.landed_text(src)
    assert files == [-(-src.table("orders").count() // 100)]
