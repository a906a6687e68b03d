"""File contract, landing, batch replacement, seeds, the cache file, and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.operators import gates, clean, lookups, maintenance, monitoring, upsert
from strataflow.plans import queries_quality as Q
from strataflow.plans import queries_star as S
from strataflow.plans import source_maps as M
from strataflow.plans.monthly import BatchRun, RawLoadError
from strataflow.plans.registry import Source, fragment, query
from strataflow.session import scratch_path
from strataflow.sources import aspect_cache, landing
from strataflow.sources.tables import Warehouse
from strataflow.spec import ENTITIES
from strataflow.streaming import jobs

# A drop as file names and first lines: one order file per day and priority, some misnamed or malformed. -----

_STAMP = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING)"
_FILE_NAME = (
    f"CASE o_orderpriority WHEN '1-URGENT' THEN 'order_' || {_STAMP} || '.csv' WHEN '2-HIGH' THEN 'customer_' || {_STAMP} || '.csv' "
    f"WHEN '3-MEDIUM' THEN 'delivery_performance_' || {_STAMP} || '.csv' WHEN '4-NOT SPECIFIED' THEN 'orders_' || {_STAMP} || '.csv' "
    f"ELSE 'order_item_' || {_STAMP} || '.csv.csv' END"
)
_HEADERS = {
    "2-HIGH": {
        "O": "customer_id,signup_date,city", "F": "city,customer_id,signup_date,acquisition_channel",
        "P": "customer_id,city,phone",
    },
    "1-URGENT": {
        "O": ",".join(ENTITIES["order"].columns), "F": ",".join(ENTITIES["order"].columns) + ",tip",
        "P": "order_id,customer_id",
    },
    "3-MEDIUM": {
        "O": ",".join(ENTITIES["delivery_performance"].columns), "F": '"delivery_id","order_id"',
        "P": ",".join(reversed(ENTITIES["delivery_performance"].columns)),
    },
}
_HEADER = "CASE " + " ".join(
    f"WHEN o_orderpriority = '{p}' AND min(o_orderstatus) = '{s}' THEN '{h}'" for p, hs in _HEADERS.items() for s, h in hs.items()
) + " ELSE 'x' END"
_DROP = {
    "file_name": _FILE_NAME,
    "length": "CAST(CASE WHEN max(o_totalprice) > 450000 AND count(*) = 1 THEN 0 ELSE count(*) END AS BIGINT)",
    "header": _HEADER,
    "has_data": "count(*) > 1",
}
fragment(
    "file_drop",
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _DROP.items()) + f" FROM orders GROUP BY o_orderpriority, {_STAMP}",
)


def file_drop(src: Source) -> DataFrame:
    return src.once(
        "drop",
        lambda: src.table("orders").groupBy("o_orderpriority", F.expr(_STAMP).alias("stamp"))
        .agg(*[F.expr(_DROP[n]).alias(n) for n in ("length", "header", "has_data")], F.min("o_orderdate").alias("o_orderdate"))
        .select(F.expr(_FILE_NAME).alias("file_name"), "length", "header", "has_data"),
    )


def checked_files(src: Source) -> DataFrame:
    drop = file_drop(src).withColumn("file_path", F.concat(F.lit("/drop/"), F.col("file_name")))
    return landing.check_files(drop.select("file_path", "file_name", "length"), drop.select("file_path", "header", "has_data"))


_ENTITY = (
    "CASE WHEN regexp_matches(file_name, '^customer_[0-9]{8}[.]csv$') THEN 'customer' WHEN regexp_matches(file_name, '^delivery_partner_[0-9]{8}[.]csv$') THEN 'delivery_partner' "
    "WHEN regexp_matches(file_name, '^delivery_performance_[0-9]{8}[.]csv$') THEN 'delivery_performance' WHEN regexp_matches(file_name, '^menu_item_[0-9]{8}[.]csv$') THEN 'menu_item' "
    "WHEN regexp_matches(file_name, '^order_[0-9]{8}[.]csv$') THEN 'order' WHEN regexp_matches(file_name, '^order_item_[0-9]{8}[.]csv$') THEN 'order_item' "
    "WHEN regexp_matches(file_name, '^rating_[0-9]{8}[.]csv$') THEN 'rating' WHEN regexp_matches(file_name, '^restaurant_[0-9]{8}[.]csv$') THEN 'restaurant' END"
)


def _list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


_REQUIRED = "CASE entity " + " ".join(f"WHEN '{e}' THEN {_list(s.required)}" for e, s in ENTITIES.items()) + " END"
_EXPECTED = "CASE entity " + " ".join(f"WHEN '{e}' THEN {_list(s.columns)}" for e, s in ENTITIES.items()) + " END"
fragment("file_entities", f"SELECT *, {_ENTITY} AS entity, string_split(replace(header, '\"', ''), ',') AS actual FROM file_drop")
fragment(
    "file_checks",
    "SELECT file_name, entity, CASE WHEN entity IS NULL THEN 'Invalid filename: ' || file_name WHEN length = 0 THEN 'File is empty' ELSE concat_ws('; ', "
    f"CASE WHEN len(list_filter({_REQUIRED}, lambda c: NOT list_contains(actual, c))) > 0 THEN 'Missing required columns: ' || array_to_string(list_filter({_REQUIRED}, lambda c: NOT list_contains(actual, c)), ', ') END, "
    f"CASE WHEN len(list_filter(actual, lambda c: NOT list_contains({_EXPECTED}, c))) > 0 THEN 'Unexpected columns: ' || array_to_string(list_filter(actual, lambda c: NOT list_contains({_EXPECTED}, c)), ', ') END, "
    "CASE WHEN NOT has_data THEN 'CSV file contains no data rows' END) END AS errors FROM file_entities",
)


@query("a2_identify_source", "SELECT file_name, entity FROM file_entities")
def identify_source(src: Source) -> DataFrame:
    return file_drop(src).select("file_name", landing.identify_source(F.col("file_name")).alias("entity"))


@query("a3_file_contract", "SELECT file_name, entity, errors = '' AS is_valid, errors FROM file_checks")
def file_contract(src: Source) -> DataFrame:
    return checked_files(src).select("file_name", "entity", "is_valid", F.array_join("errors", "; ").alias("errors"))


_SUMMARY = "count(*) AS total_files, CAST(sum(CASE WHEN errors = '' THEN 1 ELSE 0 END) AS BIGINT) AS valid_files, CAST(sum(CASE WHEN errors <> '' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_files"


@query("a4_validation_summary", f"SELECT {_SUMMARY} FROM file_checks")
def validation_summary(src: Source) -> DataFrame:
    return landing.validation_summary(checked_files(src))


@query(
    "a12_ingestion_outcome",
    f"SELECT month_folder, {_SUMMARY}, CASE WHEN count(*) = 0 THEN 'NO_FILES' WHEN sum(CASE WHEN errors <> '' THEN 1 ELSE 0 END) > 0 THEN 'FAILED' ELSE 'LOAD_RAW' END AS outcome "
    "FROM (SELECT *, substring(regexp_extract(file_name, '[0-9]{8}'), 1, 4) || '_' || substring(regexp_extract(file_name, '[0-9]{8}'), 5, 2) AS month_folder FROM file_checks) GROUP BY month_folder",
)
def ingestion_outcome(src: Source) -> DataFrame:
    """One drop per month: the outcome each would have."""
    monthly = checked_files(src).groupBy(landing.month_folder(F.col("file_name")).alias("month_folder")).agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if("is_valid").alias("valid_files"),
        F.count_if(~F.col("is_valid")).alias("invalid_files"),
    )
    return monthly.withColumn("outcome", landing.outcome_of())


@query(
    "a12_file_errors",
    "SELECT CAST(7 AS BIGINT) AS batch_id, file_name AS source_file_name, COALESCE(entity, 'UNKNOWN') AS table_name, 'FILE_VALIDATION_ERROR' AS error_type, errors AS error_message FROM file_checks WHERE errors <> ''",
)
def file_errors(src: Source) -> DataFrame:
    return landing.file_errors(checked_files(src), 7).select(
        "batch_id", "source_file_name", "table_name", "error_type", "error_message"
    )


@query(
    "a13_file_routing",
    "SELECT file_name, entity, CASE WHEN errors = '' THEN 'processed' ELSE 'rejected' END AS route, substring(regexp_extract(file_name, '[0-9]{8}'), 1, 4) || '_' || substring(regexp_extract(file_name, '[0-9]{8}'), 5, 2) AS month_folder, "
    "substring(file_name, 1, length(file_name) - 4) || '_batch7.csv' AS target_name FROM file_checks",
)
def file_routing(src: Source) -> DataFrame:
    return landing.route_files(checked_files(src), 7).drop("file_path")


# Real files: the raw orders written as delimited text and landed again. -----------------------------------

DROP_FILES = 4


# Rows and bytes of a file where a query does not fix the number of files: a file is one task's work.
FILE_ROWS, FILE_BYTES = 2_000_000, 256 << 20


def landed_orders(src: Source, files: int = DROP_FILES) -> DataFrame:
    """Write the raw orders without an optional column, then discover, scan, number and fill them. The rows are dealt and
    sorted as given, in order of the order id; their texts are made when they are written."""
    folder = scratch_path(src.spark, "drop")
    spec = ENTITIES["order"]
    kept = [c for c in spec.columns if c != "delivery_partner_id"]
    made = M.RAW["raw_order"][0].columns
    order_id = F.expr(made["order_id"])
    ordered = src.table("orders").repartitionByRange(files, order_id).sortWithinPartitions(order_id)
    ordered.selectExpr(*[f"{made[c]} AS {c}" for c in kept]).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(folder)
    found = landing.discover_files(src.spark, folder)
    headers = {r.file_path: tuple(kept) for r in found.select("file_path").collect()}

    def store(rows: DataFrame) -> DataFrame:
        path = scratch_path(src.spark, "staged")
        rows.write.parquet(path)
        return src.spark.read.schema(rows.schema).parquet(path)

    return landing.land_entity(src.spark, spec, headers, 7, store=store)


@query(
    "a1_discover_files",
    f"SELECT CAST({DROP_FILES} AS BIGINT) AS files, true AS all_csv, true AS all_filled, "
    f"CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + length(o_orderpriority) + 2) + {DROP_FILES} * length('o_orderkey,o_orderpriority ') AS BIGINT) AS total_bytes FROM orders",
)
def discover_files(src: Source) -> DataFrame:
    """Files of a known content: their lengths add up to those of the lines."""
    folder = scratch_path(src.spark, "listing")
    src.table("orders").select("o_orderkey", "o_orderpriority").repartitionByRange(DROP_FILES, "o_orderkey").write.option(
        "header", True
    ).csv(folder)
    return landing.discover_files(src.spark, folder).agg(
        F.count(F.lit(1)).alias("files"), F.bool_and(F.col("file_name").endswith(".csv")).alias("all_csv"),
        F.bool_and(F.col("length") > 0).alias("all_filled"), F.sum("length").alias("total_bytes"),
    )


_TEXT = [c for c in ENTITIES["order"].columns if c != "delivery_partner_id"]


@query(
    "a5_landed_text",
    f"SELECT {', '.join(f'COALESCE({c}, {chr(39) * 2}) AS {c}' for c in _TEXT)}, CAST(NULL AS VARCHAR) AS delivery_partner_id, CAST(7 AS BIGINT) AS batch_id FROM raw_order",
)
def landed_text(src: Source) -> DataFrame:
    files = max(DROP_FILES, -(-src.table("orders").count() // FILE_ROWS))
    return landed_orders(src, files).select(*_TEXT, "delivery_partner_id", "batch_id")


def file_order(landed: DataFrame, value: Column, block: int = 1 << 16) -> DataFrame:
    """Per file: rows, lowest and highest row number, distinct numbers, and whether no row has a lower value than the row
    before it. A window holds one block of row numbers; blocks then meet by their first and last rows."""
    rows = landed.select(
        "source_file_name", "source_row_number", F.floor(F.col("source_row_number") / block).alias("block"), value.alias("value")
    )
    inside = Window.partitionBy("source_file_name", "block").orderBy("source_row_number")
    rows = rows.withColumns(
        {"number_before": F.lag("source_row_number").over(inside), "value_before": F.lag("value").over(inside)}
    )
    first = F.col("number_before").isNull()
    # A missing value stands in no order, be it of the row or of the row before.
    kept = F.coalesce(F.col("value") >= F.col("value_before"), F.lit(True))
    blocks = rows.groupBy("source_file_name", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("source_row_number").alias("low"), F.max("source_row_number").alias("high"),
        F.count_if(first | (F.col("source_row_number") != F.col("number_before"))).alias("numbers"),
        F.bool_and(kept).alias("ordered"), F.max(F.when(first, F.col("value"))).alias("first"),
        F.max_by("value", "source_row_number").alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy("source_file_name").orderBy("block"))
    blocks = blocks.withColumn("ordered", F.col("ordered") & F.coalesce(F.col("first") >= before, F.lit(True)))
    return blocks.groupBy("source_file_name").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("numbers").alias("numbers"),
        F.bool_and("ordered").alias("ordered"),
    )


@query(
    "a6_row_numbers",
    f"SELECT CAST({DROP_FILES} AS BIGINT) AS files, count(*) AS total_rows, true AS starts_at_two, true AS dense, true AS in_file_order FROM orders",
)
def row_numbers(src: Source) -> DataFrame:
    """Numbers are dense from 2 in every file, and follow its lines, which were written in order of the order id."""
    return file_order(landed_orders(src), F.col("order_id")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("total_rows"), F.bool_and(F.col("low") == 2).alias("starts_at_two"),
        F.bool_and((F.col("numbers") == F.col("n")) & (F.col("high") == F.col("n") + 1)).alias("dense"),
        F.bool_and("ordered").alias("in_file_order"),
    )


@query(
    "a7_optional_columns",
    "SELECT batch_id, count(*) AS orders, CAST(0 AS BIGINT) AS with_partner, true AS contract_order FROM (SELECT CAST(7 AS BIGINT) AS batch_id FROM orders) GROUP BY 1",
)
def optional_columns(src: Source) -> DataFrame:
    landed = landed_orders(src)
    in_order = landed.columns[: len(ENTITIES["order"].columns)] == list(ENTITIES["order"].columns)
    return landed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("orders"), F.count("delivery_partner_id").alias("with_partner"),
        F.lit(in_order).alias("contract_order"),
    )


# Texts with line breaks: whole documents as reviews, in quoted fields. ------------------------------------

_REVIEW = {
    "rating_id": "'RAT' || CAST(doc_id AS STRING)", "order_id": "'ORD' || lang", "customer_id": "source", "restaurant_id": "'5\" ' || lang",
    "rating": "CAST(doc_id % 5 AS STRING)", "review_text": "COALESCE(text, '')", "review_timestamp": "''", "sentiment_score": "CAST(n_chars AS STRING)",
}


def text_files(src: Source) -> int:
    """The number of files for the texts of all documents."""
    size = src.table("documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(DROP_FILES, -(-size // FILE_BYTES))


def landed_reviews(src: Source, files: int = DROP_FILES) -> DataFrame:
    """Documents as files of ratings, landed again. Their lines begin and end inside quoted fields, in any split."""
    folder, spec = scratch_path(src.spark, "reviews"), ENTITIES["rating"]
    rows = src.table("documents").selectExpr("doc_id", *[f"{e} AS {n}" for n, e in _REVIEW.items()])
    rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id").drop("doc_id").write.option("header", True).option(
        "escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    heads = landing.file_heads(src.spark, folder)
    breaking = {r.file_path.rsplit("/", 1)[-1] for r in heads.filter("breaks_lines").select("file_path").collect()}
    headers = {r.file_path: spec.columns for r in landing.discover_files(src.spark, folder).select("file_path").collect()}
    return landing.land_entity(src.spark, spec, headers, 7, breaking={p for p in headers if p.rsplit("/", 1)[-1] in breaking})


@query(
    "a5_landed_reviews",
    f"SELECT {', '.join(f'{e} AS {n}' for n, e in _REVIEW.items())}, CAST(7 AS BIGINT) AS batch_id FROM documents",
)
def landed_review_texts(src: Source) -> DataFrame:
    return landed_reviews(src, text_files(src)).select(*ENTITIES["rating"].columns, "batch_id")


@query(
    "a6_record_numbers",
    f"SELECT CAST({DROP_FILES} AS BIGINT) AS files, count(*) AS total_rows, true AS dense, true AS in_file_order FROM documents",
)
def record_numbers(src: Source) -> DataFrame:
    """Records of many lines are numbered densely from 2 in every file, in the order in which they were written."""
    doc = F.substring("rating_id", 4, 20).cast("long")
    return file_order(landed_reviews(src), doc).agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("total_rows"),
        F.bool_and((F.col("numbers") == F.col("n")) & (F.col("high") == F.col("n") + 1) & (F.col("low") == 2)).alias("dense"),
        F.bool_and("ordered").alias("in_file_order"),
    )


# Batch replacement ----------------------------------------------------------------------------------------

# Two of the batches: one is delivered again, one turns out to be empty.
RERUN, EMPTIED = 199806, 199807


@query(
    "a8_stage_replace",
    f"SELECT batch_id, source_file_name, count(*) AS staged_rows, CASE WHEN batch_id = {RERUN} THEN 'rerun' ELSE 'first' END AS load "
    f"FROM raw_order WHERE batch_id <> {EMPTIED} GROUP BY 1, 2",
)
def stage_replace(src: Source) -> DataFrame:
    """Load all files, then two batches again, one with rows and one without: both are replaced."""
    wh = Warehouse(src.spark, scratch_path(src.spark, "stage"))
    wh.replace_partitions("stg/order", src("raw_order").withColumn("load", F.lit("first")))
    again = src("raw_order").withColumn("load", F.lit("rerun"))
    wh.replace_batch("stg/order", again.filter(F.col("batch_id") == RERUN), batch_id=RERUN)
    wh.replace_batch("stg/order", again.filter("false"), batch_id=EMPTIED)
    return wh.read("stg/order").groupBy("batch_id", "source_file_name", "load").agg(
        F.count(F.lit(1)).alias("staged_rows")
    ).select(F.col("batch_id").cast("long"), "source_file_name", "staged_rows", "load")


@query(
    "a9_raw_replace",
    "SELECT batch_id, count(*) AS raw_rows, count(DISTINCT source_row_number) AS row_numbers FROM raw_order "
    f"WHERE batch_id <> {EMPTIED} GROUP BY 1",
)
def raw_replace(src: Source) -> DataFrame:
    """The same raw batches loaded twice, then one of them cleared."""
    wh = Warehouse(src.spark, scratch_path(src.spark, "raw"))
    for _ in range(2):
        wh.replace_partitions("raw/raw_order", src("raw_order"))
    wh.clear_batch("raw/raw_order", EMPTIED)
    return wh.read("raw/raw_order").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_distinct("source_row_number").alias("row_numbers")
    ).withColumn("batch_id", F.col("batch_id").cast("long"))


_RAW_LABELS = {s.label: s.raw_table for s in ENTITIES.values()}


# A rating of a day to come breaks the load of its entity; all others are loaded.
_BREAKS = "review_timestamp = 'today'"


@query(
    "a10_raw_rollup",
    "WITH staged AS ("
    + " UNION ALL ".join(
        f"SELECT 'LOAD_RAW_{e.upper()}' AS step_name, count(*) AS n, {f'count(*) FILTER (WHERE {_BREAKS})' if e == 'rating' else '0'} AS bad FROM {s.raw_table}"
        for e, s in ENTITIES.items()
    )
    + ") SELECT step_name, CASE WHEN bad > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN bad > 0 THEN 0 ELSE n END AS rows_processed, "
    "CASE WHEN bad > 0 THEN 0 ELSE n END AS stored_rows, CAST(bad > 0 AS INT) AS load_errors, 'FAILED' AS batch_status FROM staged",
)
def raw_rollup(src: Source) -> DataFrame:
    """All staged rows as one batch, in which one entity fails: the others go on, totals come from what the tables hold, the
    failure is written down and the batch fails at the end."""
    spark = src.spark
    run = BatchRun(spark, Warehouse(spark, scratch_path(spark, "rollup")), 7, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    staged = {e: src(s.raw_table).drop("batch_id") for e, s in ENTITIES.items()}
    broken = F.when(F.expr(_BREAKS), F.raise_error(F.lit("a review from the future"))).otherwise(F.col("review_timestamp"))
    staged["rating"] = staged["rating"].withColumn("review_timestamp", broken.cast("string"))
    try:
        run.load_raw(staged)
    except RawLoadError:
        pass
    log = run.control("etl_log", 7).select("step_name", "status", "rows_processed")
    batch = run.control("etl_batch", 7).select(F.col("status").alias("batch_status"))
    stored = None
    for entity in ENTITIES:
        kept = run.raw(entity)
        rows = kept.agg(F.count(F.lit(1)).alias("stored_rows")) if kept is not None else spark.range(1).select(F.lit(0).cast("long").alias("stored_rows"))
        rows = rows.withColumn("step_name", F.lit(f"LOAD_RAW_{entity.upper()}"))
        stored = rows if stored is None else stored.unionByName(rows)
    errors = run.control("etl_error", 7).filter("error_type = 'RAW_LOAD_ERROR'").select(
        F.concat(F.lit("LOAD_RAW_"), F.upper("table_name")).alias("step_name"), F.lit(1).alias("one")
    )
    found = log.join(stored, "step_name").join(errors, "step_name", "left")
    counted = found.groupBy("step_name", "status", "rows_processed", "stored_rows").agg(F.count("one").cast("int").alias("load_errors"))
    return counted.select("*", batch.scalar().alias("batch_status"))


@query(
    "a11_staged_batches",
    "SELECT batch_id, count(*) AS entities, CAST(sum(cnt) AS BIGINT) AS staged_rows FROM ("
    + " UNION ALL ".join(f"SELECT batch_id, count(*) AS cnt FROM {t} GROUP BY batch_id" for t in _RAW_LABELS.values())
    + ") GROUP BY batch_id",
)
def staged_batches(src: Source) -> DataFrame:
    return landing.staged_batches({n: src(t) for n, t in _RAW_LABELS.items()})


# Seeds and the cache --------------------------------------------------------------------------------------

_OLD_CITY = "SELECT 'N' || n_nationkey AS code, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS name, true AS is_active FROM nation WHERE n_regionkey <> 3"
fragment("old_city", _OLD_CITY)
fragment(
    "seeded_city",
    "SELECT s.code, s.name, s.is_active, CASE WHEN t.code IS NULL THEN 'INSERT' WHEN (t.name, t.is_active) IS DISTINCT FROM (s.name, s.is_active) THEN 'UPDATE' ELSE 'UNCHANGED' END AS merge_action "
    "FROM master_city s LEFT JOIN old_city t ON t.code = s.code",
)


def seeded_city(src: Source) -> DataFrame:
    old = src.table("nation").filter("n_regionkey <> 3").selectExpr(
        "'N' || CAST(n_nationkey AS STRING) AS code",
        "CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS name", "true AS is_active",
    )
    return lookups.seed_master(old, src("master_city"))


OTHER_MASTERS = tuple(n for n in M.MASTERS if n != "city")


def _old_master(name: str) -> str:
    """An earlier state of a master: some entries absent, some spelt otherwise."""
    return f"SELECT code, CASE WHEN length(name) % 2 = 0 THEN lower(name) ELSE name END AS name, is_active FROM master_{name} WHERE length(name) % 3 <> 0"


@query(
    "a14_seed_masters",
    "SELECT 'city' AS master, code, name, is_active, merge_action FROM seeded_city"
    + "".join(
        f" UNION ALL SELECT '{n}', s.code, s.name, s.is_active, CASE WHEN t.code IS NULL THEN 'INSERT' WHEN t.name <> s.name THEN 'UPDATE' ELSE 'UNCHANGED' END "
        f"FROM master_{n} s LEFT JOIN ({_old_master(n)}) t ON t.code = s.code"
        for n in OTHER_MASTERS
    ),
)
def seed_masters(src: Source) -> DataFrame:
    out = seeded_city(src).select(F.lit("city").alias("master"), "code", "name", "is_active", "merge_action")
    for name in OTHER_MASTERS:
        master = src(f"master_{name}")
        spelt = F.when(F.length("name") % 2 == 0, F.lower("name")).otherwise(F.col("name"))
        old = master.filter(F.length("name") % 3 != 0).withColumn("name", spelt)
        out = out.unionByName(lookups.seed_master(old, master).select(F.lit(name).alias("master"), "code", "name", "is_active", "merge_action"))
    return out


@query(
    "a14_seed_cache",
    "SELECT review_hash, aspect_id, sentiment_type_id, matched_phrase, ai_model, CASE WHEN sentiment_type_id = 1 THEN 'UPDATE' ELSE 'INSERT' END AS merge_action FROM doc_cache",
)
def seed_cache(src: Source) -> DataFrame:
    """Cache seeds over a cache that holds a part of them from another model."""
    seeds = S.doc_cache(src)
    old = seeds.filter("sentiment_type_id = 1").withColumn("ai_model", F.lit("another model"))
    return lookups.seed_cache(old, seeds).select("review_hash", "aspect_id", "sentiment_type_id", "matched_phrase", "ai_model", "merge_action")


@query(
    "a18_seed_summary",
    "SELECT 'ref_city' AS table_name, CAST(sum(CASE WHEN merge_action = 'INSERT' THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted, "
    "CAST(sum(CASE WHEN merge_action = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated, count(*) AS total_current_rows, 'PASS' AS validation_status FROM seeded_city "
    "UNION ALL SELECT 'ref_category', (SELECT count(*) FROM master_category), 0, (SELECT count(*) FROM master_category), 'PASS' "
    "UNION ALL SELECT 'ref_cuisine_type', 0, 0, 0, 'FAIL (EMPTY)'",
)
def seed_summary(src: Source) -> DataFrame:
    category = src("master_category")
    nothing = src("master_cuisine_type").filter("code IS NULL")
    return lookups.seed_summary(
        {
            "ref_city": seeded_city(src),
            "ref_category": lookups.seed_master(category.filter("code IS NULL"), category),
            "ref_cuisine_type": lookups.seed_master(nothing, nothing),
        }
    )


_CACHE = "review_hash, review_text, aspect_id, sentiment_type_id, COALESCE(matched_phrase, '') AS matched_phrase, ai_model"


@query(
    "a15_cache_round_trip",
    f"SELECT {_CACHE} FROM doc_cache UNION ALL SELECT review_hash, review_text, 0, 2, substring(review_text, 1, 200), 'offline-fallback' FROM uncached_docs",
)
def cache_round_trip(src: Source) -> DataFrame:
    """Add the unclassified reviews to the cache, export it, and read the export."""
    cache = S.doc_cache(src)
    fresh = S.fallback_aspects(src)
    known = aspect_cache.add_missing(cache, fresh.unionByName(cache.select(*fresh.columns)))
    path = scratch_path(src.spark, "cache")
    aspect_cache.write_cache(known, path)
    return aspect_cache.read_cache_rows(src.spark, path)


@query(
    "a15_list_file",
    f"SELECT {_CACHE} FROM doc_cache UNION ALL SELECT review_hash, review_text, 0, 2, substring(review_text, 1, 200), 'offline-fallback' FROM uncached_docs",
)
def cache_list_file(src: Source) -> DataFrame:
    """The same cache exported as JSON lists and read from them, in the splits that the files have."""
    path = scratch_path(src.spark, "cache-lists")
    fresh, cache = S.fallback_aspects(src), S.doc_cache(src)
    aspect_cache.write_cache_lists(cache.unionByName(fresh.select(*cache.columns)), path, text_files(src))
    return aspect_cache.read_cache(src.spark, path)


# Streams --------------------------------------------------------------------------------------------------

def stream_of(src: Source, table: str) -> DataFrame:
    # The listing pattern also covers a table stored as a folder of files.
    return jobs.file_stream(src.spark, f"{src.folder}/{table}.parquet*", src.table(table).schema)


def arriving(slices: list[DataFrame], folder: str, run) -> None:
    """Add one slice after the other to a folder and run the stream on what is new. Every run goes on from the state that
    the one before has committed."""
    for part in slices:
        part.write.mode("append").parquet(folder)
        run()


_CLEAN_ORDER = [*Q.TYPED["order"], "batch_id", "source_file_name", "source_row_number"]


@query("r1_stream_ingest", f"SELECT {Q.shown(_CLEAN_ORDER)} FROM clean_order")
def stream_ingest(src: Source) -> DataFrame:
    """Orders arrive as files; every micro-batch is gated, cleaned and upserted into the typed table. A third of the orders
    comes first with another customer, and again as it is: those rows are updated."""
    spark, folder, state = src.spark, scratch_path(src.spark, "arriving"), scratch_path(src.spark, "stream-state")
    wh = Warehouse(spark, scratch_path(spark, "stream"))
    part, orders = M.RAW["raw_order"][0], src.table("orders")

    def load(batch: DataFrame, epoch: int) -> None:
        gated = gates.apply_gates("order", batch)
        rows = clean.clean_rows("order", gates.passed(gated))
        rows = rows.withColumn("_home", F.lit(epoch)).persist()
        wh.merge_parts(
            "ods_order", rows, "order_id", "_home",
            lambda target, source: source if target is None else upsert.upsert_entity(
                "order", target, source.select(*target.columns), kept=["_home"]).drop("merge_action"),
            epoch, before=epoch,
        )
        rows.unpersist()

    def run() -> None:
        stream = jobs.file_stream(spark, folder, orders.schema)
        jobs.run_available(stream.selectExpr(*[f"{e} AS {n}" for n, e in part.columns.items()]), state, handle=load)

    third = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    first = orders.filter(third == 0).withColumn("o_custkey", F.col("o_custkey") + 1)
    arriving([first, orders.filter(third == 1), orders.filter(third != 1)], folder, run)
    return wh.current("ods_order").select(*_CLEAN_ORDER)


_CHILD = "event_type = 'purchase'"
_PARENT = "event_type = 'view'"
_NEAR = "p.user_id = c.user_id AND p.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 1 HOUR"


@query(
    "r2_stream_late_parents",
    f"SELECT c.event_id, c.user_id, COALESCE(p.event_id, -1) AS parent_key FROM (SELECT * FROM events WHERE {_CHILD}) c LEFT JOIN (SELECT * FROM events WHERE {_PARENT}) p ON {_NEAR}",
)
def stream_late_parents(src: Source) -> DataFrame:
    """Purchases with the views around them, as the stream alone gives them. Two closing inputs, days after the last event,
    move the watermark on until every unmatched purchase has left the state."""
    spark, folder, state, out = src.spark, *(scratch_path(src.spark, n) for n in ("events", "linked-state", "linked"))
    events = src.table("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.max("ts")).scalar()
    closing = [
        spark.range(1).select(
            F.explode(F.array(F.lit("purchase"), F.lit("view"))).alias("event_type"), F.lit(-1 - k).cast("long").alias("event_id"),
            F.lit(-1 - k).cast("long").alias("user_id"), (last + F.expr(f"INTERVAL {10 + k} DAYS")).alias("ts"),
        ).select(*events.columns)
        for k in range(2)
    ]

    def run() -> None:
        every = jobs.file_stream(spark, folder, events.schema)
        children = every.filter(_CHILD).select("event_id", "user_id", "ts")
        parents = every.filter(_PARENT).select(
            F.col("event_id").alias("parent_id"), F.col("user_id").alias("parent_user"), F.col("ts").alias("parent_ts")
        )
        linked = jobs.link_late_parents(
            children, parents, "user_id", "parent_user", "ts", "parent_ts", {"parent_id": "parent_key"}, "INTERVAL 1 HOUR"
        )
        jobs.run_available(linked, state, output=out)

    arriving([events, *closing], folder, run)
    done = spark.read.schema("event_id long, user_id long, ts timestamp, parent_key long").parquet(out)
    return done.filter("event_id >= 0").select("event_id", "user_id", "parent_key")


@query("r3_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(src: Source) -> DataFrame:
    stream = stream_of(src, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    out = scratch_path(src.spark, "first")
    jobs.run_available(
        jobs.first_per_key(stream, ["user_id", "event_type"], "ts", "60 days"),
        scratch_path(src.spark, "first-state"), output=out,
    )
    return src.spark.read.schema("user_id long, event_type string, ts timestamp").parquet(out).select(
        "user_id", "event_type"
    )


# Layout and statistics ------------------------------------------------------------------------------------

@query(
    "r4_clustered_facts",
    "SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1",
)
def clustered_facts(src: Source) -> DataFrame:
    """Rewrite the orders clustered by day, then aggregate the rewritten files."""
    path = scratch_path(src.spark, "clustered")
    facts = src("ods_order").select(
        S.calendar.date_key(F.col("order_timestamp")).alias("order_date_key"), "order_id", "subtotal_amount"
    )
    maintenance.rewrite_clustered(facts, "order_date_key", path, 8)
    return src.spark.read.parquet(path).groupBy("order_date_key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("subtotal_amount").cast("double").alias("revenue")
    )


@query("r5_table_statistics", "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders")
def table_statistics(src: Source) -> DataFrame:
    spark = src.spark
    path = scratch_path(spark, "statistics")
    src.table("orders").write.parquet(path)
    name = "facts_" + path[-12:]
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    maintenance.table_statistics(spark, name, ["o_orderkey"])
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'")
    counted = described.select(
        F.lit("orders").alias("table_name"),
        F.regexp_extract("data_type", "([0-9]+) rows", 1).cast("long").alias("row_count"),
    ).collect()
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(counted, "table_name string, row_count long")
