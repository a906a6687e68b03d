"""Monitoring views and batch bookkeeping over the control tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.spec import ENTITIES, LOAD_ORDER

FRESH_HOURS = 24
TEXT_LIMIT = 4000
DEFAULT_SOURCE = "File Ingestion"
ENTITY_LABELS = tuple(ENTITIES[e].label for e in LOAD_ORDER)

# The first fragment found in a table name decides its entity (order_item before order).
TABLE_FRAGMENTS = (
    ("customer", "Customer"), ("restaurant", "Restaurant"), ("delivery_partner", "Delivery Partner"),
    ("menu_item", "Menu Item"), ("order_item", "Order Item"), ("order", "Order"),
    ("delivery_performance", "Delivery Performance"), ("rating", "Rating"),
)
# Error categories.
CATEGORY_REFERENTIAL = "Referential Integrity (Orphan Record)"
CATEGORY_FORMAT = "Data Type & Format Incompatibility"
CATEGORY_NULL = "Mandatory Field Null Violation"
CATEGORY_DUPLICATE = "Duplicate Business Key Violation"
CATEGORY_FILE = "Source File Structure & Validation"
CATEGORY_OTHER = "Other Data Quality Anomaly"
# The message of a step that a newer run replaced.
STALE_MESSAGE = "A newer run took the place of this one"
RECONCILED = "RECONCILED (Valid Audit)"
VARIANCE = "VARIANCE DETECTED"


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """How many unit boundaries lie between two times: truncate both, then count whole units."""
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))


def _percent(part: Column, whole: Column, otherwise: float) -> Column:
    return F.when(
        F.coalesce(whole, F.lit(0)) > 0, F.round(part.cast("double") / whole * 100.0, 2)
    ).otherwise(F.lit(float(otherwise)))


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def pipeline_overview(batches: DataFrame, as_of: Column, source_system: str = DEFAULT_SOURCE) -> DataFrame:
    seconds = boundaries("SECOND", F.col("start_time"), F.coalesce("end_time", as_of))
    hours = boundaries("HOUR", F.col("start_time"), as_of)
    latest = batches.agg(F.max("batch_id").alias("m")).scalar()
    health = (
        F.when((F.col("status") == "SUCCESS") & (hours <= FRESH_HOURS), "Healthy")
        .when(F.col("status") == "RUNNING", "Running")
        .when(F.col("status") == "PARTIAL", "Degraded (Partial)")
        .when(F.col("status") == "FAILED", "Critical (Failed)")
        .otherwise("Warning (Stale >24h)")
    )
    return batches.select(
        "batch_id", "pipeline_name",
        F.coalesce("source_system", F.lit(source_system)).alias("source_system"),
        _or_zero("source_file_count"), "start_time", "end_time",
        seconds.alias("duration_seconds"),
        F.round(seconds.cast("double") / 60.0, 2).alias("duration_minutes"),
        F.col("status").alias("batch_status"),
        _or_zero("total_records"), _or_zero("success_records"), _or_zero("error_records"),
        _percent(F.col("success_records"), F.col("total_records"), 100).alias("success_rate_pct"),
        _percent(F.col("error_records"), F.col("total_records"), 0).alias("error_rate_pct"),
        (F.col("batch_id") == latest).alias("is_latest_batch"),
        hours.alias("hours_since_run"),
        health.alias("pipeline_health_status"),
    )


def _pipeline_names(batches: DataFrame, *extra: str) -> DataFrame:
    return batches.select("batch_id", "pipeline_name", *extra)


def step_performance(log: DataFrame, batches: DataFrame) -> DataFrame:
    seconds = boundaries("SECOND", F.col("start_time"), F.coalesce("end_time", "start_time"))
    processed = F.coalesce("rows_processed", F.lit(0))
    return log.join(_pipeline_names(batches), "batch_id").select(
        "log_id", "batch_id", "pipeline_name", "process_name", "step_name", "start_time", "end_time",
        seconds.alias("duration_seconds"),
        F.round(seconds.cast("double") / 60.0, 3).alias("duration_minutes"),
        F.col("status").alias("step_status"),
        _or_zero("rows_processed"), _or_zero("rows_inserted"), _or_zero("rows_rejected"),
        _percent(F.col("rows_rejected"), F.col("rows_processed"), 0).alias("rejection_rate_pct"),
        F.when(seconds > 0, F.round(processed.cast("double") / seconds, 0))
        .otherwise(processed.cast("double"))
        .alias("throughput_rows_per_sec"),
    )


def error_category(column: str = "error_type") -> Column:
    kind = F.col(column)
    return (
        F.when(kind == "MASTER_DATA_NOT_FOUND", CATEGORY_REFERENTIAL)
        .when(kind == "INVALID_FORMAT", CATEGORY_FORMAT)
        .when(kind.like("%NULL%"), CATEGORY_NULL)
        .when(kind.like("%DUPLICATE%"), CATEGORY_DUPLICATE)
        .when(kind == "FILE_VALIDATION_ERROR", CATEGORY_FILE)
        .otherwise(CATEGORY_OTHER)
    )


def error_view(errors: DataFrame, batches: DataFrame) -> DataFrame:
    names = _pipeline_names(batches, F.col("status").alias("batch_status"))
    return errors.join(names, "batch_id", "left").select(
        "error_id", "batch_id", "pipeline_name", "batch_status",
        F.coalesce("table_name", F.lit("UNKNOWN")).alias("table_name"),
        F.coalesce("column_name", F.lit("N/A")).alias("column_name"),
        "error_type", error_category().alias("error_category"), "error_message", "raw_value",
        "source_file_name", "source_row_number", "error_timestamp",
    )


def warning_view(warnings: DataFrame, batches: DataFrame) -> DataFrame:
    return warnings.join(_pipeline_names(batches), "batch_id", "left").select(
        "warning_id", "batch_id", "pipeline_name", "step_name",
        F.coalesce("table_name", F.lit("N/A")).alias("table_name"),
        "order_id", "entity_name", "entity_id", "warning_type", "warning_message", "warning_timestamp",
    )


def scd2_audit_view(changes: DataFrame, batches: DataFrame) -> DataFrame:
    return changes.join(_pipeline_names(batches), "batch_id", "left").select(
        "batch_id", "pipeline_name", "dimension_name", "business_id", "surrogate_key_old",
        "surrogate_key_new", "change_type", "column_name", "old_value", "new_value", "effective_date",
    )


def entity_of_table(column: str = "table_name") -> Column:
    expr = None
    for fragment, label in TABLE_FRAGMENTS:
        hit = F.col(column).contains(fragment)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise("Other")


def entity_of_warning(column: str = "entity_name") -> Column:
    expr = None
    for label in ENTITY_LABELS:
        hit = F.col(column) == label.upper().replace(" ", "_")
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise("Other")


def errored_row() -> Column:
    """One value per physical row; errors without a row stand for themselves."""
    return F.coalesce(
        F.concat("source_file_name", F.lit("|"), F.col("source_row_number").cast("string")),
        F.col("error_id").cast("string"),
    )


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (batch, entity). Each table is counted before the union, so only counts are united."""
    out = None
    for label, df in tables.items():
        part = df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("cnt")).select(
            "batch_id", F.lit(label).alias("entity_name"), "cnt"
        )
        out = part if out is None else out.unionByName(part)
    return out


def layer_reconciliation(
    batches: DataFrame,
    raw: Mapping[str, DataFrame],
    ods: Mapping[str, DataFrame],
    dwh: Mapping[str, DataFrame],
    errors: DataFrame,
    warnings: DataFrame,
) -> DataFrame:
    """Raw, typed and warehouse rows per batch and entity, with rejected rows and warnings.

    The grid is each batch with its list of entities exploded, so there is no cross join.
    """
    grid = batches.select("batch_id").distinct().select(
        "batch_id", F.explode(F.array(*[F.lit(x) for x in ENTITY_LABELS])).alias("entity_name")
    )
    error_rows = errors.groupBy("batch_id", entity_of_table().alias("entity_name")).agg(
        F.count_distinct(errored_row()).alias("quarantined_error_rows")
    )
    warning_rows = warnings.groupBy("batch_id", entity_of_warning().alias("entity_name")).agg(
        F.count(F.lit(1)).alias("warning_rows")
    )
    key = ["batch_id", "entity_name"]
    joined = grid
    for name, tables in (("raw_rows", raw), ("ods_rows", ods), ("dwh_rows", dwh)):
        joined = joined.join(layer_counts(tables).withColumnRenamed("cnt", name), key, "left")
    joined = joined.join(error_rows, key, "left").join(warning_rows, key, "left").fillna(
        0, ["raw_rows", "ods_rows", "dwh_rows", "quarantined_error_rows", "warning_rows"]
    )
    to_ods = F.col("raw_rows") - F.col("ods_rows")
    to_dwh = F.col("ods_rows") - F.col("dwh_rows")
    explained = (to_ods == F.col("quarantined_error_rows")) | (to_ods == 0)
    # Every batch has a row per entity, so a row's number follows from the places of its batch and entity.
    all_batches = batches.agg(F.sort_array(F.collect_set("batch_id"))).scalar()
    entities = F.array(*[F.lit(x) for x in sorted(ENTITY_LABELS)])
    number = (F.array_position(all_batches, F.col("batch_id")) - 1) * len(ENTITY_LABELS) + F.array_position(entities, F.col("entity_name"))
    return joined.select(
        number.cast("int").alias("reconciliation_id"),
        "batch_id", "entity_name", "raw_rows", "ods_rows", "dwh_rows",
        to_ods.alias("raw_to_ods_variance"), to_dwh.alias("ods_to_dwh_variance"),
        "quarantined_error_rows", "warning_rows",
        _percent(F.col("dwh_rows"), F.col("raw_rows"), 100).alias("data_retention_rate_pct"),
        F.when(explained & (to_dwh == 0), RECONCILED).otherwise(VARIANCE).alias("audit_status"),
    )


def step_close(raw_rows: DataFrame, valid_rows: DataFrame) -> DataFrame:
    """Close-out per step: rejected = raw - valid; FAILED when all went, PARTIAL when some did.

    Inputs carry `step_name` and are counted here.
    """
    raw = raw_rows.groupBy("step_name").agg(F.count(F.lit(1)).alias("rows_processed"))
    valid = valid_rows.groupBy("step_name").agg(F.count(F.lit(1)).alias("rows_inserted"))
    joined = raw.join(valid, "step_name", "left").fillna(0, ["rows_inserted"])
    return joined.withColumns(close_columns())


def close_columns(processed: str = "rows_processed", inserted: str = "rows_inserted") -> dict[str, Column]:
    rejected = F.greatest(F.col(processed) - F.col(inserted), F.lit(0))
    return {
        "rows_rejected": rejected,
        "status": F.when((F.col(processed) > 0) & (F.col(inserted) == 0), "FAILED")
        .when(rejected > 0, "PARTIAL")
        .otherwise("SUCCESS"),
    }


def close_stale_steps(log: DataFrame, step_name: str, now: Column) -> DataFrame:
    """A new run of a step marks its runs still RUNNING as FAILED."""
    stale = (F.col("step_name") == step_name) & (F.col("status") == "RUNNING")
    return log.withColumns(
        {
            "end_time": F.when(stale, now).otherwise(F.col("end_time")),
            "message": F.when(stale, STALE_MESSAGE).otherwise(F.col("message")),
            "status": F.when(stale, "FAILED").otherwise(F.col("status")),
        }
    )


def clear_step_errors(errors: DataFrame, batch_id: int, entity: str) -> DataFrame:
    """Drop the earlier errors of one batch and table before it runs again."""
    names = (f"raw_{entity}", f"ods_{entity}", entity)
    hit = (F.col("batch_id") == batch_id) & F.col("table_name").isin(*names)
    return errors.filter(~F.coalesce(hit, F.lit(False)))


def batch_close(batches: DataFrame, errors: DataFrame) -> DataFrame:
    """Distinct errored rows per batch decide PARTIAL or SUCCESS; failed batches stay as they are."""
    bad = errors.groupBy("batch_id").agg(F.count_distinct(errored_row()).alias("error_rows"))
    joined = batches.drop("error_records", "success_records").join(bad, "batch_id", "left")
    joined = joined.withColumn("error_records", F.coalesce("error_rows", F.lit(0)))
    total = F.coalesce("total_records", F.lit(0))
    open_batch = F.col("status").isin("RUNNING", "SUCCESS", "PARTIAL")
    return joined.filter(open_batch).withColumns(
        {
            "status": F.when(F.col("error_records") > 0, "PARTIAL").otherwise("SUCCESS"),
            "success_records": F.when(total >= F.col("error_records"), total - F.col("error_records")).otherwise(
                total
            ),
        }
    ).drop("error_rows")


def batch_ledger(raw_rows: DataFrame, errors: DataFrame) -> DataFrame:
    """Total, success and error rows per batch; success + error = total holds by construction."""
    total = raw_rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total_records"))
    bad = errors.groupBy("batch_id").agg(F.count_distinct(errored_row()).alias("bad"))
    joined = total.join(bad, "batch_id", "left")
    wrong = F.least(F.coalesce("bad", F.lit(0)), F.col("total_records"))
    return joined.select(
        "batch_id", "total_records", (F.col("total_records") - wrong).alias("success_records"),
        wrong.alias("error_records"), F.when(wrong > 0, "PARTIAL").otherwise("SUCCESS").alias("status"),
    )


def log_text(column: Column, what: str = "error") -> Column:
    """Message text cut to the column width; missing text is named as such."""
    return F.coalesce(F.nullif(F.substring(column, 1, TEXT_LIMIT), F.lit("")), F.lit(f"Unknown {what}"))


def error_rows(errors: DataFrame) -> DataFrame:
    return errors.withColumns(
        {
            "error_message": log_text(F.col("error_message")),
            "raw_value": F.nullif(F.substring("raw_value", 1, TEXT_LIMIT), F.lit("")),
        }
    )


def warning_rows(warnings: DataFrame) -> DataFrame:
    return warnings.withColumn("warning_message", log_text(F.col("warning_message"), "warning"))


def batch_metrics(
    batches: DataFrame, fact_order: DataFrame, customers: DataFrame, changes: DataFrame
) -> DataFrame:
    """Per batch: status, rows, cumulative warehouse totals, and its own dimension changes."""
    orders = fact_order.agg(F.count(F.lit(1)).alias("n")).scalar()
    current = customers.filter(F.col("is_current") & (F.col("customer_key") != -1)).agg(
        F.count(F.lit(1)).alias("n")
    ).scalar()
    changed = changes.groupBy("batch_id").agg(F.count(F.lit(1)).alias("scd2_changes"))
    return batches.join(changed, "batch_id", "left").select(
        "batch_id", "status", F.col("total_records").alias("stg_records"),
        orders.alias("dwh_orders"), current.alias("dwh_active_customers"),
        F.coalesce("scd2_changes", F.lit(0)).alias("scd2_changes"),
    )


def active_batch(batches: DataFrame, data: DataFrame) -> DataFrame:
    """Latest RUNNING or SUCCESS batch, else the highest batch in the data, else -1 (all batches)."""
    listed = batches.filter(F.col("status").isin("RUNNING", "SUCCESS")).agg(F.max("batch_id").alias("b"))
    found = data.agg(F.max("batch_id").alias("b"))
    positive = [
        F.when(c > 0, c) for c in (F.col("listed"), F.col("found"))
    ]
    return listed.select(F.col("b").alias("listed"), found.scalar().alias("found")).select(
        F.coalesce(*positive, F.lit(-1)).cast("long").alias("batch_id")
    )


def guardrails(raw_orders: DataFrame, ods_orders: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Per batch: raw orders without typed orders, and steps that failed in the two hours before `as_of`."""
    raw = raw_orders.groupBy("batch_id").agg(F.count(F.lit(1)).alias("raw_orders"))
    ods = ods_orders.groupBy("batch_id").agg(F.count(F.lit(1)).alias("ods_orders"))
    recent = (F.col("status") == "FAILED") & (F.col("start_time") >= as_of - F.expr("INTERVAL '2' HOUR"))
    failed = log.filter(recent).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        raw.join(ods, "batch_id", "left")
        .select(
            "batch_id", "raw_orders", F.coalesce("ods_orders", F.lit(0)).alias("ods_orders"),
            failed.alias("failed_steps"),
        )
        .withColumns(
            {
                "reconciliation_ok": ~((F.col("raw_orders") > 0) & (F.col("ods_orders") == 0)),
                "steps_ok": F.col("failed_steps") == 0,
            }
        )
    )


class GuardrailError(RuntimeError):
    """A guardrail check failed."""


def enforce_guardrails(checks: DataFrame) -> None:
    broken = checks.filter(~F.col("reconciliation_ok") | ~F.col("steps_ok")).limit(1).collect()
    if broken:
        raise GuardrailError(f"guardrail failed: {broken[0].asDict()}")
