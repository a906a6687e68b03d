"""Monitoring views, KPI measures, audits and retention over the mapped control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import calendar
from strataflow.operators import audits, dimensions, kpis, lookups, maintenance, monitoring
from strataflow.plans import queries_quality as Q
from strataflow.plans import queries_star as S
from strataflow.plans import source_maps as M
from strataflow.plans.registry import Source, fragment, query
from strataflow.spec import LOAD_ORDER

AS_OF = "2001-08-01 12:30:15"
NOW = f"TIMESTAMP '{AS_OF}'"


def now():
    return F.lit(AS_OF).cast("timestamp_ntz")


# Batches: one per month of orders, closed from its steps. -------------------------------------------------

_STATUS = "CASE WHEN max(o_totalprice) > 499700 THEN 'FAILED' WHEN max(o_totalprice) > 499000 THEN 'PARTIAL' WHEN max(o_totalprice) > 498000 THEN 'RUNNING' ELSE 'SUCCESS' END"
_BATCH_COLUMNS = {
    "pipeline_name": "'MONTHLY_BATCH'",
    "source_system": "CASE WHEN min(o_custkey) > 20 THEN 'Upload' ELSE CAST(NULL AS STRING) END",
    "source_file_count": "CAST(count(DISTINCT o_orderpriority) AS INT)",
    "start_time": "min(o_orderdate) + CAST(min(o_custkey) AS INT) * INTERVAL '1' MINUTE",
    "end_time": "CASE WHEN min(o_custkey) > 60 THEN NULL ELSE min(o_orderdate) + (CAST(min(o_custkey) AS INT) * 60 + CAST(count(*) AS INT)) * INTERVAL '1' SECOND END",
    "status": _STATUS,
    "total_records": "count(*)",
    "success_records": "count(*) - CAST(sum(CASE WHEN o_totalprice > 480000 THEN 1 ELSE 0 END) AS BIGINT)",
    "error_records": "CAST(sum(CASE WHEN o_totalprice > 480000 THEN 1 ELSE 0 END) AS BIGINT)",
}
_BATCH_KEY = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)"
fragment(
    "etl_batch",
    f"SELECT {_BATCH_KEY} AS batch_id, " + ", ".join(f"{e} AS {n}" for n, e in _BATCH_COLUMNS.items())
    + f" FROM orders GROUP BY {_BATCH_KEY}",
)


def etl_batch(src: Source) -> DataFrame:
    return src.once(
        "etl_batch",
        lambda: src.table("orders").groupBy(F.expr(_BATCH_KEY).alias("batch_id")).agg(
            *[F.expr(e).alias(n) for n, e in _BATCH_COLUMNS.items()]
        ),
    )


_SECONDS = "date_diff('second', date_trunc('second', start_time), date_trunc('second', {end}))"
fragment(
    "overview",
    "SELECT batch_id, pipeline_name, COALESCE(source_system, 'File Ingestion') AS source_system, source_file_count, start_time, end_time, "
    f"date_diff('second', start_time, COALESCE(end_time, {NOW})) AS duration_seconds, "
    f"round(date_diff('second', start_time, COALESCE(end_time, {NOW})) / 60.0::DOUBLE, 2) AS duration_minutes, status AS batch_status, "
    "total_records, success_records, error_records, "
    "CASE WHEN total_records > 0 THEN round(success_records::DOUBLE / total_records * 100.0::DOUBLE, 2) ELSE 100.0 END AS success_rate_pct, "
    "CASE WHEN total_records > 0 THEN round(error_records::DOUBLE / total_records * 100.0::DOUBLE, 2) ELSE 0.0 END AS error_rate_pct, "
    f"batch_id = (SELECT max(batch_id) FROM etl_batch) AS is_latest_batch, date_diff('hour', start_time, {NOW}) AS hours_since_run, "
    f"CASE WHEN status = 'SUCCESS' AND date_diff('hour', start_time, {NOW}) <= 24 THEN 'Healthy' WHEN status = 'RUNNING' THEN 'Running' "
    "WHEN status = 'PARTIAL' THEN 'Degraded (Partial)' WHEN status = 'FAILED' THEN 'Critical (Failed)' ELSE 'Warning (Stale >24h)' END AS pipeline_health_status FROM etl_batch",
)


def overview(src: Source) -> DataFrame:
    return monitoring.pipeline_overview(etl_batch(src), now())


@query("m1_pipeline_overview", "SELECT * REPLACE (CAST(start_time AS VARCHAR) AS start_time, CAST(end_time AS VARCHAR) AS end_time) FROM overview")
def pipeline_overview(src: Source) -> DataFrame:
    return overview(src)


_STEP_SECONDS = "date_diff('second', l.start_time, COALESCE(l.end_time, l.start_time))"
fragment(
    "steps",
    "SELECT l.log_id, l.batch_id, b.pipeline_name, l.process_name, l.step_name, l.start_time, l.end_time, "
    f"{_STEP_SECONDS} AS duration_seconds, round({_STEP_SECONDS} / 60.0::DOUBLE, 3) AS duration_minutes, l.status AS step_status, "
    "l.rows_processed, l.rows_inserted, l.rows_rejected, "
    "CASE WHEN l.rows_processed > 0 THEN round(l.rows_rejected::DOUBLE / l.rows_processed * 100.0::DOUBLE, 2) ELSE 0.0 END AS rejection_rate_pct, "
    f"CASE WHEN {_STEP_SECONDS} > 0 THEN round(l.rows_processed::DOUBLE / {_STEP_SECONDS}, 0) ELSE l.rows_processed::DOUBLE END AS throughput_rows_per_sec "
    "FROM etl_log l JOIN etl_batch b ON l.batch_id = b.batch_id",
)


def steps(src: Source) -> DataFrame:
    return monitoring.step_performance(src("etl_log"), etl_batch(src))


@query("m2_step_performance", "SELECT * REPLACE (CAST(start_time AS VARCHAR) AS start_time, CAST(end_time AS VARCHAR) AS end_time) FROM steps")
def step_performance(src: Source) -> DataFrame:
    return steps(src)


fragment(
    "errors_seen",
    "SELECT e.error_id, e.batch_id, b.pipeline_name, b.status AS batch_status, COALESCE(e.table_name, 'UNKNOWN') AS table_name, "
    "COALESCE(e.column_name, 'N/A') AS column_name, e.error_type, CASE WHEN e.error_type = 'MASTER_DATA_NOT_FOUND' THEN 'Referential Integrity (Orphan Record)' "
    "WHEN e.error_type = 'INVALID_FORMAT' THEN 'Data Type & Format Incompatibility' WHEN e.error_type LIKE '%NULL%' THEN 'Mandatory Field Null Violation' "
    "WHEN e.error_type LIKE '%DUPLICATE%' THEN 'Duplicate Business Key Violation' WHEN e.error_type = 'FILE_VALIDATION_ERROR' THEN 'Source File Structure & Validation' "
    "ELSE 'Other Data Quality Anomaly' END AS error_category, e.error_message, e.raw_value, e.source_file_name, e.source_row_number, e.error_timestamp "
    "FROM etl_error e LEFT JOIN etl_batch b ON e.batch_id = b.batch_id",
)


def errors_seen(src: Source) -> DataFrame:
    return monitoring.error_view(src("etl_error"), etl_batch(src))


@query("m3_error_view", "SELECT * REPLACE (CAST(error_timestamp AS VARCHAR) AS error_timestamp) FROM errors_seen")
def error_view(src: Source) -> DataFrame:
    return errors_seen(src)


fragment(
    "warnings_seen",
    "SELECT w.warning_id, w.batch_id, b.pipeline_name, w.step_name, COALESCE(w.table_name, 'N/A') AS table_name, w.order_id, w.entity_name, "
    "w.entity_id, w.warning_type, w.warning_message, w.warning_timestamp FROM etl_warning w LEFT JOIN etl_batch b ON w.batch_id = b.batch_id",
)


def warnings_seen(src: Source) -> DataFrame:
    return monitoring.warning_view(src("etl_warning"), etl_batch(src))


@query("m4_warning_view", "SELECT * REPLACE (CAST(warning_timestamp AS VARCHAR) AS warning_timestamp) FROM warnings_seen")
def warning_view(src: Source) -> DataFrame:
    return warnings_seen(src)


# Layers: raw holds everything, the typed layer what is not in dispute, the warehouse what is settled. -------

_LAYERS = {
    "Customer": ("ods_customer", "true", "true"),
    "Order": ("ods_order", "NOT is_cancelled", "NOT is_cancelled"),
    "Order Item": ("lines", "quantity < 49", "quantity < 48"),
    "Delivery Performance": ("ods_delivery_performance", "actual_delivery_time_min IS NOT NULL", "actual_delivery_time_min IS NOT NULL"),
    "Rating": ("ods_rating", "review_text IS NOT NULL", "review_text IS NOT NULL"),
}
_ENTITIES = monitoring.ENTITY_LABELS


def _layer_sql(pick: int) -> str:
    return " UNION ALL ".join(
        f"SELECT batch_id, '{label}' AS entity_name, count(*) AS cnt FROM {spec[0]} WHERE {'true' if pick == 0 else spec[pick]} GROUP BY batch_id"
        for label, spec in _LAYERS.items()
    )


def _entity_case(column: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in pairs) + " ELSE 'Other' END"


_ERROR_ENTITY = _entity_case("table_name", [(f"table_name LIKE '%{f.replace('_', chr(92) + '_')}%' ESCAPE '{chr(92)}'", n) for f, n in monitoring.TABLE_FRAGMENTS])
_WARN_ENTITY = _entity_case("entity_name", [(f"entity_name = '{n.upper().replace(' ', '_')}'", n) for n in _ENTITIES])
_ERRORED = "COALESCE(source_file_name || '|' || CAST(source_row_number AS VARCHAR), CAST(error_id AS VARCHAR))"
fragment(
    "recon",
    "SELECT row_number() OVER (ORDER BY g.batch_id, g.entity_name) AS reconciliation_id, g.batch_id, g.entity_name, COALESCE(r.cnt, 0) AS raw_rows, "
    "COALESCE(o.cnt, 0) AS ods_rows, COALESCE(d.cnt, 0) AS dwh_rows, COALESCE(r.cnt, 0) - COALESCE(o.cnt, 0) AS raw_to_ods_variance, "
    "COALESCE(o.cnt, 0) - COALESCE(d.cnt, 0) AS ods_to_dwh_variance, COALESCE(e.n, 0) AS quarantined_error_rows, COALESCE(w.n, 0) AS warning_rows, "
    "CASE WHEN COALESCE(r.cnt, 0) > 0 THEN round(COALESCE(d.cnt, 0)::DOUBLE / r.cnt * 100.0::DOUBLE, 2) ELSE 100.0 END AS data_retention_rate_pct, "
    "CASE WHEN (COALESCE(r.cnt, 0) - COALESCE(o.cnt, 0) = COALESCE(e.n, 0) OR COALESCE(r.cnt, 0) - COALESCE(o.cnt, 0) = 0) AND COALESCE(o.cnt, 0) - COALESCE(d.cnt, 0) = 0 "
    "THEN 'RECONCILED (Valid Audit)' ELSE 'VARIANCE DETECTED' END AS audit_status "
    "FROM (SELECT b.batch_id, n.entity_name FROM etl_batch b, (VALUES " + ", ".join(f"('{n}')" for n in _ENTITIES) + ") n(entity_name)) g "
    f"LEFT JOIN ({_layer_sql(0)}) r ON r.batch_id = g.batch_id AND r.entity_name = g.entity_name "
    f"LEFT JOIN ({_layer_sql(1)}) o ON o.batch_id = g.batch_id AND o.entity_name = g.entity_name "
    f"LEFT JOIN ({_layer_sql(2)}) d ON d.batch_id = g.batch_id AND d.entity_name = g.entity_name "
    f"LEFT JOIN (SELECT batch_id, {_ERROR_ENTITY} AS entity_name, count(DISTINCT {_ERRORED}) AS n FROM etl_error GROUP BY 1, 2) e ON e.batch_id = g.batch_id AND e.entity_name = g.entity_name "
    f"LEFT JOIN (SELECT batch_id, {_WARN_ENTITY} AS entity_name, count(*) AS n FROM etl_warning GROUP BY 1, 2) w ON w.batch_id = g.batch_id AND w.entity_name = g.entity_name",
)


def recon(src: Source) -> DataFrame:
    def layer(pick: int) -> dict[str, DataFrame]:
        return {
            label: src(spec[0]) if pick == 0 else src(spec[0]).filter(spec[pick]) for label, spec in _LAYERS.items()
        }

    return src.once(
        "recon",
        lambda: monitoring.layer_reconciliation(
            etl_batch(src), layer(0), layer(1), layer(2), src("etl_error"), src("etl_warning")
        ),
    )


@query("m5_layer_reconciliation", "SELECT * REPLACE (CAST(reconciliation_id AS INTEGER) AS reconciliation_id) FROM recon")
def layer_reconciliation(src: Source) -> DataFrame:
    return recon(src)


@query(
    "m6_scd2_audit",
    "SELECT c.batch_id, b.pipeline_name, c.dimension_name, c.business_id, c.surrogate_key_old, c.surrogate_key_new, c.change_type, c.column_name, "
    "c.old_value, c.new_value, CAST(c.effective_date AS VARCHAR) AS effective_date FROM dim_change_log c LEFT JOIN etl_batch b ON c.batch_id = b.batch_id",
)
def scd2_audit(src: Source) -> DataFrame:
    return monitoring.scd2_audit_view(src("dim_change_log"), etl_batch(src))


@query(
    "m7_step_close",
    "SELECT *, CASE WHEN rows_processed > 0 AND rows_inserted = 0 THEN 'FAILED' WHEN rows_rejected > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM ("
    "SELECT step_name, rows_processed, COALESCE(v, 0) AS rows_inserted, greatest(rows_processed - COALESCE(v, 0), 0) AS rows_rejected FROM ("
    + " UNION ALL ".join(f"SELECT 'LOAD_ODS_{e.upper()}' AS step_name, (SELECT count(*) FROM raw_{e}) AS rows_processed, (SELECT count(*) FROM clean_{e}) AS v" for e in LOAD_ORDER)
    + "))",
)
def step_close(src: Source) -> DataFrame:
    """Steps of all entities, closed from the raw and the clean rows."""
    raw = valid = None
    for entity in LOAD_ORDER:
        step = F.lit(f"LOAD_ODS_{entity.upper()}").alias("step_name")
        r, v = src(f"raw_{entity}").select(step), Q.cleaned(src, entity).select(step)
        raw, valid = (r, v) if raw is None else (raw.unionByName(r), valid.unionByName(v))
    return monitoring.step_close(raw, valid)


_RESTARTED = "LOAD_URGENT_F"


@query(
    "m8_step_start",
    "SELECT log_id, step_name, CASE WHEN stale THEN 'FAILED' ELSE status END AS status, CASE WHEN stale THEN '" + AS_OF + "' ELSE CAST(end_time AS VARCHAR) END AS end_time, "
    "CASE WHEN stale THEN 'A newer run took the place of this one' ELSE message END AS message, "
    "(SELECT count(*) FROM etl_error WHERE NOT (batch_id = 199806 AND table_name = 'raw_order' AND table_name IS NOT NULL) OR table_name IS NULL) AS errors_left "
    f"FROM (SELECT *, step_name = '{_RESTARTED}' AND status = 'RUNNING' AS stale FROM etl_log)",
)
def step_start(src: Source) -> DataFrame:
    """A step starts again: its running runs are aborted and its earlier errors cleared."""
    left = monitoring.clear_step_errors(src("etl_error"), 199806, "order").agg(F.count(F.lit(1)).alias("n")).scalar()
    return monitoring.close_stale_steps(src("etl_log"), _RESTARTED, now()).select(
        "log_id", "step_name", "status", "end_time", "message", left.alias("errors_left")
    )


@query(
    "m9_batch_close",
    "SELECT b.batch_id, b.total_records, COALESCE(e.n, 0) AS error_records, CASE WHEN COALESCE(e.n, 0) > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, "
    "CASE WHEN b.total_records >= COALESCE(e.n, 0) THEN b.total_records - COALESCE(e.n, 0) ELSE b.total_records END AS success_records "
    f"FROM etl_batch b LEFT JOIN (SELECT batch_id, count(DISTINCT {_ERRORED}) AS n FROM etl_error GROUP BY 1) e ON e.batch_id = b.batch_id WHERE b.status IN ('RUNNING', 'SUCCESS', 'PARTIAL')",
)
def batch_close(src: Source) -> DataFrame:
    return monitoring.batch_close(etl_batch(src), src("etl_error")).select(
        "batch_id", "total_records", "error_records", "status", "success_records"
    )


@query(
    "m10_batch_ledger",
    "SELECT batch_id, total_records, total_records - error_records AS success_records, error_records, CASE WHEN error_records > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM ("
    f"SELECT t.batch_id, t.n AS total_records, least(COALESCE(e.n, 0), t.n) AS error_records FROM (SELECT batch_id, count(*) AS n FROM lines GROUP BY 1) t "
    f"LEFT JOIN (SELECT batch_id, count(DISTINCT {_ERRORED}) AS n FROM etl_error GROUP BY 1) e ON e.batch_id = t.batch_id)",
)
def batch_ledger(src: Source) -> DataFrame:
    return monitoring.batch_ledger(src("lines"), src("etl_error"))


@query(
    "m11_log_rows",
    "SELECT 'error' AS kind, error_id AS id, COALESCE(NULLIF(substring(error_message, 1, 4000), ''), 'Unknown error') AS message, NULLIF(substring(raw_value, 1, 4000), '') AS raw_value FROM etl_error "
    "UNION ALL SELECT 'warning', warning_id, COALESCE(NULLIF(substring(warning_message, 1, 4000), ''), 'Unknown warning'), NULL FROM etl_warning "
    "UNION ALL SELECT 'text', doc_id, COALESCE(NULLIF(substring(text, 1, 4000), ''), 'Unknown error'), NULL FROM documents",
)
def log_rows(src: Source) -> DataFrame:
    """Log texts at their column width: errors, warnings, and whole documents as the longest messages."""
    none = F.lit(None).cast("string").alias("raw_value")
    errors = monitoring.error_rows(src("etl_error")).select(
        F.lit("error").alias("kind"), F.col("error_id").alias("id"), F.col("error_message").alias("message"), "raw_value"
    )
    warned = monitoring.warning_rows(src("etl_warning")).select(
        F.lit("warning").alias("kind"), F.col("warning_id").alias("id"), F.col("warning_message").alias("message"), none
    )
    texts = src.table("documents").select(
        F.lit("text").alias("kind"), F.col("doc_id").alias("id"),
        monitoring.log_text(F.col("text")).alias("message"), none,
    )
    return errors.unionByName(warned).unionByName(texts)


@query(
    "m12_batch_metrics",
    "SELECT b.batch_id, b.status, b.total_records AS stg_records, (SELECT count(*) FROM orders) AS dwh_orders, "
    "(SELECT count(*) FROM dim_customer WHERE is_current AND customer_key <> -1) AS dwh_active_customers, "
    "(SELECT count(*) FROM dim_change_log c WHERE c.batch_id = b.batch_id) AS scd2_changes FROM etl_batch b",
)
def batch_metrics(src: Source) -> DataFrame:
    return monitoring.batch_metrics(etl_batch(src), src("ods_order"), src("dim_customer"), src("dim_change_log"))


@query(
    "m13_active_batch",
    "SELECT CAST(COALESCE((SELECT max(batch_id) FROM etl_batch WHERE status IN ('RUNNING', 'SUCCESS') AND batch_id > 0), (SELECT max(batch_id) FROM ods_order WHERE batch_id > 0), -1) AS BIGINT) AS batch_id",
)
def active_batch(src: Source) -> DataFrame:
    return monitoring.active_batch(etl_batch(src), src("ods_order"))


@query(
    "m14_guardrails",
    "SELECT r.batch_id, r.n AS raw_orders, COALESCE(o.n, 0) AS ods_orders, f.n AS failed_steps, NOT (r.n > 0 AND COALESCE(o.n, 0) = 0) AS reconciliation_ok, f.n = 0 AS steps_ok "
    "FROM (SELECT batch_id, count(*) AS n FROM ods_order GROUP BY 1) r LEFT JOIN (SELECT batch_id, count(*) AS n FROM before_order GROUP BY 1) o ON o.batch_id = r.batch_id, "
    "(SELECT count(*) AS n FROM etl_log WHERE status = 'FAILED' AND start_time >= TIMESTAMP '2001-08-01 02:00:00' - INTERVAL 2 HOUR) f",
)
def guardrails(src: Source) -> DataFrame:
    night = F.lit("2001-08-01 02:00:00").cast("timestamp_ntz")
    return monitoring.guardrails(src("ods_order"), src("before_order"), src("etl_log"), night)


# KPI measures ---------------------------------------------------------------------------------------------

@query(
    "p1_latest_batch",
    "SELECT batch_id AS latest_batch_id, batch_status AS latest_batch_status, duration_seconds AS latest_batch_duration, total_records AS latest_batch_records, "
    "error_records AS latest_batch_errors FROM overview ORDER BY batch_id DESC LIMIT 1",
)
def latest_batch(src: Source) -> DataFrame:
    return kpis.latest_batch(overview(src))


@query(
    "p1_selected_batch",
    "SELECT batch_id AS latest_batch_id, batch_status AS latest_batch_status, duration_seconds AS latest_batch_duration, total_records AS latest_batch_records, "
    "error_records AS latest_batch_errors FROM overview WHERE batch_id = 199806",
)
def selected_batch(src: Source) -> DataFrame:
    return kpis.latest_batch(overview(src), 199806)


@query(
    "p2_hours_since_run",
    f"SELECT date_diff('hour', arg_max(start_time, batch_id), {NOW}) AS hours_since_last_run FROM etl_batch",
)
def hours_since_run(src: Source) -> DataFrame:
    return kpis.hours_since_run(etl_batch(src), now())


def _totals(where: str) -> str:
    return (
        f"SELECT (SELECT count(*) FROM etl_error {where}) AS total_quarantined_errors, (SELECT count(*) FROM etl_warning {where}) AS total_operational_warnings, "
        f"(SELECT count(*) FROM dim_change_log {where}) AS total_dimension_changes, (SELECT count(*) FROM recon {where}) AS total_reconciliation_checks, "
        f"(SELECT count(*) FROM steps {where}) AS total_steps"
    )


def _row_totals(src: Source, batch_id: int | None) -> DataFrame:
    return kpis.row_totals(
        src("etl_error"), src("etl_warning"), src("dim_change_log"), recon(src), steps(src), batch_id
    )


@query("p3_row_totals", _totals(""))
def row_totals(src: Source) -> DataFrame:
    return _row_totals(src, None)


@query("p3_row_totals_of_batch", _totals("WHERE batch_id = 199806"))
def row_totals_of_batch(src: Source) -> DataFrame:
    return _row_totals(src, 199806)


def _sum_of(column: str, table: str, name: str | None = None) -> str:
    return f"(SELECT CAST(COALESCE(sum({column}), 0) AS BIGINT) FROM {table}) AS {name or column}"


@query(
    "p4_sums",
    "SELECT " + ", ".join(
        (
            _sum_of("duration_seconds", "overview", "batch_duration_sec"), _sum_of("total_records", "overview", "batch_total_records"),
            _sum_of("rows_processed", "steps", "total_step_rows_processed"), _sum_of("rows_rejected", "steps", "total_step_rows_rejected"),
            _sum_of("rows_inserted", "steps", "total_step_rows_inserted"), _sum_of("duration_seconds", "steps", "total_step_duration_sec"),
            _sum_of("raw_rows", "recon", "total_records_ingested_raw"), _sum_of("ods_rows", "recon", "total_records_staged_ods"),
            _sum_of("dwh_rows", "recon", "total_records_loaded_dwh"), _sum_of("raw_to_ods_variance", "recon", "total_raw_to_ods_variance"),
            _sum_of("ods_to_dwh_variance", "recon", "total_ods_to_dwh_variance"), _sum_of("quarantined_error_rows", "recon", "total_reconciliation_errors"),
        )
    ),
)
def sums(src: Source) -> DataFrame:
    return kpis.sums(overview(src), steps(src), recon(src))


def _share(part: str, whole: str) -> str:
    return f"COALESCE(CAST(({part}) AS DOUBLE) / NULLIF(CAST(({whole}) AS DOUBLE), 0), 0.0)"


_RAW, _ODS, _DWH = (f"SELECT sum({c}) FROM recon" for c in ("raw_rows", "ods_rows", "dwh_rows"))


@query(
    "p5_ratios",
    f"SELECT {_share(_DWH, _RAW)} AS overall_data_retention_rate, {_share('SELECT sum(rows_rejected) FROM steps', 'SELECT sum(rows_processed) FROM steps')} AS step_rejection_rate, "
    f"{_share('SELECT count(*) FROM etl_error', _RAW)} AS quarantined_error_rate, {_share('SELECT count(*) FROM etl_warning', _ODS)} AS operational_warning_rate, "
    f"{_share('SELECT sum(rows_inserted) FROM steps', 'SELECT sum(rows_processed) FROM steps')} AS step_yield",
)
def ratios(src: Source) -> DataFrame:
    return kpis.ratios(steps(src), recon(src), src("etl_error"), src("etl_warning"))


@query(
    "p6_throughput",
    "WITH t AS (SELECT batch_id, COALESCE(total_records::DOUBLE / NULLIF(duration_seconds::DOUBLE, 0), 0.0) AS r FROM overview), "
    "x AS (SELECT (SELECT COALESCE(round(avg(throughput_rows_per_sec), 4), 0.0) FROM steps) AS step_throughput, (SELECT arg_max(r, batch_id) FROM t) AS batch_throughput, (SELECT median(r) FROM t) AS median_batch_throughput) "
    "SELECT *, CASE WHEN batch_throughput > median_batch_throughput * 1.05::DOUBLE THEN 'Above' WHEN batch_throughput < median_batch_throughput * 0.95::DOUBLE THEN 'Below' ELSE 'Near' END AS throughput_vs_median FROM x",
)
def throughput(src: Source) -> DataFrame:
    return kpis.throughput(steps(src), overview(src)).withColumn("step_throughput", F.round("step_throughput", 4))


@query(
    "p7_step_statuses",
    "SELECT count(*) AS total_steps, " + ", ".join(
        f"CAST(sum(CASE WHEN step_status = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS steps_{s.lower()}" for s in kpis.STEP_STATUSES
    ) + ", COALESCE(avg(duration_seconds), 0.0) AS avg_step_seconds, CASE WHEN count(*) = 0 THEN 'No Data' WHEN avg(duration_seconds) < 1 THEN 'Fast' "
    "WHEN avg(duration_seconds) <= 3 THEN 'Moderate' ELSE 'Slow' END AS step_time_band FROM steps",
)
def step_statuses(src: Source) -> DataFrame:
    return kpis.step_statuses(steps(src))


@query(
    "p8_heaviest_stage",
    "WITH s AS (SELECT process_name, CAST(sum(duration_seconds) AS BIGINT) AS sec, sum(rows_processed) AS n FROM steps GROUP BY 1), "
    "x AS (SELECT process_name AS top_stage, sec AS stage_seconds, sec::DOUBLE / (SELECT sum(sec) FROM s) AS stage_share, (SELECT count(*) FROM s) AS stage_count FROM s ORDER BY sec DESC, n DESC, process_name DESC LIMIT 1) "
    "SELECT *, CASE WHEN stage_share > 0.50 THEN 'Critical' WHEN stage_share >= 0.35 THEN 'Warning' ELSE 'Normal' END AS stage_band FROM x",
)
def heaviest_stage(src: Source) -> DataFrame:
    return kpis.heaviest_stage(steps(src))


def _distinct(column: str, table: str, name: str) -> str:
    return f"(SELECT count(DISTINCT {column}) FROM {table}) AS {name}"


@query(
    "p9_distinct_counts",
    "SELECT " + ", ".join(
        (
            _distinct("source_file_name", "errors_seen", "affected_files"), _distinct("column_name", "errors_seen", "violated_columns"),
            _distinct("error_type", "errors_seen", "triggered_rules"), _distinct("error_category", "errors_seen", "error_categories"),
            _distinct("table_name", "errors_seen", "error_tables"), _distinct("table_name", "warnings_seen", "warning_tables"),
            _distinct("warning_type", "warnings_seen", "warning_types"), _distinct("entity_name", "recon", "total_tables"),
            _distinct("step_name", "steps", "total_step_names"), _distinct("step_name", "steps WHERE rows_rejected > 0", "rejecting_steps"),
            _distinct("business_id", "dim_change_log", "changed_keys"), _distinct("dimension_name", "dim_change_log", "changed_dimensions"),
            _distinct("column_name", "dim_change_log", "changed_attributes"),
        )
    ),
)
def distinct_counts(src: Source) -> DataFrame:
    return kpis.distinct_counts(errors_seen(src), warnings_seen(src), steps(src), src("dim_change_log"), recon(src))


@query(
    "p10_rejected_rows",
    "WITH x AS (SELECT (SELECT count(*) FROM errors_seen) AS total_errors, (SELECT count(*) FROM (SELECT DISTINCT batch_id, table_name, source_file_name, source_row_number FROM errors_seen)) AS rejected_rows) "
    "SELECT *, greatest(total_errors - rejected_rows, 0) AS multi_fault FROM x",
)
def rejected_rows(src: Source) -> DataFrame:
    return kpis.rejected_rows(errors_seen(src))


@query(
    "p11_true_defects",
    "SELECT count(*) AS total_errors, CAST(sum(CASE WHEN error_type <> 'EXCLUDED_ORDER_CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS true_defects, "
    "CAST(sum(CASE WHEN error_type = 'EXCLUDED_ORDER_CANCELLED' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_orders, "
    "sum(CASE WHEN error_type <> 'EXCLUDED_ORDER_CANCELLED' THEN 1 ELSE 0 END)::DOUBLE / count(*)::DOUBLE AS defect_impact FROM etl_error",
)
def true_defects(src: Source) -> DataFrame:
    return kpis.true_defects(src("etl_error"))


@query(
    "p12_variance_measures",
    "SELECT CAST(greatest(0, sum(raw_to_ods_variance) - sum(quarantined_error_rows)) AS BIGINT) AS deduped_rows, CAST(greatest(0, -sum(ods_to_dwh_variance)) AS BIGINT) AS scd2_added, "
    "CAST(sum(greatest(ods_to_dwh_variance, 0)) AS BIGINT) AS unaccounted_loss, CAST(sum(CASE WHEN audit_status = 'RECONCILED (Valid Audit)' THEN 1 ELSE 0 END) AS BIGINT) AS exact_checks, "
    "CAST(sum(CASE WHEN audit_status <> 'RECONCILED (Valid Audit)' THEN 1 ELSE 0 END) AS BIGINT) AS variance_checks FROM recon",
)
def variance_measures(src: Source) -> DataFrame:
    return kpis.variance_measures(recon(src))


def _band(rate: str) -> str:
    return f"CASE WHEN {rate} <= 0.02 THEN 'Normal' WHEN {rate} <= 0.05 THEN 'Warning' ELSE 'Critical' END"


@query(
    "p13_health_bands",
    f"WITH x AS (SELECT {_share('SELECT count(*) FROM etl_error', _RAW)} AS error_rate, {_share('SELECT count(*) FROM etl_warning', _ODS)} AS warning_rate, "
    f"{_share(_DWH, _RAW)} AS retention_rate, CAST(({_DWH}) - ({_RAW}) AS BIGINT) AS net_difference) "
    f"SELECT *, {_band('error_rate')} AS error_band, {_band('warning_rate')} AS warning_band, CASE WHEN retention_rate >= 0.98 THEN 'Healthy' WHEN retention_rate >= 0.95 THEN 'Moderate' ELSE 'Low' END AS retention_band FROM x",
)
def health_bands(src: Source) -> DataFrame:
    return kpis.health_bands(src("etl_error"), src("etl_warning"), recon(src))


# Audits ---------------------------------------------------------------------------------------------------

def _check(test: str, entity: str, expected: str, actual: str, ok: str, tail: str = "") -> str:
    return (
        f"SELECT '{test}' AS test_name, {entity} AS entity_name, {expected} AS expected_value, {actual} AS actual_value, "
        f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status {tail}"
    )


def _none(test: str, entity: str, unit: str, count_sql: str) -> str:
    return _check(test, f"'{entity}'", f"'0 {unit}'", f"CAST(n AS VARCHAR) || ' {unit}'", "n = 0", f"FROM ({count_sql}) q(n)")


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


@query("t1_batch_status", _check("Batch status", "'batch ' || batch_id", "'RUNNING / SUCCESS / PARTIAL'", "status", "status IN ('RUNNING', 'SUCCESS', 'PARTIAL')", "FROM etl_batch"))
def batch_status(src: Source) -> DataFrame:
    return audits.batch_status(etl_batch(src))


_LOGGED = "SELECT 'LOAD_RAW_' || entity AS step_name, n AS rows_inserted, 1 AS log_id, 'SUCCESS' AS status"
_RAW_TABLES = ("customer", "restaurant", "delivery_partner", "menu_item", "order", "order_item", "delivery_performance", "rating")


@query(
    "t2_raw_vs_log",
    " UNION ALL ".join(
        _check(
            "Row count reconciliation (RAW vs Log)", f"'{e}'", "'Logged rows = ' || " + ("'NULL'" if e == "rating" else "CAST(l AS VARCHAR)"), "'RAW rows = ' || CAST(n AS VARCHAR)",
            "false" if e == "rating" else "n > 0 AND n = l",
            f"FROM (SELECT (SELECT count(*) FROM raw_{e}), (SELECT count(*) FROM {b})) q(n, l)",
        )
        for e, b in zip(_RAW_TABLES, ("customer", "supplier", "supplier", "part", "orders", "lineitem", "lineitem", "events"))
    ),
)
def raw_vs_log(src: Source) -> DataFrame:
    """The log holds the rows of the base tables; the resubmitted customers differ, ratings logged nothing."""
    base = dict(zip(_RAW_TABLES, ("customer", "supplier", "supplier", "part", "orders", "lineitem", "lineitem", "events")))
    log = None
    for entity, table in base.items():
        part = src.table(table).agg(F.count(F.lit(1)).alias("rows_inserted")).select(
            F.lit("LOAD_RAW_" + entity.upper()).alias("step_name"), "rows_inserted", F.lit(1).alias("log_id"),
            F.lit("RUNNING" if entity == "rating" else "SUCCESS").alias("status"),
        )
        log = part if log is None else log.unionByName(part)
    return audits.raw_vs_log({e: src(f"raw_{e}") for e in _RAW_TABLES}, log)


def _union_checks(build) -> str:
    return " UNION ALL ".join(build(e) for e in _RAW_TABLES)


@query(
    "t3_lineage_unique",
    _union_checks(lambda e: _none("Lineage key uniqueness in RAW", e, "duplicates", f"SELECT count(*) FROM (SELECT 1 FROM raw_{e} GROUP BY batch_id, source_file_name, source_row_number HAVING count(*) > 1)")),
)
def lineage_unique(src: Source) -> DataFrame:
    return audits.union(audits.lineage_unique(e, src(f"raw_{e}")) for e in _RAW_TABLES)


@query(
    "t4_metadata_complete",
    _union_checks(lambda e: _none("Metadata completeness in RAW", e, "invalid records", f"SELECT count(*) FROM raw_{e} WHERE {_blank('source_file_name')} OR source_row_number IS NULL OR source_row_number < 2")),
)
def metadata_complete(src: Source) -> DataFrame:
    return audits.union(audits.metadata_complete(e, src(f"raw_{e}")) for e in _RAW_TABLES)


_KEYS = {e: Q.ENTITIES[e].key for e in _RAW_TABLES}


@query(
    "t5_business_key_present",
    _union_checks(lambda e: _none("Business Key completeness", e, f"NULL/empty {_KEYS[e]}", f"SELECT count(*) FROM raw_{e} WHERE {_blank(_KEYS[e])}")),
)
def business_key_present(src: Source) -> DataFrame:
    return audits.union(audits.key_present(e, src(f"raw_{e}"), k) for e, k in _KEYS.items())


_TIMED = " AND ".join(f"NOT {_blank(c)}" for c in ("prep_time", "rider_wait_time", "travel_time"))


@query(
    "t6_added_columns",
    " UNION ALL ".join(
        _none("New column presence: onboard_date", e, "NULL/empty onboard_date", f"SELECT count(*) FROM raw_{e} WHERE {_blank('onboard_date')}")
        for e in ("restaurant", "delivery_partner")
    )
    + " UNION ALL "
    + _check("New timing metrics populated", "'delivery_performance'", "'> 0 populated rows'", "CAST(n AS VARCHAR) || ' populated rows of ' || CAST(t AS VARCHAR) || ' total'", "t = 0 OR n > 0",
             f"FROM (SELECT (SELECT count(*) FROM raw_delivery_performance WHERE {_TIMED}), (SELECT count(*) FROM raw_delivery_performance)) q(n, t)"),
)
def added_columns(src: Source) -> DataFrame:
    return audits.union(
        (
            audits.column_filled("restaurant", src("raw_restaurant"), "onboard_date"),
            audits.column_filled("delivery_partner", src("raw_delivery_partner"), "onboard_date"),
            audits.timings_populated(src("raw_delivery_performance")),
        )
    )


@query(
    "t7_row_balance",
    " UNION ALL ".join(
        "SELECT test_name, entity_name, expected_value, actual_value, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
        f"WITH q AS (SELECT (SELECT count(*) FROM raw_{e}) AS r, (SELECT count(*) FROM clean_{e}) AS v, (SELECT count(*) FROM (SELECT DISTINCT batch_id, source_file_name, source_row_number FROM err_{e})) AS b) "
        f"SELECT 'Row count reconciliation' AS test_name, '{e}' AS entity_name, 'RAW = ' || r AS expected_value, 'Valid = ' || v || ' | Rejected = ' || (r - v) AS actual_value, r >= v AS ok FROM q "
        f"UNION ALL SELECT 'Audit log completeness', '{e}', (r - v) || ' rejected rows', b || ' errored rows', r - v = b FROM q)"
        for e in LOAD_ORDER
    ),
)
def row_balance(src: Source) -> DataFrame:
    return audits.union(
        audits.row_balance(e, src(f"raw_{e}"), *Q.outcome(src, e)) for e in LOAD_ORDER
    )


_UNIQUE = {"lines": "order_item_id", "ods_customer": "customer_id", "ods_order": "order_id", "ods_restaurant": "restaurant_id", "ods_delivery_partner": "delivery_partner_id"}
_FILLED = {**_UNIQUE, "ods_menu_item": "menu_item_id", "ods_delivery_performance": "delivery_id", "ods_rating": "rating_id"}


@query(
    "t8_typed_keys",
    " UNION ALL ".join(
        [_none("Business Key Uniqueness", t, "duplicates", f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1)") for t, k in _UNIQUE.items()]
        + [_none("Business Key Integrity", t, f"NULL/empty {k}", f"SELECT count(*) FROM {t} WHERE {_blank(k)}") for t, k in _FILLED.items()]
    ),
)
def typed_keys(src: Source) -> DataFrame:
    """Line numbers do repeat before the last-row-per-key rule, so that check fails on purpose."""
    unique = [audits.key_unique(t, src(t), [k]) for t, k in _UNIQUE.items()]
    filled = [audits.key_present(t, src(t), k, "Business Key Integrity") for t, k in _FILLED.items()]
    return audits.union(unique + filled)


_AUDITED = {
    "raw_customer": ["customer_id", "city"], "ods_customer": ["customer_id", "city"], "ods_restaurant": ["restaurant_id", "city"],
    "ods_delivery_partner": ["delivery_partner_id", "city"], "ods_menu_item": ["menu_item_id", "item_name"], "ods_order": ["order_id", "customer_id"],
    "lines": ["order_item_id", "order_id"], "ods_delivery_performance": ["delivery_id", "order_id"], "ods_rating": ["rating_id", "order_id"],
}


@query(
    "t9_whitespace_and_audit_columns",
    " UNION ALL ".join(
        [
            _none("Trimming validation", t, "untrimmed rows", f"SELECT count(*) FROM {t} WHERE " + " OR ".join(f"{c} <> trim({c})" for c in cs))
            for t, cs in _AUDITED.items()
        ]
        + [_none("Audit Metadata completeness", "etl_error", "missing audit cols", "SELECT count(*) FROM etl_error WHERE batch_id IS NULL OR source_file_name IS NULL OR error_timestamp IS NULL")]
    ),
)
def whitespace_and_audit_columns(src: Source) -> DataFrame:
    parts = [audits.trimmed(t, src(t), cs) for t, cs in _AUDITED.items()]
    parts.append(audits.audit_columns("etl_error", src("etl_error"), ["batch_id", "source_file_name", "error_timestamp"]))
    return audits.union(parts)


def _members(src: Source) -> dict[str, tuple[DataFrame, str]]:
    spark = src.spark
    out = {n: (dimensions.empty_dimension(spark, n).unionByName(src(n)), k) for n, k in (
        ("dim_customer", "customer_key"), ("dim_restaurant", "restaurant_key"),
        ("dim_delivery_partner", "delivery_partner_key"), ("dim_menu_item", "menu_item_key"),
    )}
    out["dim_date"] = (S.cal(src), "date_key")
    out["dim_time"] = (calendar.dim_time(spark), "time_key")
    # The order table carries no unknown member.
    out["orders"] = (src.table("orders"), "o_orderkey")
    return out


@query(
    "t10_unknown_members",
    " UNION ALL ".join(
        f"SELECT 'Unknown Member (-1) Integrity' AS test_name, '{n}' AS entity_name, '1 Unknown Member present' AS expected_value, '{c} Unknown Member present' AS actual_value, '{s}' AS status"
        for n, c, s in [(d, 1, "PASS") for d in ("dim_customer", "dim_restaurant", "dim_delivery_partner", "dim_menu_item", "dim_date", "dim_time")] + [("orders", 0, "FAIL")]
    ),
)
def unknown_members(src: Source) -> DataFrame:
    return audits.unknown_members(_members(src))


_FACT_KEYS = ["order_date_key", "customer_key", "restaurant_key", "delivery_partner_key"]


_ITEM_KEYS = ["order_date_key", "customer_key", "restaurant_key", "menu_item_key"]
_KEYED_BY = {"customer_key": "dim_customer", "restaurant_key": "dim_restaurant", "delivery_partner_key": "dim_delivery_partner", "menu_item_key": "dim_menu_item"}
_KEYED_FACTS = {"fact_order": ("fact_order_all", _FACT_KEYS), "fact_order_item": ("fact_item_all", _ITEM_KEYS)}


def _orphans_sql(fact: str, table: str, key: str) -> str:
    if key == "order_date_key":
        return _none("Fact Logical Integrity (No Orphans)", f"{fact} -> dim_date", "orphan records", f"SELECT count(*) FROM {table} WHERE {key} <> -1 AND {key} NOT BETWEEN 19940101 AND 20010630")
    dimension = _KEYED_BY[key]
    return _none("Fact Logical Integrity (No Orphans)", f"{fact} -> {dimension}", "orphan records", f"SELECT count(*) FROM {table} WHERE {key} NOT IN (SELECT {key} FROM {dimension})")


@query(
    "t11_fact_keys",
    " UNION ALL ".join(
        [_orphans_sql(f, t, k) for f, (t, keys) in _KEYED_FACTS.items() for k in keys]
        + [_none("Fact Surrogate Keys Nullability", f, "null FKs", f"SELECT count(*) FROM {t} WHERE " + " OR ".join(f"{k} IS NULL" for k in keys)) for f, (t, keys) in _KEYED_FACTS.items()]
    ),
)
def fact_keys(src: Source) -> DataFrame:
    """The mapped dimensions lack the unknown member, so facts that point to it show up as orphans."""
    S.stored_orders(src, "ods_order")
    made = {"fact_order": S.orders_fact(src), "fact_order_item": src.stored("fact_order_item", lambda: S.items_fact(src).select(*_ITEM_KEYS))}
    parts = []
    for fact, (_, keys) in _KEYED_FACTS.items():
        for key in keys:
            if key == "order_date_key":
                parts.append(audits.no_orphans(fact, made[fact], "dim_date", S.cal(src), "date_key", key))
            else:
                parts.append(audits.no_orphans(fact, made[fact], _KEYED_BY[key], src(_KEYED_BY[key]), key))
        parts.append(audits.no_null_keys(fact, made[fact], keys))
    return audits.union(parts)


_MATCHED = {
    "customer": ("ods_customer", "dim_customer", "customer_id"), "restaurant": ("ods_restaurant", "dim_restaurant", "restaurant_id"),
    "delivery_partner": ("ods_delivery_partner", "dim_delivery_partner", "delivery_partner_id"), "menu_item": ("ods_menu_item", "dim_menu_item", None),
    "order": ("ods_order", "before_order", None), "order_item": ("lines", "ods_order_item", None),
    "delivery_performance": ("ods_delivery_performance", "next_delivery_performance", None), "rating": ("ods_rating", "before_rating", None),
}


@query(
    "t12_layer_match",
    " UNION ALL ".join(
        _check("Row count reconciliation (ODS vs DWH)", f"'{e}'", "'ODS = ' || o", "'DWH = ' || d", "o = d",
               f"FROM (SELECT (SELECT count(*) FROM {o}), (SELECT count({'DISTINCT ' + k if k else '*'}) FROM {d})) q(o, d)")
        for e, (o, d, k) in _MATCHED.items()
    ),
)
def layer_match(src: Source) -> DataFrame:
    def right(name: str) -> DataFrame:
        return S.items(src) if name == "ods_order_item" else src(name)

    return audits.union(audits.layer_match(e, src(o), right(d), k) for e, (o, d, k) in _MATCHED.items())


@query(
    "t13_item_quantity",
    _none("Cross-Table Item Quantity Check", "delivery_performance vs order_item", "mismatches",
          "SELECT count(*) FROM ods_delivery_performance d JOIN (SELECT order_id, sum(quantity) AS q FROM ods_order_item GROUP BY 1) i ON i.order_id = d.order_id WHERE d.order_item <> i.q"),
)
def item_quantity(src: Source) -> DataFrame:
    return audits.item_quantity(src("ods_delivery_performance"), S.items(src))


_LINE_SUMS = "(SELECT order_id, sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS g, sum(item_discount) AS d, sum(CAST(quantity * unit_price - item_discount AS DECIMAL(18,2))) AS n FROM ods_order_item GROUP BY 1)"


@query(
    "t14_amount_checks",
    " UNION ALL ".join(
        _none(t, "order vs order_item", "mismatches", f"SELECT count(*) FROM ods_order o JOIN {_LINE_SUMS} i ON i.order_id = o.order_id WHERE NOT o.is_cancelled AND abs({a} - {b}) > 0.01")
        for t, a, b in (
            ("Cross-Table Subtotal vs Gross Check", "o.subtotal_amount", "i.g"), ("Cross-Table Discount Check", "o.discount_amount", "i.d"),
            ("Cross-Table Net Amount Check", "(o.subtotal_amount - o.discount_amount)", "i.n"),
        )
    ),
)
def amount_checks(src: Source) -> DataFrame:
    lines = S.items(src).select(
        "order_id", "item_discount", (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("gross_line_total"),
        (F.col("quantity") * F.col("unit_price") - F.col("item_discount")).cast("decimal(18,2)").alias("net_line_total"),
    )
    return audits.amount_checks(src("ods_order"), lines)


fragment(
    "aspect_facts",
    "SELECT r.rating_key, c.aspect_id, c.sentiment_type_id FROM doc_reviews r JOIN doc_cache c ON c.review_hash = sha256(lower(trim(r.review_text)))",
)


@query(
    "t15_review_aspects",
    _check("Fact Review Aspect Row Count", "'fact_review_aspect'", "'> 0 rows'", "CAST(n AS VARCHAR) || ' rows'", "n > 0", "FROM (SELECT count(*) FROM aspect_facts) q(n)")
    + " UNION ALL " + " UNION ALL ".join(
        (
            _none("Fact Logical Integrity (No Orphans)", "fact_review_aspect -> fact_rating", "orphan records", "SELECT count(*) FROM aspect_facts WHERE rating_key NOT IN (SELECT doc_id FROM documents)"),
            _none("Fact Logical Integrity (No Orphans)", "fact_review_aspect -> dim_aspect", "orphan records", "SELECT count(*) FROM aspect_facts WHERE aspect_id NOT BETWEEN 0 AND 6"),
            _none("Fact Logical Integrity (No Orphans)", "fact_review_aspect -> dim_sentiment_type", "orphan records", "SELECT count(*) FROM aspect_facts WHERE sentiment_type_id NOT BETWEEN 0 AND 3"),
            _none("Review Aspect Uniqueness Check", "fact_review_aspect", "duplicates", "SELECT count(*) FROM (SELECT 1 FROM aspect_facts GROUP BY rating_key, aspect_id, sentiment_type_id HAVING count(*) > 1)"),
            _none("Multi-Aspect Separation Check", "Tasty but a bit late", "anomalies",
                  "SELECT count(*) FROM (SELECT 1 FROM aspect_facts a JOIN doc_reviews r ON r.rating_key = a.rating_key WHERE r.review_text = 'Tasty but a bit late' GROUP BY a.rating_key HAVING count(DISTINCT a.aspect_id) <> 2)"),
        )
    ),
)
def review_aspects(src: Source) -> DataFrame:
    return audits.review_aspects(
        S.fact_review_aspect(src), S.doc_reviews(src), lookups.aspects(src.spark), lookups.sentiment_types(src.spark)
    )


@query(
    "t16_timeline",
    " UNION ALL ".join(_none("SCD Type 2 Timeline Integrity", n, "invalid records", f"SELECT count(*) FROM loaded_{n} WHERE valid_from > valid_to") for n in S.DIMS),
)
def timeline(src: Source) -> DataFrame:
    return audits.union(audits.timeline(n, S.loaded(src, n)) for n in S.DIMS)


_GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_LAYER_TABLES = {
    "raw": {f"raw_{e}": f"raw_{e}" for e in LOAD_ORDER},
    "ods": {f"ods_{e}": f"ods_{e}" for e in LOAD_ORDER},
    "ref": {f"ref_{n}": f"master_{n}" for n in M.MASTERS},
    "dwh": {
        **{n: n for n in (*S.DIMS, "dim_menu_item")}, "fact_order": "fact_order_all", "fact_order_item": "fact_item_all",
        "fact_delivery_performance": "fact_delivery_all", "fact_rating": "fact_rating_all", "fact_review_aspect": "aspect_facts",
    },
    "control": {n: n for n in ("etl_batch", "etl_log", "etl_error", "etl_warning", "dim_change_log")},
}


@query(
    "t17_table_counts",
    " UNION ALL ".join(
        [f"SELECT 'given' AS layer, '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _GIVEN]
        + [f"SELECT '{layer}', '{n}', count(*) FROM {t}" for layer, tables in _LAYER_TABLES.items() for n, t in tables.items()]
    ),
)
def table_counts(src: Source) -> DataFrame:
    """Every table of every layer."""
    built = {
        "fact_order": S.orders_fact, "fact_order_item": S.items_fact, "fact_delivery_performance": S.deliveries_fact,
        "fact_rating": S.ratings_fact, "fact_review_aspect": S.fact_review_aspect, "ods_order_item": S.items, "etl_batch": etl_batch,
    }
    tables = {("given", n): src.table(n) for n in _GIVEN}
    tables |= {(layer, n): built[n](src) if n in built else src(t) for layer, found in _LAYER_TABLES.items() for n, t in found.items()}
    return audits.table_counts(tables)


@query(
    "t18_warnings_complete",
    _none("Warning Observability Integrity", "etl_warning", "invalid records", "SELECT count(*) FROM etl_warning WHERE entity_name IS NULL OR entity_id IS NULL OR warning_type IS NULL OR warning_message IS NULL"),
)
def warnings_complete(src: Source) -> DataFrame:
    return audits.warnings_complete(src("etl_warning"))


# Retention ------------------------------------------------------------------------------------------------

@query(
    "a16_transient_purge",
    "SELECT r.order_id, r.batch_id, COALESCE(b.status, '') AS batch_status, (b.status IS NOT NULL AND b.status IN ('COMPLETED', 'SUCCESS', 'FAILED')) "
    f"OR r.order_timestamp < {NOW} - INTERVAL 48 HOUR AS purge FROM ods_order r LEFT JOIN etl_batch b ON b.batch_id = r.batch_id",
)
def transient_purge(src: Source) -> DataFrame:
    """Typed orders as transient rows, stamped with their order time."""
    batches = etl_batch(src)
    rows = src("ods_order").withColumn("load_timestamp", F.col("order_timestamp"))
    flagged = maintenance.transient_flags(rows, batches, now(), retention_hours=48)
    status = batches.select("batch_id", F.col("status").alias("batch_status"))
    return flagged.join(status, "batch_id", "left").select(
        "order_id", "batch_id", F.coalesce("batch_status", F.lit("")).alias("batch_status"), "purge"
    )


RETENTION_DAYS = 730
_CUTOFF = f"({NOW} - INTERVAL {RETENTION_DAYS} DAY)"
_OLD = f"SELECT batch_id FROM etl_batch WHERE start_time < {_CUTOFF} AND status IN ('SUCCESS', 'FAILED', 'PARTIAL')"


def _gone(stamp: str) -> str:
    return f"(batch_id IN ({_OLD}) OR {stamp} < {_CUTOFF})"


_HELD = (
    f"SELECT batch_id FROM etl_error WHERE NOT {_gone('error_timestamp')} UNION SELECT batch_id FROM etl_warning WHERE NOT {_gone('warning_timestamp')} "
    f"UNION SELECT batch_id FROM etl_log WHERE NOT {_gone('start_time')}"
)
fragment(
    "purge_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(sum(CASE WHEN {_gone(s)} THEN 1 ELSE 0 END) AS BIGINT) AS rows_to_purge FROM {t}"
        for t, s in maintenance.STAMPS.items()
    ),
)


def _control(src: Source) -> dict[str, DataFrame]:
    return {
        "etl_error": src("etl_error"), "etl_warning": src("etl_warning"), "etl_log": src("etl_log"),
        "etl_batch": etl_batch(src),
    }


@query(
    "a17_control_purge_preview",
    f"SELECT * FROM purge_counts UNION ALL SELECT 'etl_batch', CAST(sum(CASE WHEN batch_id IN ({_OLD}) AND batch_id NOT IN ({_HELD}) THEN 1 ELSE 0 END) AS BIGINT) FROM etl_batch",
)
def control_purge_preview(src: Source) -> DataFrame:
    return maintenance.purge_preview(maintenance.control_flags(_control(src), now(), RETENTION_DAYS))


@query(
    "a17_control_purge",
    f"SELECT batch_id, status FROM etl_batch WHERE NOT (batch_id IN ({_OLD}) AND batch_id NOT IN ({_HELD}))",
)
def control_purge(src: Source) -> DataFrame:
    """The batches that stay."""
    return maintenance.purge_control(_control(src), now(), RETENTION_DAYS)["etl_batch"].select("batch_id", "status")


@query("a17_error_only_purge", "SELECT * FROM purge_counts WHERE table_name <> 'etl_log'")
def error_only_purge(src: Source) -> DataFrame:
    return maintenance.purge_preview(
        maintenance.control_flags(_control(src), now(), RETENTION_DAYS, error_only=True)
    )
