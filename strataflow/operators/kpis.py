"""KPI measures over the monitoring views: each function gives one row, for all batches or one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the health bands.
RATE_OK, RATE_WARN = 0.02, 0.05
RETENTION_OK, RETENTION_WARN = 0.98, 0.95
STEP_FAST, STEP_MODERATE = 1.0, 3.0
THROUGHPUT_MARGIN = 0.05
RECONCILED = "RECONCILED (Valid Audit)"
EXCLUDED = "EXCLUDED_ORDER_CANCELLED"
STEP_STATUSES = ("SUCCESS", "PARTIAL", "FAILED", "RUNNING")


def scope(df: DataFrame, batch_id: int | None) -> DataFrame:
    return df if batch_id is None else df.filter(F.col("batch_id") == batch_id)


def _beside(*rows: DataFrame) -> DataFrame:
    """One-row aggregates side by side, so that every view is read once. All but the first come in as scalar subqueries."""
    out = rows[0]
    for i, row in enumerate(rows[1:]):
        out = out.select("*", row.select(F.struct("*")).scalar().alias(f"beside_{i}"))
    named = [c for c in out.columns if not c.startswith("beside_")]
    return out.select(*named, *[f"beside_{i}.*" for i in range(len(rows) - 1)])


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _sums(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _rate_band(rate: Column, base: Column) -> Column:
    return (
        F.when(base == 0, "No Data").when(rate <= RATE_OK, "Normal").when(rate <= RATE_WARN, "Warning")
        .otherwise("Critical")
    )


def latest_batch(batches: DataFrame, batch_id: int | None = None) -> DataFrame:
    """The latest batch (or the chosen one) with its status, duration, records and errors."""
    return scope(batches, batch_id).agg(
        F.max("batch_id").alias("latest_batch_id"),
        F.max_by("batch_status", "batch_id").alias("latest_batch_status"),
        F.max_by("duration_seconds", "batch_id").alias("latest_batch_duration"),
        F.max_by("total_records", "batch_id").alias("latest_batch_records"),
        F.max_by("error_records", "batch_id").alias("latest_batch_errors"),
    )


def hours_since_run(batches: DataFrame, as_of: Column) -> DataFrame:
    """Hour boundaries between the latest batch's start and `as_of`."""
    start = F.max_by("start_time", "batch_id")
    latest = batches.agg(start.alias("start_time"))
    return latest.select(
        F.timestamp_diff(
            "HOUR", F.date_trunc("HOUR", F.col("start_time")), F.date_trunc("HOUR", as_of)
        ).alias("hours_since_last_run")
    )


def row_totals(
    errors: DataFrame, warnings: DataFrame, changes: DataFrame, checks: DataFrame, steps: DataFrame,
    batch_id: int | None = None,
) -> DataFrame:
    counted = {
        "total_quarantined_errors": errors,
        "total_operational_warnings": warnings,
        "total_dimension_changes": changes,
        "total_reconciliation_checks": checks,
        "total_steps": steps,
    }
    return _beside(*[_rows(scope(df, batch_id), name) for name, df in counted.items()])


def sums(batches: DataFrame, steps: DataFrame, recon: DataFrame, batch_id: int | None = None) -> DataFrame:
    """All additive measures; each view is aggregated once."""
    b = scope(batches, batch_id).agg(
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("batch_duration_sec"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("batch_total_records"),
    )
    s = scope(steps, batch_id).agg(
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_step_rows_processed"),
        F.coalesce(F.sum("rows_rejected"), F.lit(0)).alias("total_step_rows_rejected"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("total_step_rows_inserted"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("total_step_duration_sec"),
    )
    r = scope(recon, batch_id).agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("total_records_ingested_raw"),
        F.coalesce(F.sum("ods_rows"), F.lit(0)).alias("total_records_staged_ods"),
        F.coalesce(F.sum("dwh_rows"), F.lit(0)).alias("total_records_loaded_dwh"),
        F.coalesce(F.sum("raw_to_ods_variance"), F.lit(0)).alias("total_raw_to_ods_variance"),
        F.coalesce(F.sum("ods_to_dwh_variance"), F.lit(0)).alias("total_ods_to_dwh_variance"),
        F.coalesce(F.sum("quarantined_error_rows"), F.lit(0)).alias("total_reconciliation_errors"),
    )
    return _beside(b, s, r)


def ratios(
    steps: DataFrame, recon: DataFrame, errors: DataFrame, warnings: DataFrame, batch_id: int | None = None
) -> DataFrame:
    """Shares of rows, 0 on an empty base; a batch filter reaches numerator and denominator alike."""
    row = _beside(
        _sums(scope(recon, batch_id), "raw_rows", "ods_rows", "dwh_rows"),
        _sums(scope(steps, batch_id), "rows_processed", "rows_inserted", "rows_rejected"),
        _rows(scope(errors, batch_id), "errors"),
        _rows(scope(warnings, batch_id), "warnings"),
    )
    shares = {
        "overall_data_retention_rate": ("dwh_rows", "raw_rows"),
        "step_rejection_rate": ("rows_rejected", "rows_processed"),
        "quarantined_error_rate": ("errors", "raw_rows"),
        "operational_warning_rate": ("warnings", "ods_rows"),
        "step_yield": ("rows_inserted", "rows_processed"),
    }
    return row.select(*[ratio(F.col(a), F.col(b)).alias(n) for n, (a, b) in shares.items()])


def throughput(steps: DataFrame, batches: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Average step throughput, and the latest (or chosen) batch against the median batch."""
    per_batch = batches.select(
        "batch_id", ratio(F.col("total_records"), F.col("duration_seconds")).alias("rows_per_sec")
    )
    average = scope(steps, batch_id).agg(
        F.coalesce(F.avg("throughput_rows_per_sec"), F.lit(0.0)).alias("step_throughput")
    )
    chosen = scope(per_batch, batch_id).agg(F.max_by("rows_per_sec", "batch_id").alias("batch_throughput"))
    median = per_batch.agg(F.median("rows_per_sec").alias("median_batch_throughput"))
    row = _beside(average, chosen, median)
    own, mid = F.col("batch_throughput"), F.col("median_batch_throughput")
    return row.withColumn(
        "throughput_vs_median",
        F.when(own > mid * (1 + THROUGHPUT_MARGIN), "Above")
        .when(own < mid * (1 - THROUGHPUT_MARGIN), "Below")
        .otherwise("Near"),
    )


def step_statuses(steps: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Steps per status and the band of the average step time."""
    row = scope(steps, batch_id).agg(
        F.count(F.lit(1)).alias("total_steps"),
        *[
            F.count_if(F.col("step_status") == s).alias(f"steps_{s.lower()}") for s in STEP_STATUSES
        ],
        F.coalesce(F.avg("duration_seconds"), F.lit(0.0)).alias("avg_step_seconds"),
    )
    avg = F.col("avg_step_seconds")
    return row.withColumn(
        "step_time_band",
        F.when(F.col("total_steps") == 0, "No Data").when(avg < STEP_FAST, "Fast")
        .when(avg <= STEP_MODERATE, "Moderate").otherwise("Slow"),
    )


def heaviest_stage(steps: DataFrame, batch_id: int | None = None) -> DataFrame:
    """The stage with most seconds, then most rows, its share of all seconds, and the stage count."""
    stages = scope(steps, batch_id).groupBy("process_name").agg(
        F.sum("duration_seconds").alias("stage_seconds"), F.sum("rows_processed").alias("stage_rows")
    )
    # One row per stage is left here, so its maximum, sum and count come from one more aggregate.
    rank = F.struct("stage_seconds", "stage_rows", "process_name")
    row = stages.agg(
        F.max(rank).alias("top"), F.sum("stage_seconds").alias("all_seconds"),
        F.count(F.lit(1)).alias("stage_count"),
    ).filter("stage_count > 0")
    share = ratio(F.col("top.stage_seconds"), F.col("all_seconds"))
    return row.select(
        F.col("top.process_name").alias("top_stage"), "top.stage_seconds", share.alias("stage_share"),
        "stage_count",
        F.when(share > 0.50, "Critical").when(share >= 0.35, "Warning").otherwise("Normal").alias("stage_band"),
    )


def distinct_counts(
    errors: DataFrame, warnings: DataFrame, steps: DataFrame, changes: DataFrame, recon: DataFrame,
    batch_id: int | None = None,
) -> DataFrame:
    e, w, s, a = (scope(d, batch_id) for d in (errors, warnings, steps, changes))

    def distinct(df: DataFrame, **columns) -> DataFrame:
        return df.agg(*[F.count_distinct(c).alias(n) for n, c in columns.items()])

    rejecting = F.when(F.col("rows_rejected") > 0, F.col("step_name"))
    return _beside(
        distinct(
            e, affected_files="source_file_name", violated_columns="column_name", triggered_rules="error_type",
            error_categories="error_category", error_tables="table_name",
        ),
        distinct(w, warning_tables="table_name", warning_types="warning_type"),
        distinct(recon, total_tables="entity_name"),
        distinct(s, total_step_names="step_name", rejecting_steps=rejecting),
        distinct(
            a, changed_keys="business_id", changed_dimensions="dimension_name", changed_attributes="column_name"
        ),
    )


def rejected_rows(errors: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Distinct rejected source rows, and how many errors come on top of the first per row.

    NULL file or row number counts as a value of its own, hence the grouping by the four columns.
    """
    key = ["batch_id", "table_name", "source_file_name", "source_row_number"]
    per_row = scope(errors, batch_id).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    row = per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_errors"), F.count(F.lit(1)).alias("rejected_rows")
    )
    return row.withColumn(
        "multi_fault", F.greatest(F.col("total_errors") - F.col("rejected_rows"), F.lit(0))
    )


def true_defects(errors: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Errors other than cancelled-order exclusions, and their share."""
    row = scope(errors, batch_id).agg(
        F.count(F.lit(1)).alias("total_errors"),
        F.count_if(F.col("error_type") != EXCLUDED).alias("true_defects"),
        F.count_if(F.col("error_type") == EXCLUDED).alias("cancelled_orders"),
    )
    return row.withColumn("defect_impact", ratio(F.col("true_defects"), F.col("total_errors")))


def variance_measures(recon: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Deduplicated rows, added versions, unaccounted loss, and exact against variance checks."""
    to_ods, to_dwh = F.col("raw_to_ods_variance"), F.col("ods_to_dwh_variance")
    zero = F.lit(0)
    row = scope(recon, batch_id).agg(
        F.coalesce(F.sum(to_ods), zero).alias("to_ods"),
        F.coalesce(F.sum("quarantined_error_rows"), zero).alias("errors"),
        F.coalesce(F.sum(to_dwh), zero).alias("to_dwh"),
        F.coalesce(F.sum(F.greatest(to_dwh, zero)), zero).alias("unaccounted_loss"),
        F.count_if(F.col("audit_status") == RECONCILED).alias("exact_checks"),
        F.count_if(F.col("audit_status") != RECONCILED).alias("variance_checks"),
    )
    return row.select(
        F.greatest(zero, F.col("to_ods") - F.col("errors")).alias("deduped_rows"),
        F.greatest(zero, -F.col("to_dwh")).alias("scd2_added"),
        "unaccounted_loss", "exact_checks", "variance_checks",
    )


def health_bands(
    errors: DataFrame, warnings: DataFrame, recon: DataFrame, batch_id: int | None = None
) -> DataFrame:
    """Bands of the error, warning and retention rates, with the net row difference."""
    base = _beside(
        _sums(scope(recon, batch_id), "raw_rows", "ods_rows", "dwh_rows"),
        _rows(scope(errors, batch_id), "errors"),
        _rows(scope(warnings, batch_id), "warnings"),
    )
    row = base.select(
        "*",
        ratio(F.col("errors"), F.col("raw_rows")).alias("error_rate"),
        ratio(F.col("warnings"), F.col("ods_rows")).alias("warning_rate"),
        ratio(F.col("dwh_rows"), F.col("raw_rows")).alias("retention_rate"),
    )
    keep = F.col("retention_rate")
    return row.select(
        "error_rate", _rate_band(F.col("error_rate"), F.col("raw_rows")).alias("error_band"),
        "warning_rate", _rate_band(F.col("warning_rate"), F.col("ods_rows")).alias("warning_band"),
        "retention_rate",
        F.when(F.col("raw_rows") == 0, "No Data").when(keep >= RETENTION_OK, "Healthy")
        .when(keep >= RETENTION_WARN, "Moderate").otherwise("Low").alias("retention_band"),
        (F.col("dwh_rows") - F.col("raw_rows")).alias("net_difference"),
    )
