"""Retention and layout upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLOSED_STATUSES = ("SUCCESS", "FAILED", "PARTIAL")
# Fixed value: as listed by the source system, where PARTIAL batches keep their clean rows.
FINISHED_STATUSES = ("COMPLETED", "SUCCESS", "FAILED")


def _stale(rows: DataFrame, batches: DataFrame, stamp: str, cutoff: Column) -> DataFrame:
    """Rows flagged `purge`: they belong to a listed batch or are older than the cutoff."""
    listed = batches.select("batch_id").distinct().withColumn("listed", F.lit(True))
    hit = F.coalesce(F.col("listed"), F.lit(False)) | F.coalesce(F.col(stamp) < cutoff, F.lit(False))
    return rows.join(listed, "batch_id", "left").withColumn("purge", hit).drop("listed")


def transient_flags(rows: DataFrame, batches: DataFrame, as_of: Column, retention_hours: int = 24) -> DataFrame:
    """Clean rows older than the retention or of finished batches are flagged `purge`."""
    finished = batches.filter(F.col("status").isin(*FINISHED_STATUSES))
    cutoff = as_of - F.expr(f"INTERVAL '{int(retention_hours)}' HOUR")
    return _stale(rows, finished, "load_timestamp", cutoff)


def purge_transient(rows: DataFrame, batches: DataFrame, as_of: Column, retention_hours: int = 24) -> DataFrame:
    """What is left after the purge."""
    flagged = transient_flags(rows, batches, as_of, retention_hours)
    return flagged.filter(~F.col("purge")).select(*rows.columns)


def purge_preview(flagged: dict[str, DataFrame]) -> DataFrame:
    """Dry run: how many rows each table would lose."""
    out = None
    for name, df in flagged.items():
        part = df.agg(F.count_if("purge").alias("rows_to_purge")).select(
            F.lit(name).alias("table_name"), "rows_to_purge"
        )
        out = part if out is None else out.unionByName(part)
    return out


STAMPS = {"etl_error": "error_timestamp", "etl_warning": "warning_timestamp", "etl_log": "start_time"}


def control_flags(
    control: dict[str, DataFrame], as_of: Column, retention_days: int, error_only: bool = False
) -> dict[str, DataFrame]:
    """Flag the rows of errors, warnings, logs and batches that the retention removes.

    A batch goes only when none of its logs, errors or warnings stays behind.
    """
    if retention_days < 1:
        raise ValueError("retention_days must be at least 1")
    cutoff = as_of - F.expr(f"INTERVAL '{int(retention_days)}' DAY")
    batches = control["etl_batch"]
    old = batches.filter((F.col("start_time") < cutoff) & F.col("status").isin(*CLOSED_STATUSES))
    children = ("etl_error", "etl_warning") if error_only else ("etl_error", "etl_warning", "etl_log")
    flagged = {name: _stale(control[name], old, STAMPS[name], cutoff) for name in children}
    if not error_only:
        left = None
        for df in flagged.values():
            part = df.filter(~F.col("purge")).select("batch_id")
            left = part if left is None else left.unionByName(part)
        held = left.distinct().withColumn("held", F.lit(True))
        goes = (
            (F.col("start_time") < cutoff) & F.col("status").isin(*CLOSED_STATUSES)
            & ~F.coalesce(F.col("held"), F.lit(False))
        )
        flagged["etl_batch"] = batches.join(held, "batch_id", "left").withColumn(
            "purge", F.coalesce(goes, F.lit(False))
        ).drop("held")
    return flagged


def purge_control(
    control: dict[str, DataFrame], as_of: Column, retention_days: int, error_only: bool = False
) -> dict[str, DataFrame]:
    """The control tables after the purge; untouched tables come back as they are."""
    flagged = control_flags(control, as_of, retention_days, error_only)
    return {
        name: flagged[name].filter(~F.col("purge")).select(*df.columns) if name in flagged else df
        for name, df in control.items()
    }


def clustered(facts: DataFrame, key: str, files: int) -> DataFrame:
    """Rows range-partitioned and sorted by the date key, ready to be written as few large files.

    Row-group minima and maxima then let a scan skip everything outside a date range. A day that holds a
    third of the rows would make one huge file, so the range key carries a second, spreading column.
    """
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(max(files, 1)))
    return (
        facts.withColumn("spread", spread)
        .repartitionByRange(files, key, "spread")
        .sortWithinPartitions(key)
        .drop("spread")
    )


def rewrite_clustered(facts: DataFrame, key: str, path: str, files: int) -> None:
    clustered(facts, key, files).write.mode("overwrite").parquet(path)


def table_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Collect row counts and, when named, column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
