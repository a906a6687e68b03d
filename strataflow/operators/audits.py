"""Audit checks: each gives (test_name, entity_name, expected_value, actual_value, status) rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_STATUSES = ("RUNNING", "SUCCESS", "PARTIAL")
TOLERANCE = "0.01"
MIXED_REVIEW = "Tasty but a bit late"


def _text(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _result(df: DataFrame, test: str, entity, expected, actual, ok: Column) -> DataFrame:
    return df.select(
        F.lit(test).alias("test_name"),
        _text(entity).alias("entity_name"),
        _text(expected).cast("string").alias("expected_value"),
        _text(actual).cast("string").alias("actual_value"),
        F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def _none_expected(df: DataFrame, test: str, entity: str, bad: Column, unit: str) -> DataFrame:
    """PASS when no row meets the condition."""
    counted = df.agg(F.count_if(bad).alias("n"))
    return _result(
        counted, test, entity, f"0 {unit}", F.concat(F.col("n").cast("string"), F.lit(f" {unit}")),
        F.col("n") == 0,
    )


def _no_rows(df: DataFrame, test: str, entity: str, unit: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _result(
        counted, test, entity, f"0 {unit}", F.concat(F.col("n").cast("string"), F.lit(f" {unit}")),
        F.col("n") == 0,
    )


def union(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def _blank(column: str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(column))) == 0, F.lit(True))


def batch_status(batches: DataFrame) -> DataFrame:
    """The batch exists with an acceptable status."""
    return _result(
        batches, "Batch status", F.concat(F.lit("batch "), F.col("batch_id").cast("string")),
        " / ".join(OPEN_STATUSES), F.col("status"), F.col("status").isin(*OPEN_STATUSES),
    )


def raw_vs_log(raw: Mapping[str, DataFrame], log: DataFrame, step_prefix: str = "LOAD_RAW_") -> DataFrame:
    """Raw rows equal the rows the last successful step logged, and there are some."""
    done = log.filter(F.col("status") == "SUCCESS").groupBy("step_name").agg(
        F.max_by("rows_inserted", "log_id").alias("logged")
    )
    parts = []
    for entity, df in raw.items():
        counted = df.agg(F.count(F.lit(1)).alias("n")).withColumn(
            "step_name", F.lit(step_prefix + entity.upper())
        ).join(done, "step_name", "left")
        parts.append(
            _result(
                counted, "Row count reconciliation (RAW vs Log)", entity,
                F.concat(F.lit("Logged rows = "), F.coalesce(F.col("logged").cast("string"), F.lit("NULL"))),
                F.concat(F.lit("RAW rows = "), F.col("n").cast("string")),
                (F.col("n") > 0) & (F.col("n") == F.col("logged")),
            )
        )
    return union(parts)


def lineage_unique(entity: str, raw: DataFrame) -> DataFrame:
    """(batch, file, row number) is unique."""
    dup = raw.groupBy("batch_id", "source_file_name", "source_row_number").agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    return _no_rows(dup, "Lineage key uniqueness in RAW", entity, "duplicates")


def metadata_complete(entity: str, raw: DataFrame) -> DataFrame:
    """T4: file name and row number (from 2) are there."""
    bad = _blank("source_file_name") | F.coalesce(F.col("source_row_number") < 2, F.lit(True))
    if "load_timestamp" in raw.columns:
        bad = bad | F.col("load_timestamp").isNull()
    return _none_expected(raw, "Metadata completeness in RAW", entity, bad, "invalid records")


def key_present(entity: str, table: DataFrame, key: str, test: str = "Business Key completeness") -> DataFrame:
    """The business key is not blank."""
    return _none_expected(table, test, entity, _blank(key), f"NULL/empty {key}")


def column_filled(entity: str, table: DataFrame, column: str) -> DataFrame:
    """A column added later is filled."""
    return _none_expected(table, f"New column presence: {column}", entity, _blank(column), f"NULL/empty {column}")


def timings_populated(deliveries: DataFrame) -> DataFrame:
    """Some rows carry all three timings, unless there are no rows."""
    filled = ~(_blank("prep_time") | _blank("rider_wait_time") | _blank("travel_time"))
    counted = deliveries.agg(F.count_if(filled).alias("n"), F.count(F.lit(1)).alias("total"))
    return _result(
        counted, "New timing metrics populated", "delivery_performance", "> 0 populated rows",
        F.concat(
            F.col("n").cast("string"), F.lit(" populated rows of "), F.col("total").cast("string"),
            F.lit(" total"),
        ),
        (F.col("total") == 0) | (F.col("n") > 0),
    )


def row_balance(entity: str, raw: DataFrame, valid: DataFrame, errors: DataFrame) -> DataFrame:
    """raw = valid + rejected, and the rejected rows are those with errors."""
    bad = errors.filter(F.col("table_name").isin(f"raw_{entity}", f"ods_{entity}", entity)).agg(
        F.count_distinct("batch_id", "source_file_name", "source_row_number").alias("n")
    ).scalar()
    counted = raw.agg(F.count(F.lit(1)).alias("raw_rows")).select(
        "raw_rows", valid.agg(F.count(F.lit(1)).alias("n")).scalar().alias("valid_rows"),
        bad.alias("error_rows"),
    ).withColumn("rejected", F.col("raw_rows") - F.col("valid_rows"))
    balance = _result(
        counted, "Row count reconciliation", entity,
        F.concat(F.lit("RAW = "), F.col("raw_rows").cast("string")),
        F.concat(
            F.lit("Valid = "), F.col("valid_rows").cast("string"), F.lit(" | Rejected = "),
            F.col("rejected").cast("string"),
        ),
        F.col("raw_rows") >= F.col("valid_rows"),
    )
    audit = _result(
        counted, "Audit log completeness", entity,
        F.concat(F.col("rejected").cast("string"), F.lit(" rejected rows")),
        F.concat(F.col("error_rows").cast("string"), F.lit(" errored rows")),
        F.col("rejected") == F.col("error_rows"),
    )
    return balance.unionByName(audit)


def key_unique(entity: str, table: DataFrame, keys: list[str], test: str = "Business Key Uniqueness") -> DataFrame:
    """No duplicate business keys."""
    dup = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _no_rows(dup, test, entity, "duplicates")


def trimmed(entity: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """No leading or trailing blanks are left."""
    bad = reduce(
        lambda a, b: a | b, [F.coalesce(F.col(c) != F.trim(F.col(c)), F.lit(False)) for c in columns]
    )
    return _none_expected(table, "Trimming validation", entity, bad, "untrimmed rows")


def audit_columns(entity: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """The audit columns are filled."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return _none_expected(table, "Audit Metadata completeness", entity, bad, "missing audit cols")


def unknown_members(dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Every dimension has its -1 member."""
    return union(
        _result(
            df.agg(F.count_if(F.col(key) == -1).alias("n")), "Unknown Member (-1) Integrity", name,
            "1 Unknown Member present", F.concat(F.col("n").cast("string"), F.lit(" Unknown Member present")),
            F.col("n") == 1,
        )
        for name, (df, key) in dimensions.items()
    )


def no_orphans(fact: str, facts: DataFrame, dimension: str, members: DataFrame, key: str, fact_key: str | None = None) -> DataFrame:
    """Every fact key exists in its dimension."""
    side = members.select(F.col(key).alias("member_key")).distinct()
    orphans = facts.join(side, F.col(fact_key or key) == F.col("member_key"), "left_anti")
    return _no_rows(orphans, "Fact Logical Integrity (No Orphans)", f"{fact} -> {dimension}", "orphan records")


def no_null_keys(fact: str, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Fact keys are never NULL."""
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return _none_expected(facts, "Fact Surrogate Keys Nullability", fact, bad, "null FKs")


def layer_match(entity: str, ods: DataFrame, dwh: DataFrame, distinct_id: str | None = None) -> DataFrame:
    """Typed and warehouse row counts agree; versioned dimensions count distinct ids."""
    right = F.count_distinct(distinct_id) if distinct_id else F.count(F.lit(1))
    counted = ods.agg(F.count(F.lit(1)).alias("ods_rows")).select(
        "ods_rows", dwh.agg(right.alias("n")).scalar().alias("dwh_rows")
    )
    return _result(
        counted, "Row count reconciliation (ODS vs DWH)", entity,
        F.concat(F.lit("ODS = "), F.col("ods_rows").cast("string")),
        F.concat(F.lit("DWH = "), F.col("dwh_rows").cast("string")),
        F.col("ods_rows") == F.col("dwh_rows"),
    )


def item_quantity(deliveries: DataFrame, items: DataFrame) -> DataFrame:
    """The delivery's item count equals the summed quantity of its order."""
    per_order = items.groupBy("order_id").agg(F.sum("quantity").alias("sum_qty"))
    joined = deliveries.join(per_order, "order_id")
    return _none_expected(
        joined, "Cross-Table Item Quantity Check", "delivery_performance vs order_item",
        F.col("order_item") != F.col("sum_qty"), "mismatches",
    )


def amount_checks(orders: DataFrame, items: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    """Subtotal, discount and net of each order against its lines; lines are summed once."""
    per_order = items.groupBy("order_id").agg(
        F.sum("gross_line_total").alias("sum_gross"), F.sum("item_discount").alias("sum_discount"),
        F.sum("net_line_total").alias("sum_net"),
    )
    joined = orders.filter(~F.col("is_cancelled")).join(per_order, "order_id")
    limit = F.lit(tolerance).cast("decimal(18,2)")

    def off(left: Column, right: str) -> Column:
        return F.count_if(F.abs(left - F.col(right)) > limit)

    counted = joined.agg(
        off(F.col("subtotal_amount"), "sum_gross").alias("subtotal"),
        off(F.col("discount_amount"), "sum_discount").alias("discount"),
        off(F.col("subtotal_amount") - F.col("discount_amount"), "sum_net").alias("net"),
    )
    titles = {
        "subtotal": "Cross-Table Subtotal vs Gross Check",
        "discount": "Cross-Table Discount Check",
        "net": "Cross-Table Net Amount Check",
    }
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("test"), F.col(c).alias("n")) for c, t in titles.items()]))
    return counted.select(rows.alias("r")).select("r.*").select(
        F.col("test").alias("test_name"), F.lit("order vs order_item").alias("entity_name"),
        F.lit("0 mismatches").alias("expected_value"),
        F.concat(F.col("n").cast("string"), F.lit(" mismatches")).alias("actual_value"),
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def review_aspects(
    aspect_facts: DataFrame, ratings: DataFrame, aspects: DataFrame, sentiments: DataFrame,
    mixed_review: str = MIXED_REVIEW,
) -> DataFrame:
    """Not empty, keys known, unique, and the mixed review has exactly two aspects."""
    counted = aspect_facts.agg(F.count(F.lit(1)).alias("n"))
    filled = _result(
        counted, "Fact Review Aspect Row Count", "fact_review_aspect", "> 0 rows",
        F.concat(F.col("n").cast("string"), F.lit(" rows")), F.col("n") > 0,
    )
    mixed = ratings.filter(F.col("review_text") == mixed_review).select("rating_key")
    odd = aspect_facts.join(mixed, "rating_key", "left_semi").groupBy("rating_key").agg(
        F.count_distinct("aspect_id").alias("n")
    ).filter("n <> 2")
    return union(
        (
            filled,
            no_orphans("fact_review_aspect", aspect_facts, "fact_rating", ratings, "rating_key"),
            no_orphans("fact_review_aspect", aspect_facts, "dim_aspect", aspects, "aspect_id"),
            no_orphans("fact_review_aspect", aspect_facts, "dim_sentiment_type", sentiments, "sentiment_type_id"),
            key_unique(
                "fact_review_aspect", aspect_facts, ["rating_key", "aspect_id", "sentiment_type_id"],
                "Review Aspect Uniqueness Check",
            ),
            _no_rows(odd, "Multi-Aspect Separation Check", mixed_review, "anomalies"),
        )
    )


def timeline(name: str, dimension: DataFrame) -> DataFrame:
    """valid_from is not after valid_to."""
    return _none_expected(
        dimension, "SCD Type 2 Timeline Integrity", name, F.col("valid_from") > F.col("valid_to"),
        "invalid records",
    )


def warnings_complete(warnings: DataFrame) -> DataFrame:
    """Warnings carry entity, id, type and message."""
    bad = reduce(
        lambda a, b: a | b,
        [F.col(c).isNull() for c in ("entity_name", "entity_id", "warning_type", "warning_message")],
    )
    return _none_expected(warnings, "Warning Observability Integrity", "etl_warning", bad, "invalid records")


def table_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (layer, table)."""
    return union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    )


class AuditError(RuntimeError):
    """At least one audit check failed."""


def raise_on_failure(results: DataFrame, failures: str | None = None) -> None:
    """Raise if a check failed. The message counts all failures and names the first ones; all of them are written to the
    `failures` table where a path is given. Results hold one row per check, so their number does not grow with data."""
    failed = results.filter(F.col("status") == "FAIL")
    if failures is not None:
        failed.write.mode("overwrite").parquet(failures)
    rows = failed.orderBy("test_name", "entity_name").collect()
    if rows:
        told = "; ".join(f"{r.test_name} [{r.entity_name}]: {r.actual_value}" for r in rows)
        raise AuditError(f"{len(rows)} checks failed: {told}")
