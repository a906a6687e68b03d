"""Order warnings, and the remediation queries over quarantined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = "LOAD_ODS_ORDER"
# Tolerated difference and the amount above which an order is reported.
AMOUNT_TOLERANCE = "0.01"
HIGH_VALUE = 5000
WARNING_TYPES = {
    "orphan_customer": "ORPHAN_CUSTOMER_DETECTED",
    "orphan_restaurant": "ORPHAN_RESTAURANT_DETECTED",
    "orphan_partner": "ORPHAN_DELIVERY_PARTNER_DETECTED",
    "mismatch": "TOTAL_AMOUNT_MISMATCH",
    "high_value": "HIGH_VALUE_ORDER",
}


def _mark(df: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """The parent's id beside the row, NULL where there is none. Rows without an id join on a value of their own that no
    parent has, so they spread over all tasks."""
    side = parent.select(F.col(column).alias(f"{column}_found"))
    own = F.coalesce(F.col(column), F.concat(F.lit("\0"), F.col("order_id")))
    return df.join(side, own == F.col(f"{column}_found"), "left")


def _warning(when: Column, entity: str, entity_id: str, kind: str, message: Column) -> Column:
    return F.when(
        when,
        F.struct(
            F.lit(entity).alias("entity_name"),
            F.col(entity_id).alias("entity_id"),
            F.lit(WARNING_TYPES[kind]).alias("warning_type"),
            message.alias("warning_message"),
        ),
    )


def order_warnings(
    orders: DataFrame, customers: DataFrame, restaurants: DataFrame, partners: DataFrame,
    high_value: float = HIGH_VALUE,
) -> DataFrame:
    """Every warning of every order, several per order, in one pass over the orders."""
    df = _mark(_mark(orders, customers, "customer_id"), restaurants, "restaurant_id")
    df = _mark(df, partners, "delivery_partner_id")
    zero = F.lit(0).cast("decimal(18,2)")
    discount, fee = F.coalesce("discount_amount", zero), F.coalesce("delivery_fee", zero)
    computed = (F.col("subtotal_amount") - discount + fee).cast("decimal(18,2)")
    diff = (F.col("total_amount") - computed).cast("decimal(18,2)")
    has_partner = F.coalesce(F.length(F.trim(F.col("delivery_partner_id"))) > 0, F.lit(False))
    found = F.array(
        _warning(
            F.col("customer_id_found").isNull(), "CUSTOMER", "customer_id", "orphan_customer",
            F.concat(
                F.lit("Order of the unknown customer "), F.col("customer_id"), F.lit("; kept, as its revenue counts"),
            ),
        ),
        _warning(
            F.col("restaurant_id_found").isNull(), "RESTAURANT", "restaurant_id", "orphan_restaurant",
            F.concat(F.lit("Order at the unknown restaurant "), F.col("restaurant_id")),
        ),
        _warning(
            has_partner & F.col("delivery_partner_id_found").isNull(),
            "DELIVERY_PARTNER", "delivery_partner_id", "orphan_partner",
            F.concat(
                F.lit("Order brought by the unknown partner "), F.col("delivery_partner_id"),
            ),
        ),
        _warning(
            F.abs(diff) > F.lit(AMOUNT_TOLERANCE).cast("decimal(18,2)"),
            "FINANCIAL_INTEGRITY", "order_id", "mismatch",
            F.concat(
                F.lit("The total of "), F.col("total_amount").cast("string"),
                F.lit(" is off by "), diff.cast("string"),
                F.lit(" from "), computed.cast("string"),
                F.lit(", which is "), F.col("subtotal_amount").cast("string"),
                F.lit(" less "), discount.cast("string"),
                F.lit(" plus "), fee.cast("string"),
            ),
        ),
        _warning(
            F.col("total_amount") > F.lit(high_value), "ORDER", "order_id", "high_value",
            F.concat(
                F.lit("A large order of "), F.col("total_amount").cast("string")
            ),
        ),
    )
    return df.select(
        "batch_id", F.lit(STEP).alias("step_name"), F.lit("ods_order").alias("table_name"), "order_id",
        F.explode(F.array_compact(found)).alias("w"),
    ).select("batch_id", "step_name", "table_name", "order_id", "w.*")


def replace_warnings(existing: DataFrame, fresh: DataFrame, batch_id: int, step: str = STEP) -> DataFrame:
    """A rerun replaces the warnings of its batch and step."""
    kept = existing.filter(~((F.col("batch_id") == batch_id) & (F.col("step_name") == step)))
    return kept.unionByName(fresh)


def warning_counts(warnings: DataFrame, by: list[str] | None = None) -> DataFrame:
    counts = [F.count_if(F.col("warning_type") == t).alias(n) for n, t in WARNING_TYPES.items()]
    return warnings.groupBy(*(by or [])).agg(*counts)


def placeholder_orders(errors: DataFrame) -> DataFrame:
    """Placeholder parents for the order ids that rejected lines point at."""
    missing = (
        errors.filter(
            (F.col("table_name") == "raw_order_item") & (F.col("column_name") == "order_id")
            & (F.col("error_type") == "MASTER_DATA_NOT_FOUND")
        )
        .groupBy(F.upper(F.trim(F.col("raw_value"))).alias("order_id"))
        .agg(F.min("batch_id").alias("batch_id"))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    return missing.select(
        "order_id",
        *[F.lit("UNKNOWN").alias(c) for c in ("customer_id", "restaurant_id", "delivery_partner_id")],
        F.lit("1900-01-01 00:00:00").cast("timestamp_ntz").alias("order_timestamp"),
        *[zero.alias(c) for c in ("subtotal_amount", "discount_amount", "delivery_fee", "total_amount")],
        F.lit(False).alias("is_cod"), F.lit(False).alias("is_cancelled"),
        "batch_id", F.lit("REMEDIATION_DUMMY").alias("source_file_name"),
        F.lit(0).cast("long").alias("source_row_number"),
    )


ROW_KEY = ["batch_id", "source_file_name", "source_row_number"]


def rejected_value(errors: DataFrame, raw_items: DataFrame) -> DataFrame:
    """Rejected lines, the distinct orders they miss and their amount.

    Errors join the raw rows on batch, file and row number, so no error meets a row of another file.
    """
    lines = errors.filter(F.col("table_name") == "raw_order_item").select(*ROW_KEY, "raw_value")
    amount = F.col("line_total").try_cast("decimal(18,2)")
    return lines.join(raw_items.select(*ROW_KEY, "line_total"), ROW_KEY).agg(
        F.count(F.lit(1)).alias("total_rejected_items"),
        F.count_distinct("raw_value").alias("total_missing_orders"),
        F.sum(amount).cast("decimal(18,2)").alias("total_rejected_amount"),
    )


def cancelled_deliveries(
    errors: DataFrame, raw_deliveries: DataFrame, orders: DataFrame, limit: int | None = None
) -> DataFrame:
    """Raw rows of rejected deliveries with their order's cancel flag; with `limit`, the first ones by row key."""
    rows = errors.filter(F.col("table_name") == "raw_delivery_performance").select(*ROW_KEY).distinct()
    listed = (
        raw_deliveries.join(rows, ROW_KEY, "left_semi")
        .join(orders.select("order_id", "is_cancelled", "order_timestamp"), "order_id", "left")
        .select(
            *ROW_KEY, "delivery_id", "order_id", "is_cancelled", "order_timestamp",
            "expected_delivery_time_min", "actual_delivery_time_min",
        )
    )
    return listed if limit is None else listed.orderBy(*ROW_KEY).limit(limit)
