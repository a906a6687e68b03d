"""Hybrid slowly changing dimensions: versioned columns (type 2) and overwritten columns (type 1).

One full outer join of the current rows with the source classifies every business id; the versions to close
and to open come out of that single pass. History rows are never joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.surrogate import fill_missing_keys, next_key

OPEN_END = "9999-12-31"
FIRST_DAY = "1900-01-01"
VERSION = "SCD2_VERSION"
CORRECTION = "SCD2_SAME_DAY_CORRECTION"


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str
    business_id: str
    start_column: str
    versioned: tuple[str, ...]
    overwritten: tuple[str, ...]

    @property
    def attributes(self) -> tuple[str, ...]:
        return (*self.versioned, *self.overwritten)

    @property
    def columns(self) -> tuple[str, ...]:
        return (
            self.key, self.business_id, *self.attributes, "last_active", "life_cycle_id",
            "valid_from", "valid_to", "is_current", "batch_id",
        )


CUSTOMER = DimensionSpec(
    "dim_customer", "customer_key", "customer_id", "signup_date",
    versioned=("city",),
    overwritten=("signup_date", "acquisition_channel"),
)
RESTAURANT = DimensionSpec(
    "dim_restaurant", "restaurant_key", "restaurant_id", "onboard_date",
    versioned=("restaurant_name", "city", "cuisine_type", "partner_type", "is_active"),
    overwritten=(
        "onboard_date", "avg_prep_time_min", "min_prep_min", "max_prep_min", "prep_time_group",
        "prep_time_index",
    ),
)
DELIVERY_PARTNER = DimensionSpec(
    "dim_delivery_partner", "delivery_partner_key", "delivery_partner_id", "onboard_date",
    versioned=("partner_name", "city", "vehicle_type", "employment_type", "is_active"),
    overwritten=("onboard_date", "avg_rating", "rating_type_id", "rating_type"),
)
DIMENSIONS = {d.name: d for d in (CUSTOMER, RESTAURANT, DELIVERY_PARTNER)}


def _any_differs(columns: tuple[str, ...]) -> Column:
    return reduce(
        lambda a, b: a | b, [~F.col(f"cur.{c}").eqNullSafe(F.col(f"src.{c}")) for c in columns]
    )


def classify(spec: DimensionSpec, dimension: DataFrame, source: DataFrame, effective: Column) -> DataFrame:
    """Current rows (`cur`) beside the source rows (`src`) with the action each pair needs.

    INSERT: id never seen. VERSION: a versioned column changed and the current version began before the
    effective date. CORRECTION: it changed but the version began on or after that date, so it is rewritten in
    place. TYPE1: only overwritten columns changed. SAME: nothing changed. ABSENT: not in the source.
    """
    current = dimension.filter("is_current").alias("cur")
    src = source.alias("src")
    joined = current.join(
        src, F.col(f"cur.{spec.business_id}") == F.col(f"src.{spec.business_id}"), "full"
    )
    changed = _any_differs(spec.versioned)
    action = (
        F.when(F.col(f"cur.{spec.business_id}").isNull(), "INSERT")
        .when(F.col(f"src.{spec.business_id}").isNull(), "ABSENT")
        .when(changed & (F.col("cur.valid_from") < effective), "VERSION")
        .when(changed, "CORRECTION")
        .when(_any_differs(spec.overwritten), "TYPE1")
        .otherwise("SAME")
    )
    return joined.withColumn("scd_action", action).withColumn("effective_date", effective)


def _row(spec: DimensionSpec, values: dict[str, Column], types: dict, action: Column) -> Column:
    return F.struct(
        *[values[c].cast(types[c]).alias(c) for c in spec.columns], action.alias("scd_action")
    )


def _versions(spec: DimensionSpec, classified: DataFrame, types: dict) -> DataFrame:
    action = F.col("scd_action")
    cur = {c: F.col(f"cur.{c}") for c in spec.columns}
    src = {c: F.col(f"src.{c}") for c in (spec.business_id, *spec.attributes, "batch_id")}
    start = F.col(f"src.{spec.start_column}")
    opened = {
        **src,
        spec.key: F.lit(None),
        "last_active": F.when(action == "INSERT", start).otherwise(
            F.coalesce(F.col("cur.last_active"), start)
        ),
        "life_cycle_id": F.when(action == "INSERT", F.lit(0)).otherwise(
            F.coalesce(F.col("cur.life_cycle_id"), F.lit(0))
        ),
        "valid_from": F.when(
            action == "INSERT", F.coalesce(start, F.lit(FIRST_DAY).cast("date"))
        ).otherwise(F.col("effective_date")),
        "valid_to": F.lit(OPEN_END),
        "is_current": F.lit(True),
    }
    closed = {
        **cur, "valid_to": F.date_sub(F.col("effective_date"), 1), "is_current": F.lit(False),
    }
    rewritten = {**cur, **{c: src[c] for c in (*spec.attributes, "batch_id")}}
    as_struct = {
        "opened": _row(spec, opened, types, action),
        "closed": _row(spec, closed, types, F.lit("CLOSED")),
        "rewritten": _row(spec, rewritten, types, action),
        "kept": _row(spec, cur, types, F.lit("SAME")),
    }
    rows = (
        F.when(action == "INSERT", F.array(as_struct["opened"]))
        .when(action == "VERSION", F.array(as_struct["closed"], as_struct["opened"]))
        .when(action.isin("CORRECTION", "TYPE1"), F.array(as_struct["rewritten"]))
        .otherwise(F.array(as_struct["kept"]))
    )
    return classified.select(F.explode(rows).alias("r")).select("r.*")


def apply_scd2(
    spec: DimensionSpec, dimension: DataFrame, source: DataFrame, effective: Column
) -> DataFrame:
    """All versions after the batch, with `scd_action` per row. New versions have a NULL key.

    `source` holds one row per business id with the attributes and `batch_id`.
    """
    types = {f.name: f.dataType for f in dimension.schema.fields}
    touched = _versions(spec, classify(spec, dimension, source, effective), types)
    history = dimension.filter(~F.col("is_current")).select(
        *spec.columns, F.lit("HISTORY").alias("scd_action")
    )
    return history.unionByName(touched)


def with_keys(spec: DimensionSpec, versions: DataFrame, dimension: DataFrame, first: Column | None = None) -> DataFrame:
    """Number the new versions, behind the keys of `dimension` or from `first`; at most one per business id in a batch."""
    return fill_missing_keys(versions, spec.business_id, spec.key, next_key(dimension, spec.key) if first is None else first)


def change_log(
    spec: DimensionSpec,
    dimension: DataFrame,
    source: DataFrame,
    effective: Column,
    batch_id: Column | None = None,
    keyed: DataFrame | None = None,
    logged_at: Column | None = None,
) -> DataFrame:
    """One row per changed versioned attribute.

    A correction keeps its surrogate key. A new version's key is filled in from `keyed` (the dimension after
    numbering) when given.
    """
    deltas = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.col(f"cur.{c}").eqNullSafe(F.col(f"src.{c}")),
                    F.struct(
                        F.lit(c).alias("column_name"),
                        _log_text(f"cur.{c}", dimension.schema[c].dataType).alias("old_value"),
                        _log_text(f"src.{c}", source.schema[c].dataType).alias("new_value"),
                    ),
                )
                for c in spec.versioned
            ]
        )
    )
    changes = classify(spec, dimension, source, effective).filter(
        F.col("scd_action").isin("VERSION", "CORRECTION")
    )
    log = changes.select(
        (batch_id if batch_id is not None else F.col("src.batch_id")).alias("batch_id"),
        F.lit(spec.name).alias("dimension_name"),
        F.col(f"src.{spec.business_id}").alias("business_id"),
        F.col(f"cur.{spec.key}").alias("surrogate_key_old"),
        F.when(F.col("scd_action") == "CORRECTION", F.col(f"cur.{spec.key}")).alias("surrogate_key_new"),
        F.when(F.col("scd_action") == "CORRECTION", CORRECTION).otherwise(VERSION).alias("change_type"),
        F.explode(deltas).alias("d"),
        "effective_date",
    ).select(
        "batch_id", "dimension_name", "business_id", "surrogate_key_old", "surrogate_key_new", "change_type",
        "d.column_name", "d.old_value", "d.new_value", "effective_date",
        (logged_at if logged_at is not None else F.localtimestamp()).alias("logged_at"),
    )
    if keyed is None:
        return log
    current = keyed.filter("is_current").select(
        F.col(spec.business_id).alias("current_id"), F.col(spec.key).alias("current_key")
    )
    return (
        log.join(current, F.col("business_id") == F.col("current_id"), "left")
        .withColumn("surrogate_key_new", F.coalesce("surrogate_key_new", "current_key"))
        .drop("current_id", "current_key")
    )


def _log_text(name: str, data_type) -> Column:
    """Flags are logged as 1 and 0."""
    column = F.col(name)
    return column.cast("int").cast("string") if data_type.typeName() == "boolean" else column.cast("string")
