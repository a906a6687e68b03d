"""Change-detecting upsert on DataFrames.

Plain Parquet has no MERGE, so the merge is a full outer join on the key: one shuffle of either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.spec import ENTITIES


def differs(columns: Sequence[str], left: str, right: str) -> Column:
    """Null-safe: NULL to value and value to NULL both count as a change."""
    pairs = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    out = pairs[0]
    for p in pairs[1:]:
        out = out | p
    return out


def _same_key(keys: Sequence[str]) -> Column:
    cond = F.col(f"t.{keys[0]}") == F.col(f"s.{keys[0]}")
    for k in keys[1:]:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return cond


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    kept: Sequence[str] = (),
) -> DataFrame:
    """Merge `source` into `target`; both hold one row per key.

    Changed rows take every source column except `kept`; unchanged rows stay as they are, including their
    batch id. The result has the target's columns plus `merge_action`: INSERT, UPDATE, UNCHANGED or KEEP.
    """
    t, s = target.alias("t"), source.alias("s")
    columns = target.columns
    probe = keys[0]
    changed = differs(tracked, "t", "s")
    joined = t.join(s, _same_key(keys), "full")
    action = (
        F.when(F.col(f"t.{probe}").isNull(), "INSERT")
        .when(F.col(f"s.{probe}").isNull(), "KEEP")
        .when(changed, "UPDATE")
        .otherwise("UNCHANGED")
    )
    fresh_or_changed = action.isin("INSERT", "UPDATE")
    out = []
    for c in columns:
        old = F.col(f"t.{c}")
        if c not in source.columns:
            out.append(old.alias(c))
        elif c in kept:
            out.append(F.when(action == "INSERT", F.col(f"s.{c}")).otherwise(old).alias(c))
        else:
            out.append(F.when(fresh_or_changed, F.col(f"s.{c}")).otherwise(old).alias(c))
    return joined.select(*out, action.alias("merge_action"))


def upsert_entity(entity: str, target: DataFrame, source: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Upsert one of the eight typed tables by its business key and tracked columns."""
    spec = ENTITIES[entity]
    return upsert(target, source, [spec.key], spec.tracked, kept)


def action_counts(merged: DataFrame) -> DataFrame:
    """Inserted, updated and unchanged source rows."""
    return merged.agg(
        F.count_if(F.col("merge_action") == "INSERT").alias("inserted"),
        F.count_if(F.col("merge_action") == "UPDATE").alias("updated"),
        F.count_if(F.col("merge_action") == "UNCHANGED").alias("unchanged"),
    )
