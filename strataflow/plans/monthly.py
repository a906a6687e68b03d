"""The monthly batch: land files, gate and upsert the typed tables, load the star schema, close the batch.

The driver only orders the steps and publishes tables; every step is a set of DataFrame jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.calendar import dim_date, dim_time
from strataflow.operators import audits, clean, dimensions, facts, gates, lookups, monitoring, reviews
from strataflow.operators import scd2, upsert, warnings
from strataflow.operators.surrogate import next_key
from strataflow.sources import aspect_cache, landing
from strataflow.sources.tables import Warehouse
from strataflow.spec import ENTITIES, LOAD_ORDER

RAW_SUFFIX = "LOAD_RAW_"
# Control tables that a batch writes, and how they are partitioned below the batch.
BATCH_TABLES = {
    "control/file_manifest": (), "control/etl_error": ("error_scope",), "control/etl_warning": (),
    "control/dim_change_log": ("log_scope",),
}
LOG_SCHEMA = (
    "log_id long, batch_id long, process_name string, step_name string, start_time timestamp_ntz, "
    "end_time timestamp_ntz, status string, rows_processed long, rows_inserted long, rows_rejected long, "
    "message string, created_at timestamp_ntz"
)
LOG_COLUMNS = tuple(part.split()[0] for part in LOG_SCHEMA.split(", "))
SOURCE_SYSTEM = "File Ingestion"
#: Keys of the facts, and the dimensions that hold their members.
_MEMBERS = {"customer_key": "dim_customer", "restaurant_key": "dim_restaurant", "delivery_partner_key": "dim_delivery_partner"}
FACT_LINKS = {
    "fact_order": {"order_date_key": "dim_date", "order_time_key": "dim_time", **_MEMBERS},
    "fact_order_item": {
        "order_date_key": "dim_date", "customer_key": "dim_customer", "restaurant_key": "dim_restaurant", "menu_item_key": "dim_menu_item",
    },
    "fact_delivery_performance": {"delivery_date_key": "dim_date", **_MEMBERS},
    "fact_rating": {"rating_date_key": "dim_date", "rating_time_key": "dim_time", **_MEMBERS},
}
#: Rating keys of one part of the review aspects.
ASPECT_SPAN = 1_000_000


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class RawLoadError(RuntimeError):
    """At least one entity failed to load into the raw layer."""


class NoStagedRows(RuntimeError):
    """A batch was asked for that no staged table holds."""


@dataclass
class BatchRun:
    spark: SparkSession
    warehouse: Warehouse
    batch_id: int
    as_of: Column
    calendar_start: str = "2024-01-01"
    calendar_end: str = "2026-12-31"
    #: Parts of a dimension; a batch writes those of the ids that it touches.
    dimension_buckets: int = 16
    log: list[dict] = field(default_factory=list)
    files: int = 0
    step_began: datetime = field(default_factory=_now)

    def _entry(self, process: str, step: str, processed: int, inserted: int, status: str, message: str = "") -> dict:
        now = _now()
        return {
            "log_id": self.batch_id * 1000 + len(self.log) + 1, "batch_id": self.batch_id, "process_name": process,
            "step_name": step, "start_time": self.step_began, "end_time": None if status == "RUNNING" else now, "status": status,
            "rows_processed": processed, "rows_inserted": inserted,
            "rows_rejected": max(processed - inserted, 0), "message": message, "created_at": now,
        }

    def begin(self, process: str, step: str) -> None:
        """A step starts. The log is stored with the step RUNNING in it, so a batch that dies shows how far it came."""
        self.step_began = _now()
        self._write_log(self._entry(process, step, 0, 0, "RUNNING"))

    def note(self, process: str, step: str, processed: int, inserted: int, status: str, message: str = "") -> None:
        """Log a finished step; it began where `begin` said so, or when the one before ended."""
        self.log.append(self._entry(process, step, processed, inserted, status, message))
        self.step_began = self.log[-1]["created_at"]

    def _write_log(self, *running: dict) -> None:
        rows = [tuple(r.values()) for r in (*self.log, *running)]
        self.warehouse.replace_batch("control/etl_log", self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), batch_id=self.batch_id)

    def _take_over(self) -> None:
        """Steps that an earlier run of the batch has left RUNNING become FAILED. They stay in the log, before those of this
        run; so do the ones that were closed like that before."""
        log = self.control("etl_log", self.batch_id)
        if log is None:
            return
        left = [r.step_name for r in log.filter("status = 'RUNNING'").select("step_name").distinct().collect()]
        for step in left:
            log = monitoring.close_stale_steps(log, step, F.lit(_now()))
        for row in log.filter(F.col("message") == monitoring.STALE_MESSAGE).orderBy("log_id").collect():
            held = row.asDict()
            number = {"log_id": self.batch_id * 1000 + len(self.log) + 1, "batch_id": self.batch_id}
            self.log.append({name: number.get(name, held[name]) for name in LOG_COLUMNS})

    # Files to raw -------------------------------------------------------------------------------------

    def land(self, folder: str) -> DataFrame:
        """Check every file, then load all of them, or none when one is bad. What an earlier run of the batch left in the
        control tables, and in the raw tables of entities that are not delivered now, goes first."""
        self._take_over()
        self._close("RUNNING", 0, 0)
        for name, parts in BATCH_TABLES.items():
            self.warehouse.clear_batch(name, self.batch_id, *parts)
        files = landing.discover_files(self.spark, folder)
        heads = landing.file_heads(self.spark, folder)
        checked = landing.check_files(files, heads).persist(StorageLevel.MEMORY_AND_DISK)
        outcome = landing.ingestion_outcome(checked).first()
        self.files = outcome.total_files
        self.warehouse.replace_batch(
            "control/file_manifest", landing.route_files(checked, self.batch_id), batch_id=self.batch_id
        )
        if outcome.outcome == "FAILED":
            self._write_errors("file", landing.file_errors(checked, self.batch_id, self.as_of))
            self._close("FAILED", 0, 0)
        if outcome.outcome == "LOAD_RAW":
            staged, breaking = {}, landing.breaking_files(checked)
            for entity in LOAD_ORDER:
                headers = landing.headers_of(checked, entity)
                if headers:
                    try:
                        staged[entity] = landing.land_entity(
                            self.spark, ENTITIES[entity], headers, self.batch_id, self.as_of, breaking,
                            store=lambda rows, e=entity: self._stage(e, rows),
                        )
                    except Exception as exc:
                        self._load_failed(entity, landing.STAGING_ERROR, exc)
                        self._close("FAILED", 0, 0)
                        raise
            self.load_raw(staged)
        return checked

    def load_raw(self, staged: dict[str, DataFrame]) -> None:
        """Replace the batch in every raw table. One failing entity does not stop the others; the batch
        fails at the end. Totals come from what the tables hold, so a replay gives the same numbers."""
        if not staged or not any(not df.isEmpty() for df in staged.values()):
            raise NoStagedRows(f"batch {self.batch_id} has no staged rows")
        for entity in set(LOAD_ORDER) - set(staged):
            self.warehouse.clear_batch(f"raw/{ENTITIES[entity].raw_table}", self.batch_id)
        failed = {}
        for entity, rows in staged.items():
            name = f"raw/{ENTITIES[entity].raw_table}"
            self.begin("STG_TO_RAW", RAW_SUFFIX + entity.upper())
            try:
                self.warehouse.replace_batch(name, rows, batch_id=self.batch_id)
                loaded = self.raw(entity).count()
                self.note("STG_TO_RAW", RAW_SUFFIX + entity.upper(), loaded, loaded, "SUCCESS")
            except Exception as exc:  # noqa: BLE001 - counted, reported below
                failed[entity] = exc
                self._load_failed(entity, landing.RAW_ERROR, exc)
                self.note("STG_TO_RAW", RAW_SUFFIX + entity.upper(), 0, 0, "FAILED", str(exc))
        if failed:
            self._close("FAILED", 0, 0)
            raise RawLoadError(f"raw load failed for {sorted(failed)}") from next(iter(failed.values()))

    def _stage(self, entity: str, rows: DataFrame) -> DataFrame:
        """Replace the batch in the entity's stage table and read it back."""
        name = f"stg/stg_{entity}"
        self.warehouse.replace_batch(name, rows, batch_id=self.batch_id)
        return self.warehouse.read(name).filter(F.col("batch_id") == self.batch_id).drop("batch_id")

    def _load_failed(self, entity: str, kind: str, exc: Exception) -> None:
        error = landing.load_error(self.spark, self.batch_id, entity, kind, str(exc), self.as_of)
        self._write_errors(f"load_{entity}", error)

    def raw(self, entity: str) -> DataFrame | None:
        table = self.warehouse.read(f"raw/{ENTITIES[entity].raw_table}")
        return None if table is None else table.filter(F.col("batch_id") == self.batch_id)

    # Raw to typed tables ------------------------------------------------------------------------------

    def typed(self, entity: str, before: int | None = None) -> DataFrame | None:
        return self.warehouse.current(f"ods/{ENTITIES[entity].ods_table}", before)

    def _parents(self, child: str) -> dict[str, DataFrame]:
        """The typed tables a child's ids are looked up in; one that does not exist yet is empty."""
        out = {}
        for _, entity, _ in gates.PARENT_COLUMNS.get(child, ()):
            table = self.typed(entity)
            if table is None:
                extra = ", is_cancelled boolean" if entity == "order" else ""
                table = self.spark.createDataFrame([], f"{ENTITIES[entity].key} string{extra}")
            out[entity] = table
        return out

    def load_typed(self, masters: dict[str, DataFrame] | None = None) -> None:
        masters = masters or {n: lookups.master_rows(self.spark, n) for n in lookups.MASTERS}
        for entity in LOAD_ORDER:
            raw, spec = self.raw(entity), ENTITIES[entity]
            if raw is None or raw.isEmpty():
                self.warehouse.withdraw(f"ods/{spec.ods_table}", self.batch_id)
                continue
            self.begin("RAW_TO_ODS", spec.step_name)
            gated = gates.apply_gates(entity, raw, masters, self._parents(entity), self.as_of.cast("date"))
            gated = gated.persist(StorageLevel.DISK_ONLY)
            self._write_errors(spec.raw_table, gates.quarantined(entity, gated, self.as_of))
            rows = clean.clean_rows(entity, gates.passed(gated)).persist(StorageLevel.DISK_ONLY)
            valid, total = rows.count(), gated.count()
            if entity == "order":
                self._write_warnings(rows)
            # A row stays in the part of the batch that brought its key first.
            self.warehouse.merge_parts(
                f"ods/{spec.ods_table}", rows.withColumn("_home", F.lit(self.batch_id).cast("long")), spec.key, "_home",
                lambda target, source, e=entity: source if target is None else upsert.upsert_entity(
                    e, target, source.select(*target.columns), kept=["_home"]
                ).drop("merge_action"),
                self.batch_id, self.batch_id,
            )
            status = "FAILED" if total and not valid else "PARTIAL" if valid < total else "SUCCESS"
            self.note("RAW_TO_ODS", spec.step_name, total, valid, status)
            rows.unpersist()
            gated.unpersist()

    def check_orders(self) -> None:
        """Raw orders of which none reached the typed table stop the batch before the star schema."""
        raw, typed = self.raw("order"), self._of_batch("order")
        if raw is None:
            return
        here = F.lit(self.batch_id).cast("long").alias("batch_id")
        raw = raw.select(here)
        typed = raw.filter("false") if typed is None else typed.select(here)
        no_steps = self.spark.createDataFrame([], LOG_SCHEMA)
        try:
            monitoring.enforce_guardrails(monitoring.guardrails(raw, typed, no_steps, F.lit(_now())))
        except monitoring.GuardrailError:
            self.close("FAILED")
            raise

    def check_steps(self) -> None:
        """Steps of this run that failed (all their rows were rejected) are raised once everything else is done."""
        failed = [r["step_name"] for r in self.log if r["status"] == "FAILED" and r["message"] != monitoring.STALE_MESSAGE]
        if failed:
            raise monitoring.GuardrailError(f"failed steps: {failed}")

    def _write_errors(self, table: str, errors: DataFrame) -> None:
        """Replace the errors of this batch and table. An error's id is a hash of what it is about, so a rerun gives the
        same ids."""
        about = ("batch_id", "table_name", "source_file_name", "source_row_number", "gate_id", "error_message")
        self.warehouse.replace_batch(
            "control/etl_error", errors.withColumn("error_id", F.xxhash64(*about)), batch_id=self.batch_id,
            error_scope=table,
        )

    def _write_warnings(self, orders: DataFrame) -> None:
        empty = {
            e: self.spark.createDataFrame([], f"{ENTITIES[e].key} string")
            for e in ("customer", "restaurant", "delivery_partner")
        }
        side = {e: self.typed(e) if self.typed(e) is not None else empty[e] for e in empty}
        found = warnings.order_warnings(
            orders, side["customer"], side["restaurant"], side["delivery_partner"]
        ).withColumn("warning_timestamp", self.as_of)
        about = ("batch_id", "order_id", "warning_type")
        self.warehouse.replace_batch(
            "control/etl_warning", found.withColumn("warning_id", F.xxhash64(*about)), batch_id=self.batch_id
        )

    # Typed tables to the star schema ------------------------------------------------------------------

    def dimension(self, name: str, before: int | None = None) -> DataFrame | None:
        return self.warehouse.current(f"dwh/{name}", before)

    def _of_batch(self, entity: str) -> DataFrame | None:
        """The rows that the batch has inserted or changed, from the parts that it has written."""
        table = self.warehouse.written_by(f"ods/{ENTITIES[entity].ods_table}", self.batch_id)
        return None if table is None else dimensions.of_batch(table, self.batch_id)

    def _facts_of_batch(self, name: str) -> DataFrame | None:
        table = self.warehouse.written_by(f"dwh/{name}", self.batch_id)
        return None if table is None else dimensions.of_batch(table, self.batch_id)

    def load_star(self, cache: DataFrame | None = None) -> None:
        orders = self._of_batch("order")
        effective = (
            dimensions.effective_date(orders, self.batch_id, self.as_of.cast("date"))
            if orders is not None
            else self.as_of.cast("date")
        )
        self._load_entity_dimensions(effective)
        self._load_menu()
        calendar = dim_date(self.spark, self.calendar_start, self.calendar_end)
        self._load_facts(calendar)
        self._enrich()
        self._load_review_aspects(cache)

    def _merge_dimension(self, name: str, business_id: str, rows: DataFrame | None, load: Callable) -> DataFrame | None:
        """Write the buckets that hold the ids of the rows. `load(base, first key)` gives their rows; returns the base."""
        place, buckets = f"dwh/{name}", dimensions.bucket_of(business_id, self.dimension_buckets)
        before = self.dimension(name, self.batch_id)
        if rows is None:
            if before is None:
                empty = dimensions.empty_dimension(self.spark, name)
                self.warehouse.publish_parts(place, empty.withColumn("_bucket", buckets), "_bucket", self.batch_id)
            else:
                self.warehouse.withdraw(place, self.batch_id)
            return None
        key = dimensions.DIMENSION_TYPES[name].split()[0]
        whole = before if before is not None else dimensions.empty_dimension(self.spark, name)
        found = rows.select(buckets.cast("string").alias("b")).distinct()
        mine = {r.b for r in found.collect()}
        parts = self.warehouse.parts(place, self.batch_id)
        base = whole if before is None else whole.filter(buckets.cast("string").isin(list(mine)))
        if parts is not None and (held := self.warehouse.current(place, self.batch_id, tuple(mine))) is not None:
            base = held
        merged = load(base, next_key(whole, key))
        self.warehouse.publish_parts(
            place, merged.select(*whole.columns).withColumn("_bucket", buckets), "_bucket", self.batch_id,
            [p for p in parts or () if p.value not in mine],
        )
        return base

    def _load_entity_dimensions(self, effective: Column) -> None:
        for name, (entity, source_of) in dimensions.SOURCES.items():
            spec = scd2.DIMENSIONS[name]
            rows = self._of_batch(entity)
            base = self._merge_dimension(
                name, spec.business_id, rows, lambda held, first, n=name, r=rows: dimensions.load_dimension(n, held, r, effective, first)
            )
            if base is None:
                continue
            changes = scd2.change_log(
                spec, base, source_of(rows), effective, F.lit(self.batch_id).cast("long"),
                self.warehouse.written_by(f"dwh/{name}", self.batch_id), self.as_of,
            )
            self.warehouse.replace_batch("control/dim_change_log", changes, batch_id=self.batch_id, log_scope=name)

    def _load_menu(self) -> None:
        items = self._of_batch("menu_item")
        self._merge_dimension(
            "dim_menu_item", "menu_item_id", items,
            lambda held, first: dimensions.load_menu_items(held, items, self.dimension("dim_restaurant"), first),
        )

    def _merge_fact(self, name: str, rows: DataFrame | None, date_column: str, before: int | None = None) -> None:
        """Facts live in month parts; only the months of changed rows are written, and what is derived from a month with
        it: the rows that wait for a parent, and the last activity."""
        place = f"dwh/{name}"
        if rows is None:
            for table in (place, f"{place}_orphans", *(["dwh/activity"] if name == "fact_order" else [])):
                self.warehouse.withdraw(table, self.batch_id)
            return
        month = F.when(F.col(date_column) < 0, -1).otherwise((F.col(date_column) / 100).cast("int"))
        source = rows.withColumn("month_key", month).persist(StorageLevel.DISK_ONLY)
        known = self.warehouse.current(place, before)
        first = 1 if known is None else next_key(known, facts.FACT_SURROGATES[name])
        touched = self.warehouse.merge_parts(
            place, source, facts.FACT_KEYS[name], "month_key",
            lambda target, src: facts.merge_fact(name, target, src, first), self.batch_id, before,
        )
        source.unpersist()
        written = self.warehouse.current(place, only=tuple(touched))
        derived = {}
        if name in facts.RELINK:
            derived[f"{place}_orphans"] = lambda: facts.orphans(name, written)
        if name == "fact_order":
            derived["dwh/activity"] = lambda: dimensions.month_activity(written)
        for table, make in derived.items():
            kept = [p for p in self.warehouse.parts(table, before) or () if p.value not in touched]
            if written is not None:
                self.warehouse.publish_parts(table, make(), "month_key", self.batch_id, kept)

    def _orders_of(self, rows: DataFrame) -> DataFrame:
        """The order facts that rows may belong to: the months that hold the range of their order ids."""
        ends = rows.agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
        return self.warehouse.between("dwh/fact_order", ends.low, ends.high)

    def _load_facts(self, calendar: DataFrame) -> None:
        customers, restaurants, partners = (self.dimension(n) for n in dimensions.SOURCES)
        orders = self._of_batch("order")
        self._merge_fact(
            "fact_order",
            None if orders is None else facts.build_fact_order(orders, calendar, customers, restaurants, partners),
            "order_date_key", self.batch_id,
        )
        if self.warehouse.parts("dwh/fact_order") is None:
            return
        items, deliveries, ratings = (self._of_batch(e) for e in ("order_item", "delivery_performance", "rating"))
        self._merge_fact(
            "fact_order_item",
            None if items is None else facts.build_fact_order_item(items, self._orders_of(items), self.dimension("dim_menu_item")),
            "order_date_key", self.batch_id,
        )
        self._merge_fact(
            "fact_delivery_performance",
            None if deliveries is None else facts.build_fact_delivery(deliveries, self._orders_of(deliveries), restaurants),
            "delivery_date_key", self.batch_id,
        )
        self._merge_fact(
            "fact_rating",
            None if ratings is None else facts.build_fact_rating(ratings, self._orders_of(ratings), calendar, customers, restaurants),
            "rating_date_key", self.batch_id,
        )

    def relink(self) -> None:
        """Fill -1 keys from parents that arrived after their children: the orders of this batch. The rows that wait for a
        parent are listed with their months, so only months that hold a child of such an order are opened."""
        arrived = self._facts_of_batch("fact_order")
        dates = {
            "fact_order_item": "order_date_key", "fact_delivery_performance": "delivery_date_key",
            "fact_rating": "rating_date_key",
        }
        for name, date_column in dates.items():
            waiting = self.warehouse.current(f"dwh/{name}_orphans")
            if waiting is None or arrived is None:
                continue
            hit = waiting.join(arrived.select("order_id"), "order_id", "left_semi")
            months = tuple(str(r.month_key) for r in hit.select("month_key").distinct().collect())
            table = self.warehouse.current(f"dwh/{name}", only=months)
            if table is None:
                continue
            fixed = facts.relink(name, table.drop("month_key"), arrived).filter("relinked").drop("relinked")
            if not fixed.isEmpty():
                self._merge_fact(name, fixed, date_column)

    def _enrich(self) -> None:
        """Second pass: facts read the old activity first, then the dimensions take the new one, in the buckets of the
        members that were active in the batch."""
        orders, activity = self._facts_of_batch("fact_order"), self.warehouse.current("dwh/activity")
        if orders is None or activity is None:
            return
        for name, (key, _, _) in dimensions.LIFE_CYCLE_COLUMNS.items():
            place, spec = f"dwh/{name}", scd2.DIMENSIONS[name]
            bucket = dimensions.bucket_of(spec.business_id, self.dimension_buckets)
            active = orders.filter(F.col(key) != -1).select(key).distinct()
            whole = self.dimension(name)
            hit = whole.join(active, key, "left_semi").select(bucket.cast("string").alias("b")).distinct()
            mine = tuple(r.b for r in hit.collect())
            held = self.warehouse.current(place, only=mine)
            if held is None:
                continue
            known = dimensions.with_activity(name, held, dimensions.stored_activity(name, activity, active))
            kept = [p for p in self.warehouse.parts(place) if p.value not in mine]
            self.warehouse.publish_parts(place, known.withColumn("_bucket", bucket), "_bucket", self.batch_id, kept)

    def _load_review_aspects(self, cache: DataFrame | None) -> None:
        """Aspects of the batch's ratings from the given cache and the one that earlier batches have stored. The stored one
        is kept by the first digit of the hash, the aspects by ranges of rating keys."""
        ratings = self._facts_of_batch("fact_rating")
        for name in ("ref/review_aspect_cache", "dwh/fact_review_aspect"):
            if ratings is None:
                self.warehouse.withdraw(name, self.batch_id)
        if ratings is None:
            return
        known = self.warehouse.current("ref/review_aspect_cache", self.batch_id)
        if cache is None and known is None:
            return
        if cache is not None:
            known = cache if known is None else aspect_cache.add_missing(known, cache.select(*known.columns))
        fresh = reviews.fallback_aspects(reviews.uncached_reviews(ratings, known)).select(*known.columns)
        entries = fresh if cache is None else aspect_cache.add_missing(cache.select(*known.columns), fresh)
        entries = entries.withColumn("_prefix", F.substring("review_hash", 1, 1))
        self.warehouse.merge_parts(
            "ref/review_aspect_cache", entries, "review_hash", "_prefix",
            lambda target, source: source if target is None else aspect_cache.add_missing(target, source),
            self.batch_id, self.batch_id, by_key=True,
        )
        rows = reviews.build_fact_review_aspect(ratings, self.warehouse.current("ref/review_aspect_cache"))
        place = "dwh/fact_review_aspect"
        before = self.warehouse.current(place, self.batch_id)
        first = 1 if before is None else next_key(before, "review_aspect_key")
        span = F.floor(F.col("rating_key") / ASPECT_SPAN).cast("long")

        def merge(target: DataFrame | None, source: DataFrame) -> DataFrame:
            seen = None if target is None else target.drop("_span")
            return reviews.merge_review_aspect(seen, source.drop("_span"), first).withColumn("_span", span)

        self.warehouse.merge_parts(
            place, rows.withColumn("_span", span), "rating_key", "_span", merge, self.batch_id, self.batch_id, by_key=True
        )

    # Close --------------------------------------------------------------------------------------------

    def _close(self, status: str, total: int, bad: int) -> None:
        batch = self.spark.range(1).select(
            F.lit(self.batch_id).cast("long").alias("batch_id"), F.lit("MONTHLY_BATCH").alias("pipeline_name"),
            F.lit(SOURCE_SYSTEM).alias("source_system"), F.lit(self.files).cast("int").alias("source_file_count"),
            self.as_of.alias("start_time"),
            F.when(F.lit(status != "RUNNING"), F.greatest(F.localtimestamp(), self.as_of)).alias("end_time"),
            F.lit(status).alias("status"), self.as_of.alias("created_at"),
            F.lit(total).cast("long").alias("total_records"),
            F.lit(total - bad).cast("long").alias("success_records"),
            F.lit(bad).cast("long").alias("error_records"),
        )
        self.warehouse.replace_batch("control/etl_batch", batch, batch_id=self.batch_id)
        self._write_log()

    def close(self, status: str | None = None) -> None:
        """Close the batch with its totals; the status follows from its errors unless it is given."""
        counts = [self.raw(e) for e in LOAD_ORDER]
        total = sum(df.count() for df in counts if df is not None)
        errors = self.warehouse.read("control/etl_error")
        bad = 0
        if errors is not None:
            bad = (
                errors.filter(F.col("batch_id") == self.batch_id)
                .select("table_name", "source_file_name", "source_row_number").distinct().count()
            )
        self._close(status or ("PARTIAL" if bad else "SUCCESS"), total, min(bad, total))

    def control(self, name: str, batch_id: int | None = None) -> DataFrame:
        """A control table, of one batch or all; None if no batch has written it."""
        table = self.warehouse.read(f"control/{name}")
        return table if table is None or batch_id is None else table.filter(F.col("batch_id") == batch_id)


def run_month(
    spark: SparkSession, root: str, folder: str, batch_id: int, as_of: Column, cache: DataFrame | None = None,
    masters: dict[str, DataFrame] | None = None, **options,
) -> BatchRun:
    """One whole batch. Running it again with the same files leaves every table as it was. Two guardrails raise an error:
    orders that all were rejected, before the star schema is loaded, and at the end any step that failed."""
    run = BatchRun(spark, Warehouse(spark, root), batch_id, as_of, **options)
    checked = run.land(folder)
    if checked.filter(~F.col("is_valid")).isEmpty() and not checked.isEmpty():
        run.load_typed(masters)
        run.check_orders()
        run.load_star(cache)
        run.relink()
        run.close()
        run.check_steps()
    return run


def verify_month(run: BatchRun) -> DataFrame:
    """The audits of one batch over the stored tables."""
    wh = run.warehouse
    errors, warned = run.control("etl_error", run.batch_id), run.control("etl_warning", run.batch_id)
    results = [audits.batch_status(run.control("etl_batch", run.batch_id))]
    if errors is not None:
        results.append(audits.audit_columns("etl_error", errors, ["batch_id", "table_name", "error_timestamp"]))
    if warned is not None:
        results.append(audits.warnings_complete(warned))
    loaded = {e: run.raw(e) for e in LOAD_ORDER}
    loaded = {e: rows for e, rows in loaded.items() if rows is not None and not rows.isEmpty()}
    if loaded:
        results.append(audits.raw_vs_log(loaded, run.control("etl_log", run.batch_id)))
    for entity in LOAD_ORDER:
        raw, typed = run.raw(entity), run.typed(entity)
        if raw is None or typed is None or raw.isEmpty():
            continue
        key = ENTITIES[entity].key
        results += [
            audits.lineage_unique(entity, raw),
            audits.metadata_complete(entity, raw),
            audits.trimmed(ENTITIES[entity].ods_table, typed, [key]),
            audits.key_unique(ENTITIES[entity].ods_table, typed, [key]),
            audits.key_present(ENTITIES[entity].ods_table, typed, key, "Business Key Integrity"),
        ]
    members = {
        n: (run.dimension(n), k)
        for n, k in (
            ("dim_customer", "customer_key"), ("dim_restaurant", "restaurant_key"),
            ("dim_delivery_partner", "delivery_partner_key"), ("dim_menu_item", "menu_item_key"),
        )
    }
    members["dim_date"] = (dim_date(run.spark, run.calendar_start, run.calendar_end), "date_key")
    members["dim_time"] = (dim_time(run.spark), "time_key")
    results.append(audits.unknown_members(members))
    results += [audits.timeline(n, run.dimension(n)) for n in dimensions.SOURCES]
    for entity, column in (("restaurant", "onboard_date"), ("delivery_partner", "onboard_date")):
        if entity in loaded:
            results.append(audits.column_filled(entity, loaded[entity], column))
    if "delivery_performance" in loaded:
        results.append(audits.timings_populated(loaded["delivery_performance"]))
    for name, (entity, _) in dimensions.SOURCES.items():
        if run.typed(entity) is not None:
            known = run.dimension(name).filter(F.col(scd2.DIMENSIONS[name].key) != -1)
            results.append(audits.layer_match(entity, run.typed(entity), known, scd2.DIMENSIONS[name].business_id))
    stored = {fact: wh.current(f"dwh/{fact}") for fact in (*facts.FACT_KEYS, "fact_review_aspect")}
    for fact, keys in FACT_LINKS.items():
        if stored[fact] is None:
            continue
        results.append(audits.no_null_keys(fact, stored[fact], list(keys)))
        for key, dimension in keys.items():
            if dimension in members:
                table, member = members[dimension]
                results.append(audits.no_orphans(fact, stored[fact], dimension, table, member, key))
    for entity, fact in (("order", "fact_order"), ("order_item", "fact_order_item"), ("delivery_performance", "fact_delivery_performance"), ("rating", "fact_rating")):
        if run.typed(entity) is not None and stored[fact] is not None:
            results.append(audits.layer_match(entity, run.typed(entity), stored[fact]))
    if run.typed("delivery_performance") is not None and run.typed("order_item") is not None:
        results.append(audits.item_quantity(run.typed("delivery_performance"), run.typed("order_item")))
    if stored["fact_order"] is not None and stored["fact_order_item"] is not None:
        results.append(audits.amount_checks(stored["fact_order"], stored["fact_order_item"]))
    if stored["fact_review_aspect"] is not None:
        results.append(audits.review_aspects(
            stored["fact_review_aspect"], stored["fact_rating"], lookups.aspects(run.spark), lookups.sentiment_types(run.spark)
        ))
    return audits.union(results)
