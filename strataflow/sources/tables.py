"""Parquet tables of the layers.

Raw and control tables are partitioned by batch and replaced one batch at a time, with the rows of the rerun or
with nothing, so a rerun neither duplicates nor leaves stale rows.

Typed tables, dimensions and facts are published: a version is a list of parts, each a folder that is written once and
never changed. A batch writes the parts it touches and points to the old folders for the rest; the version becomes
visible by one append of its list to a small table. So a job that dies leaves the old state whole, and a batch that runs
again starts from the state before it. Lists carry the range of keys of each part, which tells the parts that
a key may be in. `purge_versions` removes the folders that no version kept names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "control/table_versions"
VERSION_TYPES = {
    "table_name": pa.string(), "batch_id": pa.int64(), "version": pa.string(), "purged": pa.bool_(), "part": pa.string(),
    "path": pa.string(), "low": pa.string(), "high": pa.string(), "published_at": pa.timestamp("us"),
}
#: Columns that only tell parts apart begin with this; readers of a table do not see them.
HIDDEN = "_"


@dataclass(frozen=True)
class Part:
    """A folder of a published table: its value of the part column, and the least and greatest key in it."""

    value: str | None
    path: str
    low: str | None = None
    high: str | None = None


@dataclass
class Version:
    """A published state of a table."""

    batch_id: int
    published_at: datetime
    parts: list[Part] = field(default_factory=list)


class Warehouse:
    """The tables below a folder. The list of versions is read once, with the first use of a published table; later this
    object's own publications are added. Batches run one after another, each with an object of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._versions: dict[str, dict[str, Version]] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self._read(self.path(name)) is not None

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self, name: str) -> DataFrame | None:
        """A table that batches replace in place."""
        return self._read(self.path(name))

    # Batch-partitioned tables -------------------------------------------------------------------------

    def replace_batch(self, name: str, rows: DataFrame, **scope) -> None:
        """Replace one partition, named by its partition columns and values, also where there are no rows. All rows
        belong to it; the partition columns need not be among them."""
        place = "".join(f"/{column}={value}" for column, value in scope.items())
        rows.drop(*scope).write.mode("overwrite").parquet(self.path(name) + place)

    def clear_batch(self, name: str, batch_id: int, *parts: str) -> None:
        """Empty every partition that a batch has below its batch id (one per value of the other partition columns, of
        which there are a few per table)."""
        table = self.read(name)
        if table is None:
            return
        mine = table.filter(F.col("batch_id") == batch_id)
        for row in mine.select("batch_id", *parts).distinct().collect():
            self.replace_batch(name, self.spark.createDataFrame([], table.schema), **row.asDict())

    def replace_partitions(self, name: str, rows: DataFrame, by: Sequence[str] = ("batch_id",)) -> None:
        """Replace the partitions that the rows fall into; others stay."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path(name))

    # Published versions -------------------------------------------------------------------------------

    def _known(self) -> dict[str, dict[str, Version]]:
        """All versions of all tables by their id. They hold one row per part and version; purges mark old ones."""
        if self._versions is None:
            self._versions = {}
            listed = self.read(VERSIONS)
            gone = None if listed is None else listed.filter("purged").select("version")
            for r in [] if listed is None else listed.filter("NOT purged").join(gone, "version", "left_anti").collect():
                version = self._versions.setdefault(r.table_name, {}).setdefault(r.version, Version(r.batch_id, r.published_at))
                if r.path is not None:
                    version.parts.append(Part(r.part, r.path, r.low, r.high))
        return self._versions

    def parts(self, name: str, before: int | None = None) -> list[Part] | None:
        """The parts of the latest version, or of the latest one of an earlier batch; None if there is none, or an empty
        one. A table has one row per part here, so the driver holds as many as it has months or batches."""
        found = [v for v in self._known().get(name, {}).values() if before is None or v.batch_id < before]
        latest = max(found, key=lambda v: (v.batch_id, v.published_at), default=None)
        return None if latest is None else sorted(latest.parts, key=lambda p: p.value or "") or None

    def current(self, name: str, before: int | None = None, only: Sequence[str] | None = None) -> DataFrame | None:
        """The rows of the latest version, or of the latest one of an earlier batch; with `only` those of some parts."""
        return self._visible(self._rows(self.parts(name, before), only))

    @staticmethod
    def _visible(rows: DataFrame | None) -> DataFrame | None:
        return None if rows is None else rows.select(*[c for c in rows.columns if not c.startswith(HIDDEN)])

    def _rows(self, parts: list[Part] | None, only: Sequence[str] | None = None) -> DataFrame | None:
        paths = [p.path for p in parts or () if only is None or p.value in only]
        return self.spark.read.parquet(*paths) if paths else None

    def publish(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write a whole table as one part, then make it visible. Returns the written table, cut from its lineage."""
        path = self.path(f"{name}/batch={batch_id}-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        self._point(name, [Part(None, path)], batch_id)
        return self.current(name)

    def publish_parts(self, name: str, rows: DataFrame, part: str, batch_id: int, kept: Sequence[Part] = (), key: str | None = None) -> None:
        """Write rows by the values of their column `part`, then make them visible together with the parts `kept` of an
        earlier version."""
        folder = self.path(f"{name}/batch={batch_id}-{uuid.uuid4().hex}")
        rows.withColumn("part_dir", F.col(part)).write.partitionBy("part_dir").parquet(folder)
        written = self._read(folder)
        made = []
        if written is not None and "part_dir" in written.columns:
            ends = (F.min(key).cast("string"), F.max(key).cast("string")) if key else (F.lit(None).cast("string"),) * 2
            told = written.groupBy(F.col("part_dir").cast("string").alias("v")).agg(ends[0].alias("low"), ends[1].alias("high"))
            made = [Part(r.v, f"{folder}/part_dir={r.v}", r.low, r.high) for r in told.collect()]
        self._point(name, [*kept, *made], batch_id)

    def merge_parts(
        self, name: str, source: DataFrame, key: str, part: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame],
        batch_id: int, before: int | None = None, by_key: bool = False,
    ) -> set[str]:
        """Merge rows into the parts they touch, and publish: the parts of the rows themselves, and those that hold rows
        of the same keys. Returns the values of those parts.

        `merge(target, source)` gives the rows of the touched parts, of which a row may change its part; target is None
        where there is nothing yet. Only parts whose range of keys meets that of the source are looked through, by their
        key column alone; none where the part follows from the key (`by_key`). The base is the latest version, or the latest
        one of an earlier batch."""
        base = self.parts(name, before) or []
        ends = source.groupBy(F.col(part).cast("string").alias("v")).agg(F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")).collect()
        touched = {r.v for r in ends}
        if not touched:
            self._point(name, base, batch_id)
            return touched
        if not by_key:
            low, high = min(r.low for r in ends), max(r.high for r in ends)
            met = [p.value for p in base if p.value not in touched and p.low is not None and p.low <= high and p.high >= low]
            rows = self._rows(base, met)
            if rows is not None:
                hit = rows.select(key, part).join(source.select(key), key, "left_semi").select(F.col(part).cast("string").alias("v"))
                touched |= {r.v for r in hit.distinct().collect()}
        merged = merge(self._rows(base, tuple(touched)), source)
        self.publish_parts(name, merged, part, batch_id, [p for p in base if p.value not in touched], key)
        return touched

    def between(self, name: str, low: str | None, high: str | None) -> DataFrame | None:
        """The rows of the parts whose keys may lie in a range, from one part at least; None without a version."""
        parts = self.parts(name) or []
        met = [p for p in parts if low is not None and p.low is not None and p.low <= high and p.high >= low]
        return self._visible(self._rows(met or parts[:1]))

    def written_by(self, name: str, batch_id: int) -> DataFrame | None:
        """The rows of the parts that a batch has written into the latest version."""
        mine = [p for p in self.parts(name) or () if f"/batch={batch_id}-" in p.path]
        return self._visible(self._rows(mine))

    def withdraw(self, name: str, batch_id: int) -> None:
        """Go back to the version before a batch, if the batch has published one."""
        if self.parts(name) != (before := self.parts(name, batch_id)):
            self._point(name, before or (), batch_id)

    def _point(self, name: str, parts: Sequence[Part], batch_id: int) -> None:
        """Make a version visible. Its list is one file, which appears as a whole or not at all."""
        known, version, now = self._known(), uuid.uuid4().hex, datetime.now(UTC).replace(tzinfo=None)
        self._list([(name, batch_id, version, False, p.value, p.path, p.low, p.high, now) for p in parts or (Part(None, None),)])
        known.setdefault(name, {})[version] = Version(batch_id, now, parts=list(parts))

    def _list(self, rows: list[tuple]) -> None:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), VERSION_TYPES.values())]
        self.append(VERSIONS, self.spark.createDataFrame(pa.Table.from_arrays(columns, names=list(VERSION_TYPES))).coalesce(1))

    def purge_versions(self, keep: int, names: Sequence[str] | None = None) -> int:
        """Keep the last `keep` versions of each table; remove the folders that only older ones name. First the old
        versions are marked, so that no reader finds them, then folders go; a purge that dies is finished by the next one.
        Readers that still work on an old version lose it. Returns the number of folders removed."""
        if keep < 1:
            raise ValueError("the current version is always kept")
        now, old = datetime.now(UTC).replace(tzinfo=None), []
        tables = [n for n in self._known() if names is None or n in names]
        for name in tables:
            found = sorted(self._known()[name].items(), key=lambda v: (v[1].batch_id, v[1].published_at))
            old += [(name, v.batch_id, version, True, None, None, None, None, now) for version, v in found[:-keep]]
        if old:
            self._list(old)
            self._versions = None
        if self.read(VERSIONS) is None:
            return 0
        versions = self.read(VERSIONS).filter(F.col("table_name").isin(tables))
        gone = versions.filter("purged").select("version").distinct()
        named = versions.filter("path IS NOT NULL")
        held = named.join(gone, "version", "left_anti").select("path")
        removed = 0
        for r in named.join(gone, "version", "left_semi").select("path").distinct().join(held, "path", "left_anti").collect():
            place = self.spark._jvm.org.apache.hadoop.fs.Path(r.path)
            removed += place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        return removed
