"""Registered queries and their oracle SQL."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.plans import source_maps
from strataflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


class Source:
    """The given tables, plain or mapped, of one data folder. Each is set up once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict = {}

    def once(self, key, make: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._made:
            self._made[key] = make()
        return self._made[key]

    def table(self, name: str) -> DataFrame:
        return self.once(("table", name), lambda: source_maps.table(self.spark, self.folder, name))

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table that the query works on as stored: written to the shared folder once and read back."""

        def write() -> DataFrame:
            path = scratch_path(self.spark, name)
            made = make()
            made.write.parquet(path)
            return self.spark.read.schema(made.schema).parquet(path)

        return self.once(("stored", name), write)

    def __call__(self, name: str) -> DataFrame:
        return self.once(("map", name), lambda: source_maps.rows(self.table, name))


def present(df: DataFrame) -> DataFrame:
    """Plain output types: dates and times as ISO text, decimals as doubles."""

    def plain(field: T.StructField):
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def fragment(name: str, sql: str) -> None:
    """A named SELECT that oracle SQL may refer to."""
    FRAGMENTS[name] = sql


def _fragment_sql(name: str) -> str | None:
    if name in FRAGMENTS:
        return FRAGMENTS[name]
    return source_maps.sql(name) if name in source_maps.ALL else None


def compose(body: str) -> str:
    """Put the mapped tables and fragments a SELECT mentions in front of it, parents first. One that is mentioned more than
    once is worked out once."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", sql)):
            if word not in ordered:
                part = _fragment_sql(word)
                if part is not None and part != sql:
                    visit(part)
                    if word not in ordered:
                        ordered.append(word)

    visit(body)
    if not ordered:
        return body
    words = Counter(w for sql in (body, *(_fragment_sql(n) for n in ordered)) for w in re.findall(r"[a-z_0-9]+", sql))
    head = "WITH " + ", ".join(f"{n} AS {'MATERIALIZED ' if words[n] > 1 else ''}({_fragment_sql(n)})" for n in ordered)
    return head + ", " + body[5:] if body.startswith("WITH ") else head + " " + body


def query(name: str, oracle: str | None = None):
    """Register a function of `Source` under a name."""

    def add(build: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, folder: present(build(Source(spark, folder)))
        if oracle is not None:
            ORACLES[name] = compose(oracle)
        return build

    return add


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


def txt(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)
