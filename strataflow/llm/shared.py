"""The shared scratch folder and the tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor sees: below `spark.checkpoint.dir`, or below the warehouse where that is
    unset (tests, single machines)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


#: The session setting with the key of surrogates, and the key of tests and trials, which protects nothing.
KEY_SETTING, TEST_KEY = "spark.strataflow.surrogateKey", b"test key without protection"


def surrogate_key(spark: SparkSession) -> bytes:
    """The session's key of surrogates; without one the test key."""
    held = spark.conf.get(KEY_SETTING, None)
    return held.encode() if held else TEST_KEY


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps do not depend on executors that are lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows per batch between Spark and its Python workers. Spark's 10,000 make batches of hundreds of MB of long documents.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "3000")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per Spark context, so that their Python workers can import it. Arrow
    batches get fewer rows, unless the session names a number of its own; this is the one setting that is touched."""
    context = spark.sparkContext
    name, usual, fewer = BATCH_ROWS
    if spark.conf.get(name, usual) == usual:
        spark.conf.set(name, fewer)
    if getattr(context, "_strataflow_sent", False):
        return spark
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="strataflow-")) / "strataflow.zip"
    with zipfile.ZipFile(path, "w") as bundle:
        for file in sorted(root.rglob("*.py")):
            bundle.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    context._strataflow_sent = True
    return spark
