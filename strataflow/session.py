"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks. Queries set nothing in the caller's session: shuffle width, broadcast limits
    and code generation stay with the cluster's configuration."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strataflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # The JVM does not compile methods above 8000 bytes of code; wide gate stages then run in Spark's split-up form.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # The given tables are single small files; smaller splits spread their text work over the cores.
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names. Without one a local session takes its warehouse; on a
    cluster executors might not see that."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/strataflow/{name}-{uuid.uuid4().hex}"
