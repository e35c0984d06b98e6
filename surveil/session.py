"""Session defaults for local runs. On a cluster the caller's session is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# All of these are either Spark defaults stated openly, because the operators rely on
# them, or local-run settings.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str | None = None, app: str = "surveil", **conf: str) -> SparkSession:
    """A local session. Shuffle partitions follow the core count; AQE coalesces below that."""
    cpus = str(cpus or os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **ADAPTIVE,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.debug.maxToStringFields": "100",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
