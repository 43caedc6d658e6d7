"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings for any cluster: AQE sizes and splits partitions at run time; UTC and ANSI mode fix results.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "6g", **more: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    conf = SETTINGS | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus), "spark.driver.host": "127.0.0.1"} | more
    session = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
