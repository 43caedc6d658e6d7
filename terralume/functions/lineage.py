"""Cutting lineage through storage that every executor can read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where that is unset (tests, local runs) one of our own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="terralume-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return configured


_written: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder: later reads survive lost executors, recompute nothing and take only
    the columns they need. The table stays until ``clear`` or the end of the process, as what was read from it may still be in use.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def clear() -> None:
    """Removes the tables that ``cut`` has written; call it when their results are stored."""
    while _written:
        spark, path = _written.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may be over, and its folder with it
            continue


atexit.register(clear)
