"""Change detection and upserts over streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from terralume.operators.latest import top_per_key


def stream_changes(stream: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """``key, value, change`` of each batch's rows against the last value of their key: new, updated or unchanged.

    Keyed state holds one value for each key; rows of a key within a batch are put in order of ``ordinal`` first, so a batch must be small
    enough for a key's rows of it to fit into a task (``maxFilesPerTrigger``). Null keys are one key. A restart goes on from the checkpoint.
    """
    kind = dict(stream.dtypes)
    out = f"{key} {kind[key]}, {value} {kind[value]}, {ordinal} {kind[ordinal]}, change string"
    narrow = stream.select(key, value, ordinal)

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # a key's rows of one batch may come in several frames, in any order
        rows = pd.concat(list(frames), ignore_index=True).sort_values(ordinal, kind="stable")
        text = rows[value].map(lambda v: None if pd.isna(v) else str(v))
        before = text.shift(1)
        first = pd.Series(range(len(rows)), index=rows.index) == 0
        if state.exists:
            before = before.where(~first, state.get[0])
        same = (text == before) | (text.isna() & before.isna())
        change = pd.Series("updated", index=rows.index).where(~same, "unchanged")
        if not state.exists:
            change = change.where(~first, "new")
        state.update((text.iloc[-1],))
        yield rows.assign(change=change)[[key, value, ordinal, "change"]]

    return narrow.groupBy(key).applyInPandasWithState(step, out, T.StructType([T.StructField("last", T.StringType())]), "append", GroupStateTimeout.NoTimeout)


def windowed_counts(stream: DataFrame, at: str, late: str, width: str, key: str) -> DataFrame:
    """Counts by event-time window and key; rows later than the watermark are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), key, "n")


#: Files of a kept-up table are told apart by so many buckets of the key; a batch writes only those it touches.
BUCKETS = 64


def upsert_stream(stream: DataFrame, target: str, key: list[str], order: list[str], checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps the newest row of each key in ``target``: a folder for each batch, partitioned by bucket of the key.

    A batch reads the newest version of the buckets its keys fall in and writes those again; others stay as they are. ``read_upserted``
    gives the table. A batch that is run again after a failure writes its own folder again, so it changes nothing. Ties in
    ``order`` may go to either row; null keys are keys. Buckets that no batch reads any more can be removed by ``compact``.
    """

    return stream.writeStream.foreachBatch(lambda batch, n: merge_batch(batch, target, n, key, order, buckets)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batch(batch: DataFrame, target: str, batch_id: int, key: list[str], order: list[str], buckets: int = BUCKETS) -> None:
    """One batch into ``target``, as version ``batch_id`` of the buckets it touches."""
    fresh = batch.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    known = _versions(batch.sparkSession, target, batch_id)
    both = fresh
    if known is not None:
        touched = fresh.select("_bucket").distinct()
        both = known.join(F.broadcast(touched), "_bucket", "left_semi").unionByName(fresh, allowMissingColumns=True)  # at most ``buckets`` rows
    newest = top_per_key(both, ["_bucket", *key], [F.col(c).desc_nulls_last() for c in order])
    newest.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/_version={batch_id}")


def _versions(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The newest version of each bucket, of batches before ``before``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where) or not any(int(s.getPath().getName()[9:]) < (1 << 60 if before is None else before) for s in files.listStatus(where) if s.getPath().getName().startswith("_version=")):
        return None
    rows = spark.read.parquet(target)
    if before is not None:
        rows = rows.where(F.col("_version") < before)
    # folders and buckets are partitions: which version is the newest is known from the names of files alone
    newest = rows.select("_bucket", "_version").distinct().groupBy("_bucket").agg(F.max("_version").alias("_version"))
    return rows.join(F.broadcast(newest), ["_bucket", "_version"], "left_semi").drop("_version")


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """The table that ``upsert_stream`` keeps."""
    return _versions(spark, target).drop("_bucket")


def compact(spark: SparkSession, target: str, batch_id: int) -> None:
    """The whole table as version ``batch_id``; older folders can go."""
    _versions(spark, target).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/_version={batch_id}")
