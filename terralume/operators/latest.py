"""One row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terralume.functions.lineage import cut


def top_per_key(df: DataFrame, key: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total ``order``; null key parts are values like others.

    The planner cuts each task's rows to ``n`` per key before the exchange (a window group limit), so one key
    with a third of all rows sends ``n`` rows from each task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their place, from 1, in a total ``order``: sorted by ranges and counted range by range, so no task sees all rows.

    What is sent to all tasks is one row for each range.
    """
    sorted_rows = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return sorted_rows.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, place).drop("_at", "_part", "_before")


def latest_per_key(df: DataFrame, key: Sequence[str], at: str, ordinal: str, text_key: bool = True) -> DataFrame:
    """The newest row: ``at`` descending, nulls last, ties to the later ``ordinal``. In text keys null equals empty."""
    parts = [F.coalesce(F.col(k), F.lit("")) if text_key else F.col(k) for k in key]
    return top_per_key(df, parts, [F.col(at).desc_nulls_last(), F.col(ordinal).desc()])


def first_per_key(df: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    return top_per_key(df, list(key), [F.col(ordinal).asc()])


def required_key(business: str, record_id: str, url: str) -> Column:
    """Whether a record can be kept: a business type, and an id or a URL."""
    present = [F.coalesce(F.col(c).rlike(r"\S"), F.lit(False)) for c in (business, record_id, url)]
    return present[0] & (present[1] | present[2])


def dedupe_records(df: DataFrame, source: str, business: str, record_id: str, url: str, ordinal: str) -> DataFrame:
    """First row of each record: by id, else by URL; rows with neither are dropped."""
    keyed = df.where(F.coalesce(F.col(record_id).rlike(r"\S"), F.lit(False)) | F.coalesce(F.col(url).rlike(r"\S"), F.lit(False)))
    has_id = F.coalesce(F.col(record_id).rlike(r"\S"), F.lit(False))
    parts = [F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(business), F.lit("")), F.when(has_id, F.trim(record_id)).otherwise(""), F.when(has_id, "").otherwise(F.trim(url))]
    return top_per_key(keyed, parts, [F.col(ordinal).asc()])


def islands(df: DataFrame, flow: str, position: str, sterile: Column) -> DataFrame:
    """Runs of consecutive rows that are ``sterile``: flow, first and last position, length."""
    w = Window.partitionBy(flow).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_s", sterile).withColumn("_run", F.sum(F.when(F.col("_s"), 0).otherwise(1)).over(w))
    return marked.where("_s").groupBy(flow, "_run").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("length")).drop("_run")


def stop_position(runs: DataFrame, flow: str, at_least: int = 3) -> DataFrame:
    """Where a flow stops: at the ``at_least``-th row of its first run that is long enough; positions are whole numbers without gaps."""
    return runs.where(F.col("length") >= at_least).groupBy(flow).agg((F.min("first") + at_least - 1).alias("stop_at"))
