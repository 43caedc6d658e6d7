"""Collection in batches that can be broken off and taken up again: ledgers, pending work, the failure breaker."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terralume.operators import incremental, latest
from terralume.sources import sinks

#: Statuses after which a key is not tried again; of others, those that count as failures.
TERMINAL = ("not_found", "skipped_no_url")
BATCH_ROWS = 500
LEDGER = "key string, status string, updated_at string, listing_url string, property_id string, business_type string, label string, scheduled_index bigint"


def ledger_entries(outcomes: DataFrame, label: str, updated_at: Column) -> DataFrame:
    """A ledger row for each outcome (``key, status, scheduled_index`` and the record's url, id and type); rows without key are left out.

    Texts are trimmed, blank ones null.
    """
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    return outcomes.where(text("key").isNotNull()).select(text("key").alias("key"), "status", updated_at.alias("updated_at"), *[text(c).alias(c) for c in ("listing_url", "property_id", "business_type")], F.lit(label).alias("label"), F.col("scheduled_index").cast("bigint").alias("scheduled_index"))


def breaker_stop(outcomes: DataFrame, order: str, status: str, failures: tuple[str, ...], neutral: tuple[str, ...] = TERMINAL, at_least: int = 5, flow: str | None = None) -> DataFrame:
    """``flow, stop_at``: the ``order`` of the ``at_least``-th failure on end. A success begins the count anew; neutral outcomes are passed over.

    Only failures and successes are ordered, in each flow (``label``; one flow if none is given).
    """
    named = outcomes.withColumn("_flow", F.col(flow) if flow else F.lit("all")).where(~F.col(status).isin(*neutral) | F.col(status).isNull())
    failed = F.coalesce(F.col(status).isin(*failures), F.lit(False))
    from pyspark.sql import Window

    in_order = Window.partitionBy("_flow").orderBy(order)
    marked = named.withColumn("_failed", failed).withColumn("_run", F.sum(F.when(F.col("_failed"), 0).otherwise(1)).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    counted = marked.where("_failed").withColumn("_n", F.row_number().over(Window.partitionBy("_flow", "_run").orderBy(order)))
    return counted.where(F.col("_n") == at_least).groupBy("_flow").agg(F.min(order).alias("stop_at")).withColumnRenamed("_flow", flow or "flow")


def next_batch(pending: DataFrame, ordinal: str, rows: int = BATCH_ROWS) -> DataFrame:
    """The first ``rows`` pending records: a batch is what one round takes on."""
    return pending.orderBy(ordinal).limit(max(1, rows))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path) if os.path.exists(path) else spark.createDataFrame([], schema)


def collect_in_batches(spark: SparkSession, records: DataFrame, key: str, ordinal: str, fetch: Callable[[DataFrame], tuple[DataFrame, DataFrame]], folder: str, label: str, batch_rows: int = BATCH_ROWS, most_failures: int = 5, failures: tuple[str, ...] = ("failed",), schema: str | None = None) -> tuple[DataFrame, dict]:
    """(records saved so far, metrics) after rounds of ``fetch`` over what is pending, until nothing is, or nothing gets done.

    ``fetch`` takes a batch and gives (records to save, outcomes: ``key, status, scheduled_index, listing_url, property_id,
    business_type``). Saved records and outcomes are appended to ledgers in ``folder`` (JSON lines), which say what is done, so a run that
    is broken off goes on where it stood, its metrics too. The first ``most_failures`` failures on end stop it. Each round leaves
    an interim table of what is saved; at the end it is removed.
    """
    saved_path, done_path, state_path, interim = (os.path.join(folder, n) for n in ("records.jsonl", "processed.jsonl", "state.json", "incomplete_records"))
    os.makedirs(folder, exist_ok=True)
    columns = schema or ", ".join(f"`{c}` string" for c in records.columns if c != ordinal)
    state = sinks.read_json(state_path) if os.path.exists(state_path) else {}
    metrics = restored({"label": label, "items_seen": 0, "items_kept": 0, "pages_processed": 0, "batches_started": 0, "pending_records": 0, "stop_reason": None}, state.get("metrics"))
    metrics |= {"items_seen": records.count(), "stop_reason": None}
    while True:
        saved, done = _read(spark, saved_path, columns), _read(spark, done_path, LEDGER)
        over = incremental.completed_keys(saved.select(key), done.select(F.col("key").alias(key), "status"), key, "status", TERMINAL)
        waiting = incremental.pending(records, over, [key], ordinal)
        before = over.count()
        metrics |= {"pending_records": waiting.count(), "pages_processed": before, "items_kept": saved.select(key).distinct().count()}
        if not metrics["pending_records"]:
            metrics["stop_reason"] = "completed"
            break
        metrics["batches_started"] += 1
        sinks.write_json({"label": label, "status": "in_progress", "updated_at": datetime.now(timezone.utc).isoformat(), "metrics": metrics}, state_path)
        got, outcomes = fetch(next_batch(waiting, ordinal, batch_rows))
        entries = ledger_entries(outcomes, label, F.lit(datetime.now(timezone.utc).isoformat()))
        sinks.append_jsonl(got, saved_path)
        sinks.append_jsonl(entries, done_path)
        sinks.write_parquet(_read(spark, saved_path, columns), interim)
        tail = _read(spark, done_path, LEDGER)
        if not breaker_stop(tail, "scheduled_index", "status", failures, at_least=most_failures, flow="label").isEmpty():
            metrics["stop_reason"] = "max_consecutive_failures"
            break
        after = incremental.completed_keys(_read(spark, saved_path, columns).select(key), tail.select(F.col("key").alias(key), "status"), key, "status", TERMINAL).count()
        if after <= before:
            metrics["stop_reason"] = "pending_transient_failures"
            break
    sinks.write_json({"label": label, "status": "completed" if metrics["stop_reason"] == "completed" else "stopped", "updated_at": datetime.now(timezone.utc).isoformat(), "metrics": metrics}, state_path)
    if metrics["stop_reason"] == "completed":
        shutil.rmtree(interim, ignore_errors=True)
    result = _read(spark, saved_path, columns).withColumn("_n", F.monotonically_increasing_id())
    return latest.first_per_key(result, [key], "_n").drop("_n"), metrics


def restored(metrics: dict, saved: dict | None) -> dict:
    """Metrics with the values that an earlier run left for them; names it didn't know are not taken on."""
    return metrics | {k: v for k, v in (saved or {}).items() if k in metrics} if isinstance(saved, dict) else metrics
