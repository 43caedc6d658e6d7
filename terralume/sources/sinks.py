"""Sinks: snapshots, stores that are read and rewritten, ledgers, exports."""

from __future__ import annotations

import json
import os
import shutil
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.functions.scalars import blank


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~blank(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    blanks_to_null(df).write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def swap_in(df: DataFrame, path: str) -> None:
    """Write beside ``path`` and swap: a table may be written from itself, and a failed write leaves the old one.

    A directory of one machine or shared file system; on an object store, write a new version and move the reader's pointer.
    """
    fresh, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.parquet(fresh)
    if os.path.exists(path):
        os.rename(path, old)
    os.rename(fresh, path)
    shutil.rmtree(old, ignore_errors=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def export_csv_file(df: DataFrame, path: str) -> None:
    """One CSV with byte-order mark for spreadsheets; rows come to the driver partition by partition, never all at once."""
    import csv

    part = f"{path}.tmp"
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(part, "w", encoding="utf-8-sig", newline="") as file:
        out = csv.writer(file)
        out.writerow(df.columns)
        for row in df.toLocalIterator(prefetchPartitions=False):
            out.writerow(["" if v is None else v for v in row])
    os.replace(part, path)


def write_zip_cache(entries: DataFrame, path: str) -> None:
    """A cache file, one JSON object by zip code, from ``zip, entry``; written as one file, row by row, and swapped in whole."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as file:
        file.write("{")
        for i, row in enumerate(entries.orderBy("zip").toLocalIterator(prefetchPartitions=False)):
            file.write(("," if i else "") + "\n" + json.dumps(row["zip"]) + ": " + row["entry"])
        file.write("\n}\n")
    os.replace(f"{path}.tmp", path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Rejected cards in the seven columns of their file; a table without rows leaves its header."""
    columns = ["flow", "invalid_reason", "listing_url", "price_brl", "listing_posted_at", "raw_card_date_text", "title"]
    export_csv_file(rejected.select(*[F.col(c) if c in rejected.columns else F.lit(None).cast("string").alias(c) for c in columns]), path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_json(value: object, path: str) -> None:
    """JSON for one reader, swapped in whole."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as file:
        json.dump(value, file, ensure_ascii=False, indent=2, default=str)
    os.replace(f"{path}.tmp", path)


def read_json(path: str) -> dict:
    with open(path, encoding="utf-8-sig") as file:
        return json.load(file)
