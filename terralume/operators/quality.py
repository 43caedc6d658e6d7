"""Data-quality checks, rejects, and integrity between tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_reason(reasons: Mapping[str, Column]) -> Column:
    """The first reason that holds, in the order given; null for a valid record."""
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in reasons.items()])


def split_rejects(df: DataFrame, reasons: Mapping[str, Column], column: str = "invalid_reason") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    judged = df.withColumn(column, reject_reason(reasons))
    return judged.where(F.col(column).isNull()).drop(column), judged.where(F.col(column).isNotNull())


def row_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: for each check whether it holds on every row, and the number of rows; one pass for all. True for no rows."""
    return df.agg(F.count("*").alias("rows"), *[F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(True)).alias(n) for n, ok in checks.items()])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys borne by more than one row; null parts are equal to each other."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct keys of ``child`` without a row in ``parent``; null keys are orphans."""
    have = parent.select(F.col(parent_key).alias(child_key)).where(F.col(child_key).isNotNull()).distinct()
    return child.select(child_key).distinct().join(have, child_key, "left_anti")


def has_any_value(df: DataFrame) -> bool:
    """Whether some row has some value that isn't empty."""
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"`{c}`").cast("string") != "", F.lit(False)) for c in df.columns])
    return not df.where(some).limit(1).isEmpty()
