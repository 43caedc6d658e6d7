"""Best representative of each duplicate group: field-by-field survivorship in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def survive(df: DataFrame, key: str, row_id: str, fields: Mapping[str, Column], order: list[Column], values: bool = True, least_rows: int = 2) -> DataFrame:
    """One row for each ``key``: of each field the value that survives and the row it comes from.

    ``fields`` says by field when a value is usable. Among the usable ones the largest composite
    (``order``, then the number of usable fields of the row, then the smaller ``row_id``) wins; nulls in
    ``order`` come last. All fields are settled in one aggregation with a partial one before the
    shuffle, so a group of any size is one row from each task.

    Groups under ``least_rows`` rows and rows with a null key give nothing. A field without any usable
    value is null, and so is its row. Repeated rows change nothing; ties end at ``row_id``. Other
    columns are not read. Output: ``key``, ``n_rows``, ``<field>`` (if ``values``), ``<field>__row``.
    """
    names = list(fields)
    # one array of flags: an alias for each flag or value would make the optimiser derive a constraint for each subset of them
    flags = F.array(*[F.coalesce(ok, F.lit(False)) for ok in fields.values()])
    raw = df.where(F.col(key).isNotNull()).select(key, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("_order"), F.col(row_id).cast("bigint").alias("_row"), flags.alias("_flags"), *[f for f in names if values])
    rank = F.struct("_order", F.size(F.filter("_flags", lambda ok: ok)).alias("many"), F.negative("_row").alias("near"))
    best = [F.max(F.when(F.get("_flags", F.lit(i)), F.struct(rank.alias("rank"), F.col(f).alias("v")) if values else rank)).alias(f"b{i}") for i, f in enumerate(names)]
    grouped = raw.groupBy(key).agg(F.count("*").alias("n_rows"), *best).where(F.col("n_rows") >= least_rows)
    out = []
    for i, f in enumerate(names):
        if values:
            out.append(F.col(f"b{i}.v").alias(f))
        out.append((-F.col(f"b{i}.rank.near" if values else f"b{i}.near")).alias(f"{f}__row"))
    return grouped.select(key, "n_rows", *out)


def survivors_by_field(best: DataFrame, key: str, fields: list[str], row_id: str) -> DataFrame:
    """The same, one row for each key and field that has a survivor: ``key, field_name, row_id``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}__row").alias("row")) for f in fields])
    return best.select(key, F.explode(pairs).alias("p")).select(key, "p.field_name", F.col("p.row").alias(row_id)).where(F.col(row_id).isNotNull())
