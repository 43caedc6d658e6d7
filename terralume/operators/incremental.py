"""Changes against earlier snapshots: delta with watermark, upsert with history, pending work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terralume.operators.latest import first_per_key, top_per_key


def _same(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, [p.eqNullSafe(q) for p, q in zip(a, b, strict=True)])


def last_state(df: DataFrame, key: list[str], value: str, ordinal: str) -> DataFrame:
    """The last value of each key by position."""
    return df.groupBy(*key).agg(F.max_by(value, ordinal).alias("previous"))


def classify_delta(current: DataFrame, previous: DataFrame, key: list[str], value: str, date: Column, watermark: DataFrame, ordinal: str, late_days: int = 1) -> DataFrame:
    """``change`` of each row: filtered (older than the watermark less ``late_days``), new, updated or unchanged.

    Rows are first reduced to one for each (key, value). The late test comes before the others; rows without a date
    pass it. ``previous`` has ``key`` and ``previous``; ``watermark`` one row, ``watermark`` (null: none). Only this
    one row is sent to all tasks.
    """
    one = first_per_key(current, [*key, value], ordinal)
    renamed = previous.select(*[F.col(k).alias(f"_p_{k}") for k in key], "previous", F.lit(True).alias("_known"))
    joined = one.join(renamed, _same([F.col(k) for k in key], [F.col(f"_p_{k}") for k in key]), "left").crossJoin(F.broadcast(watermark))
    late = F.coalesce(date < F.date_sub("watermark", late_days), F.lit(False))
    change = F.when(late, "filtered").when(F.col("_known").isNull(), "new").when(~F.col("previous").eqNullSafe(F.col(value)), "updated").otherwise("unchanged")
    return joined.withColumn("change", change).drop(*[f"_p_{k}" for k in key], "_known", "watermark")


def delta(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("change").isin("new", "updated"))


def delta_order(value: str, url: str) -> list[Column]:
    return [F.coalesce(F.col(value).cast("string"), F.lit("")).desc(), F.col(url).asc()]


def change_counts(classified: DataFrame) -> DataFrame:
    """One row of counters."""
    return classified.agg(*[F.count_if(F.col("change") == c).alias(f"rows_{c}") for c in ("new", "updated", "unchanged", "filtered")])


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], at: str, ordinal: str, run_at: Column) -> DataFrame:
    """The newest row of each key over both, with the history columns.

    ``first_seen_at`` and ``created_at`` of a known key stay, the others are set to ``run_at``. The newest ``at`` wins, even over
    a later run; ties go to the incoming row, then to the larger ``ordinal``. Missing columns are null on either side.
    In keys null equals empty.
    """
    blank = [F.coalesce(F.col(k), F.lit("")) for k in key]
    history = ["first_seen_at", "last_seen_at", "created_at", "updated_at"]
    for c in history:
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(None).cast("timestamp"))
    fresh = incoming.drop(*history).withColumn("_run", F.lit(1))
    both = existing.withColumn("_run", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    known = [F.min(c).over(_whole(blank)).alias(c) for c in ("first_seen_at", "created_at")]
    dated = both.select(*[c for c in both.columns if c not in ("first_seen_at", "created_at")], *known)
    filled = dated.withColumns({"first_seen_at": F.coalesce("first_seen_at", run_at), "created_at": F.coalesce("created_at", run_at), "last_seen_at": F.when(F.col("_run") == 1, run_at).otherwise(F.col("last_seen_at")), "updated_at": F.when(F.col("_run") == 1, run_at).otherwise(F.col("updated_at"))})
    return top_per_key(filled, blank, [F.col(at).desc_nulls_last(), F.col("_run").desc(), F.col(ordinal).desc()]).drop("_run")


def _whole(parts: list[Column]) -> Window:
    return Window.partitionBy(*parts)


def upsert_counts(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """How many distinct keys are inserted and updated: one aggregate over both sides, no join."""
    side = lambda df, n: df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in key], F.lit(n).alias("side"))
    seen = side(existing, 0).unionByName(side(incoming, 1)).groupBy(*key).agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return seen.agg(F.count_if(F.expr("hi = 1 and lo = 1")).alias("inserted"), F.count_if(F.expr("hi = 1 and lo = 0")).alias("updated"))


def pending(work: DataFrame, done: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """First row of each key that isn't done; null keys stay pending."""
    return first_per_key(work, key, ordinal).join(done.select(*key).dropDuplicates(), key, "left_anti")


def completed_keys(saved: DataFrame, processed: DataFrame, key: str, status: str, terminal: tuple[str, ...] = ("not_found", "skipped_no_url")) -> DataFrame:
    """Saved keys, and processed ones whose status is terminal or blank."""
    over = F.col(status).isNull() | (F.trim(status) == "") | F.col(status).isin(*terminal)
    return saved.select(key).union(processed.where(over).select(key)).where(F.col(key).isNotNull()).distinct()


def missing_ids(found: DataFrame, collected: DataFrame, record_id: str) -> DataFrame:
    """Rows whose id hasn't been collected; rows without id always pass."""
    has = F.coalesce(F.col(record_id).rlike(r"\S"), F.lit(False))
    return found.where(has).join(collected.select(record_id).dropDuplicates(), record_id, "left_anti").unionByName(found.where(~has).select(record_id, *[c for c in found.columns if c != record_id]))


def recover(current: DataFrame, recovered: DataFrame, record_id: str, url: str, ordinal: str) -> DataFrame:
    """Both together, first row of each id, else URL; current rows come first."""
    both = current.withColumn("_part", F.lit(0)).unionByName(recovered.withColumn("_part", F.lit(1)), allowMissingColumns=True)
    key = F.when(F.col(record_id).rlike(r"\S"), F.concat(F.lit("id:"), F.trim(record_id))).otherwise(F.concat(F.lit("url:"), F.coalesce(F.trim(url), F.lit(""))))
    return top_per_key(both, [key], [F.col("_part").asc(), F.col(ordinal).asc()]).drop("_part")


def resume_key(key: Column, record_id: Column, url: Column, record: Column) -> Column:
    """The explicit key, else ``id:``, else ``url:``, else the whole record."""
    given = lambda c: F.when(c.rlike(r"\S"), F.trim(c))
    return F.coalesce(given(key), F.concat(F.lit("id:"), given(record_id)), F.concat(F.lit("url:"), given(url)), F.concat(F.lit("record:"), record))


def page_overlap(cards: DataFrame, flow: str, page: str, posted: str, newest_previous: DataFrame) -> DataFrame:
    """For each page: cards at or before the newest one of the last run, newer ones, and whether it lies wholly in what is known.

    ``newest_previous`` has ``flow`` and ``newest``; flows without it have no overlap.
    """
    joined = cards.join(newest_previous, flow, "left").withColumn("_old", F.coalesce(F.col(posted) <= F.col("newest"), F.lit(False)))
    pages = joined.groupBy(flow, page).agg(F.count_if("_old").alias("overlap"), F.count_if(~F.col("_old")).alias("newer"))
    return pages.withColumn("fully_in_overlap", (F.col("overlap") > 0) & (F.col("newer") == 0))
