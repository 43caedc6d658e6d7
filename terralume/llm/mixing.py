"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terralume.functions.lineage import cut
from terralume.functions.usable import source_name

#: Slices of a source's seeded order; a fractional repetition is whole slices and a part of one.
SLICES = 4096


def water_fill(sizes: dict[str, float], weights: dict[str, float], caps: dict[str, float], total: float | None = None) -> dict[str, float]:
    """How much each source gives, in the unit of ``sizes``.

    Each source wants ``total`` in proportion to its weight. One that would have to be repeated more than
    ``caps`` times is clamped there, and what it can't give goes to the others in proportion to their
    weights, until none is over. ``total`` is by default what the sources hold, each once; it is lowered
    to what the caps allow. Sources without size, weight or cap give nothing.
    """
    limit = {s: max(0.0, sizes.get(s) or 0) * max(0, caps.get(s) or 0) for s in weights}
    free = {s: w for s, w in weights.items() if w and w > 0 and limit[s] > 0}
    given = dict.fromkeys(weights, 0.0)
    left = min(sum(sizes.get(s) or 0 for s in free) if total is None else total, sum(limit[s] for s in free))
    while free and left > 0:
        level = left / sum(free.values())
        over = [s for s, w in free.items() if level * w >= limit[s]]
        for s in over or list(free):
            given[s] = limit[s] if over else level * free[s]
            left -= given[s]
            del free[s]
    return given


def mix(docs: DataFrame, targets: DataFrame, id_col: str, source_col: str, size_col: str, total: float | None = None, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """``(plan, shares)``: how often each document is used, and what each source comes to.

    ``targets`` has ``source``, ``target_weight``, ``max_repeats``; names are compared without regard to
    case and outer blanks, and repeated names add up their weights and keep the largest ``max_repeats``.
    It is a table of settings and the only one that the driver reads, beside one total for each of its
    rows. Documents of other or missing sources, of no size or without id are not used. Documents with
    one id are one document: the largest is taken. A source's last, fractional repetition takes its
    documents in an order seeded by ``seed`` until the share is reached, at most one document beyond it.
    Empty tables give an empty plan.
    """
    name = source_name(F.col(source_col))
    kept = docs.select(F.col(id_col).alias("id"), name.alias("source"), F.col(size_col).cast("bigint").alias("size")).where("id is not null and source is not null and size > 0")
    one = kept.groupBy("id").agg(F.max(F.struct("size", "source")).alias("top")).select("id", "top.source", "top.size")
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.col("target_weight").cast("double").alias("w"), F.col("max_repeats").cast("bigint").alias("m")).where("source is not null").groupBy("source").agg(F.sum("w").alias("w"), F.max("m").alias("m"))
    used = cut(one.join(wanted.select("source"), "source", "left_semi").withColumn("order", F.xxhash64(F.lit(seed), F.col("id").cast("string"))).withColumn("slice", F.pmod(F.shiftrightunsigned("order", 20), F.lit(SLICES))))
    slices = used.groupBy("source", "slice").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    sizes = {r["source"]: r["size"] for r in slices.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    rows = wanted.collect()
    weights, caps = {r["source"]: r["w"] or 0.0 for r in rows}, {r["source"]: r["m"] or 0 for r in rows}
    given = water_fill(sizes, weights, caps, total)
    spark = docs.sparkSession
    whole = {s: min(int(caps[s]), int(given[s] // sizes[s])) if sizes.get(s) else 0 for s in weights}
    part = {s: round(given[s] - whole[s] * sizes.get(s, 0)) if whole[s] < caps[s] else 0 for s in weights}
    every, of_all = sum(weights.values()) or 1.0, sum(given.values()) or 1.0
    settings = spark.createDataFrame([(s, weights[s] / every, given[s] / of_all, int(caps[s]), int(sizes.get(s, 0)), whole[s], max(0, part[s])) for s in sorted(weights)], "source string, target_share double, feasible_share double, max_repeats bigint, available_size bigint, whole bigint, part bigint")
    along = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cumulated = slices.withColumn("before", F.coalesce(F.sum("size").over(along), F.lit(0))).select("source", "slice", "before", F.col("size").alias("slice_size"))
    placed = used.join(F.broadcast(settings.select("source", "whole", "part")), "source").join(cumulated, ["source", "slice"])
    inside = Window.partitionBy("source", "slice").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, -1)
    cuts_here = (F.col("before") < F.col("part")) & (F.col("before") + F.col("slice_size") > F.col("part"))
    clear = placed.where(~cuts_here).withColumn("extra", (F.col("before") + F.col("slice_size") <= F.col("part")).cast("bigint"))
    split = placed.where(cuts_here).withColumn("extra", (F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) < F.col("part")).cast("bigint"))
    plan = clear.unionByName(split).withColumn("repeats", F.col("whole") + F.col("extra")).where("repeats > 0").select(F.col("id").alias(id_col), "source", F.col("size").alias("n_tokens"), "repeats")
    got = plan.groupBy("source").agg(F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("mixed_size"))
    shares = settings.join(got, "source", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("documents", "most_repeats", "mixed_size")})
    whole_mix = Window.partitionBy(F.lit(1))  # one row for each target
    actual = F.col("mixed_size") / F.nullif(F.sum("mixed_size").over(whole_mix), F.lit(0))
    shares = shares.withColumn("actual_share", F.round(F.coalesce(actual, F.lit(0.0)), 6)).withColumns({c: F.round(F.col(c), 6) for c in ("target_share", "feasible_share")})
    return plan, shares.select("source", "target_share", "feasible_share", "actual_share", "available_size", "max_repeats", "most_repeats", "documents", "mixed_size")

