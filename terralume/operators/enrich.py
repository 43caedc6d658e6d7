"""Filling gaps from prioritised reference dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.functions.scalars import blank, merged_tags, zip_digits
from terralume.operators.latest import top_per_key

FIELDS = ["street", "neighbourhood", "city", "state", "lat", "lon"]


def merge_dimensions(base: DataFrame, secondary: DataFrame, key: str, fields: list[str] | None = None, tag: str = "source") -> DataFrame:
    """Both dimensions, field by field: the base's value, else the secondary's. Keys are unique on either side.

    ``tag`` names the sources a row is made of.
    """
    names = FIELDS if fields is None else fields
    kinds = dict(base.dtypes)
    left = base.select(key, *[F.col(f).alias(f"_b_{f}") for f in [*names, tag]])
    right = secondary.select(key, *[F.col(f).alias(f"_s_{f}") for f in [*names, tag]])
    fill = lambda f: F.coalesce(F.when(~blank(F.col(f"_b_{f}")), F.col(f"_b_{f}")), F.col(f"_s_{f}")) if kinds[f] == "string" else F.coalesce(f"_b_{f}", f"_s_{f}")
    return left.join(right, key, "full").select(key, *[fill(f).alias(f) for f in names], merged_tags(F.col(f"_b_{tag}"), F.col(f"_s_{tag}")).alias(tag))


def lookup_chain(wanted: DataFrame, cache: DataFrame, dimension: DataFrame, resolver: DataFrame, key: str) -> DataFrame:
    """One answer for each distinct key: the cache's if it is whole, filled up from the dimensions and pre-fetched answers.

    A cached failure of this chain stays a failure; entries without both coordinates are filled up further. Tables
    have ``key``, the six fields, ``source``; ``cache`` also ``failed``.
    """
    keys = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    cached = keys.join(top_per_key(cache, [key], [F.coalesce("failed", F.lit(False)).asc(), "source"]), key)
    negative = F.coalesce("failed", F.lit(False)) & F.coalesce(F.col("source") != "cepbrasil", F.lit(True))
    failed = cached.where(negative).select(key, *FIELDS, "source", F.lit(True).alias("failed"))
    open_keys = keys.join(failed.select(key), key, "left_anti")
    positive = open_keys.join(cached.where(~F.coalesce("failed", F.lit(False))).select(key, *FIELDS, "source"), key, "left")
    local = dimension.join(open_keys, key, "left_semi")
    answer = merge_dimensions(merge_dimensions(positive, local, key), resolver.join(open_keys, key, "left_semi"), key)
    nothing = F.coalesce(*[F.col(f).cast("string") for f in FIELDS]).isNull()
    return answer.withColumn("failed", nothing).unionByName(failed)


def fill_missing(df: DataFrame, zip_code: str, dimension: DataFrame, dim_key: str, columns: dict[str, str]) -> DataFrame:
    """Missing values of ``columns`` (column: field of the dimension) from the row of the same zip code; given values stay.

    Only rows with a readable zip code and a gap meet the dimension, and it is read only for their codes; null and unreadable
    codes never travel to one task. Spark sends the dimension to all tasks if its size allows, else both sides are shuffled.
    """
    kinds = dict(df.dtypes)
    gap = None
    for c in columns:
        lacking = blank(F.col(c)) if kinds[c] == "string" else F.col(c).isNull()
        gap = lacking if gap is None else gap | lacking
    keyed = df.withColumn("_zip", F.when(gap, zip_digits(F.col(zip_code))))
    dim = dimension.select(F.col(dim_key).alias("_zip"), *[F.col(f).alias(f"_d_{f}") for f in columns.values()])
    joined = keyed.where(F.col("_zip").isNotNull()).join(dim, "_zip", "left")
    rest = keyed.where(F.col("_zip").isNull()).withColumns({f"_d_{f}": F.lit(None).cast(dict(dimension.dtypes)[f]) for f in columns.values()})
    both = joined.unionByName(rest)
    given = lambda c: F.when(~blank(F.col(c)), F.col(c)) if kinds[c] == "string" else F.col(c)
    return both.select(*[F.coalesce(given(c), F.col(f"_d_{columns[c]}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def first_per_zip(df: DataFrame, zip_code: str, ordinal: str) -> DataFrame:
    """The first row of each readable code; ``zip_digits`` holds it."""
    coded = df.withColumn("zip_digits", zip_digits(F.col(zip_code))).where(F.col("zip_digits").isNotNull())
    return top_per_key(coded, ["zip_digits"], [F.col(ordinal).asc()])


def geocode_query(street: str, neighbourhood: str, city: str, state: str) -> F.Column:
    """The text to ask a geocoder for; null unless all four parts are there."""
    return F.when(_whole_place(street, neighbourhood, city, state), F.concat_ws(", ", *[F.trim(p) for p in (street, neighbourhood, city, state)]))


def _whole_place(*parts: str) -> F.Column:
    return reduce(lambda a, b: a & b, [~blank(F.col(p)) for p in parts])


def geocode_queries(street: str, neighbourhood: str, city: str, state: str, zip_code: str, country: str = "Brasil") -> F.Column:
    """The texts to ask a geocoder for, the most exact first; none unless all four parts are there."""
    place = [F.trim(p) for p in (street, neighbourhood, city, state)]
    coded = F.concat_ws(", ", *place, F.when(~blank(F.col(zip_code)), F.trim(zip_code)), F.lit(country))
    return F.when(_whole_place(street, neighbourhood, city, state), F.array_distinct(F.array(coded, F.concat_ws(", ", *place, F.lit(country))))).otherwise(F.array().cast("array<string>"))


#: Columns of a listing and the fields of an answer that fill them.
FILLED = {"address": "street", "city": "city", "state": "state", "lat": "lat", "lon": "lon"}


def candidates(df: DataFrame, zip_code: str = "zip_code", columns: dict[str, str] | None = None) -> F.Column:
    """Whether a row can gain from its zip code: it has a readable one, and a gap."""
    kinds = dict(df.dtypes)
    gaps = [blank(F.col(c)) if kinds[c] == "string" else F.col(c).isNull() for c in (columns or FILLED)]
    return zip_digits(F.col(zip_code)).isNotNull() & reduce(lambda a, b: a | b, gaps)


def enrich_listings(listings: DataFrame, cache: DataFrame, dimension: DataFrame, secondary: DataFrame, resolver: DataFrame, zip_code: str = "zip_code") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(filled listings, answers by zip code, one row of counters): gaps of listings filled from what is known of their zip codes.

    Zip codes of rows with a gap are looked up once each: in the ``cache``, then the ``dimension``, then the ``secondary`` one, then among
    pre-fetched answers (``resolver``: a table, as a geocoder or page would give it; an empty one for none). Given values stay.
    Answers are what the next run's cache holds; a code that nothing answers is a failure.
    """
    open_rows = listings.where(candidates(listings, zip_code)).select(zip_digits(F.col(zip_code)).alias("zip"), *[F.col(c).alias(f"_{c}") for c in FILLED])
    wanted = open_rows.select("zip").distinct()
    local = merge_dimensions(dimension, secondary, "zip")
    answers = lookup_chain(wanted, cache, local, resolver, "zip")
    filled = fill_missing(listings, zip_code, answers.where(~F.col("failed")), "zip", FILLED)
    return filled, answers, enrichment_counts(open_rows, answers, cache, dimension, secondary, resolver)


def enrichment_counts(open_rows: DataFrame, answers: DataFrame, cache: DataFrame, dimension: DataFrame, secondary: DataFrame, resolver: DataFrame) -> DataFrame:
    """One row: how the zip codes of rows with a gap were answered, and what was filled.

    Rows are put together by code first, so a code on a third of all rows is one row from each task.
    """
    gap = {c: blank(F.col(f"_{c}")) if k == "string" else F.col(f"_{c}").isNull() for c, k in ((c, dict(open_rows.dtypes)[f"_{c}"]) for c in FILLED)}
    by_zip = open_rows.groupBy("zip").agg(F.count("*").alias("n"), F.count_if(gap["address"]).alias("no_address"), F.count_if(gap["lat"] & ~gap["lon"]).alias("no_lat"), F.count_if(~gap["lat"] & gap["lon"]).alias("no_lon"), F.count_if(gap["lat"] & gap["lon"]).alias("no_point"))
    has = lambda df, name: df.select("zip").distinct().withColumn(name, F.lit(True))
    good = ~F.coalesce("failed", F.lit(False))
    negative = cache.where(~good & F.coalesce(F.col("source") != "cepbrasil", F.lit(True)))
    located = cache.where(good & (F.col("lat").isNotNull() | F.col("lon").isNotNull()))
    known = by_zip.join(answers.select("zip", "street", "neighbourhood", "city", "state", "lat", "lon", "failed"), "zip", "left")
    for df, name in ((located, "in_cache"), (negative, "in_failures"), (dimension, "in_base"), (secondary, "in_secondary"), (resolver, "in_resolver")):
        known = known.join(has(df, name), "zip", "left")
    flag = lambda name: F.coalesce(F.col(name), F.lit(False))
    found = ~F.coalesce("failed", F.lit(True))
    looked_up = ~flag("in_cache") & ~flag("in_failures")
    asked = looked_up & ~flag("in_base") & ~flag("in_secondary")
    point = F.col("lat").isNotNull() | F.col("lon").isNotNull()
    place = _whole_place("street", "neighbourhood", "city", "state")
    wants_point = looked_up & found & ~(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    total = lambda n, name: F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(name)
    filled = lambda c, n: F.when(found & F.col(c).isNotNull(), F.col(n)).otherwise(0)
    return known.agg(
        F.count_if(looked_up).alias("zip_codes_consulted"), total(F.when(looked_up, F.col("n") - 1).otherwise(F.col("n")), "zip_code_cache_hits"), total(F.when(found & ~blank(F.col("street")), F.col("no_address")).otherwise(0), "zip_code_address_filled_count"),
        total(filled("lat", "no_lat") + filled("lon", "no_lon") + F.when(found & point, F.col("no_point")).otherwise(0), "zip_code_coordinates_filled_count"), total(F.when(found, 0).otherwise(F.col("n")), "zip_code_resolution_failures"),
        F.count_if(looked_up & flag("in_base")).alias("zip_code_base_ceps_hits"), F.count_if(looked_up & flag("in_secondary")).alias("zip_code_cepaberto_hits"), F.count_if(asked).alias("zip_code_brazilguide_requests"), F.count_if(asked & flag("in_resolver")).alias("zip_code_brazilguide_successes"), F.count_if(asked & ~flag("in_resolver")).alias("zip_code_brazilguide_failures"),
        F.lit(0).cast("bigint").alias("zip_code_brazilguide_skipped_invalid_zip"), F.count_if(flag("in_failures") & ~flag("in_cache")).alias("zip_code_negative_cache_hits"), F.count_if(wants_point & ~place).alias("zip_code_geocode_skipped_incomplete_context"), F.count_if(looked_up & flag("in_resolver") & found & point).alias("zip_code_geocode_successes"), F.count_if(wants_point & place).alias("zip_code_geocode_failures"), F.lit(0).cast("bigint").alias("zip_code_geocode_rate_limited"),
    )


def cache_entries(answers: DataFrame) -> DataFrame:
    """``zip, entry``: answers as the JSON entries of a cache file; values that aren't there are left out."""
    return answers.select("zip", F.to_json(F.struct(*[F.col(c) for c in answers.columns if c != "zip"])).alias("entry"))
