"""Records to canonical entities: key, availability, roll-up, links, and attributes back on the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terralume.functions.scalars import half_even, key_text

ATTRIBUTES_FIRST = ["city", "neighbourhood", "address", "state", "zip_code", "lat", "lon", "property_type", "condominium_name", "amenities_json", "installations_json", "sale_price_brl", "rent_price_brl"]
ATTRIBUTES_MAX = ["area_m2", "total_area_m2", "bedrooms", "bathrooms", "parking_spots", "suites", "floor"]
ATTRIBUTES_ANY = ["furnished", "accepts_pets"]


def canonical_id(city: Column, neighbourhood: Column, address: Column, area: Column, bedrooms: Column, bathrooms: Column, source: Column, record_id: Column, url: Column) -> Column:
    """Place and shape as one key; the source's id, else its URL, where there is neither place nor shape."""
    place = [key_text(c) for c in (city, neighbourhood, address)]
    zero = F.lit(0).cast("bigint")
    shape = [half_even(area), F.coalesce(bedrooms.cast("bigint"), zero), F.coalesce(bathrooms.cast("bigint"), zero)]
    told = (F.concat(*place) != "") | (shape[0] > 0) | (shape[1] > 0) | (shape[2] > 0)
    own = F.coalesce(F.when(record_id.rlike(r"\S"), F.trim(record_id)), F.trim(url), F.lit(""))
    return F.when(told, F.concat_ws("|", *place, *[s.cast("string") for s in shape])).otherwise(F.concat_ws("|", F.coalesce(source, F.lit("")), own))


def in_context(business: Column, context: str) -> Column:
    return F.coalesce(F.lower(F.trim(business)).isin(context, "rent|sale"), F.lit(False))


def positive(price: Column) -> Column:
    return F.coalesce(price, F.lit(0)) > 0


def with_availability(df: DataFrame, entity: str, source: str, record_id: str, business: str, sale_price: str, rent_price: str) -> DataFrame:
    """``is_for_sale``, ``is_for_rent``: evidence of the entity's rows, of the rows of one (source, id), or an own price.

    Two windows instead of two aggregates joined back; null sources and blank ids are no evidence for each other. A window's
    frame is its whole partition, so a hot entity is summed by one pass over its rows, spilled if need be.
    """
    known = F.col(source).isNotNull() & F.coalesce(F.col(record_id).rlike(r"\S"), F.lit(False))
    # rows that can't be evidence get partitions of their own kind instead of one hot null partition
    by_id = Window.partitionBy(source, F.when(known, F.col(record_id)), F.when(~known, F.xxhash64(entity)))
    by_entity = Window.partitionBy(entity)
    out = df
    for context, price in (("sale", sale_price), ("rent", rent_price)):
        own = in_context(F.col(business), context)
        sibling = F.when(known, F.max(own.cast("int")).over(by_id) == 1).otherwise(False)
        out = out.withColumn(f"_e_{context}", F.max(own.cast("int")).over(by_entity) == 1).withColumn(f"_s_{context}", sibling)
    return out.withColumns({f"is_for_{c}": F.col(f"_e_{c}") | F.col(f"_s_{c}") | positive(F.col(p)) for c, p in (("sale", sale_price), ("rent", rent_price))}).drop("_e_sale", "_e_rent", "_s_sale", "_s_rent")


def listing_mode(sale: Column, rent: Column) -> Column:
    return F.when(sale & rent, "sale_rent").when(sale, "sale").otherwise("rent")


def first_known(value: str, order: Column) -> Column:
    """The value of the first row in descending ``order`` that has one."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), order))


def rollup(df: DataFrame, entity: str, order: Column, seen_at: str, counted: str, first: list[str] | None = None, largest: list[str] | None = None, any_true: list[str] | None = None) -> DataFrame:
    """One row for each entity; partial aggregates before the shuffle, so a hot entity costs one row from each task.

    ``order`` must be total (ties make the pick arbitrary). Nulls are passed over in every column.
    """
    aggs = [first_known(c, order).alias(c) for c in (ATTRIBUTES_FIRST if first is None else first)]
    aggs += [F.max(c).alias(c) for c in (ATTRIBUTES_MAX if largest is None else largest)]
    aggs += [F.max(c).alias(c) for c in (ATTRIBUTES_ANY if any_true is None else any_true)]
    aggs += [F.min(seen_at).alias("first_seen_at"), F.max(seen_at).alias("last_seen_at"), F.count(counted).alias("listings_count")]
    aggs += [F.bool_or("is_for_sale").alias("is_for_sale"), F.bool_or("is_for_rent").alias("is_for_rent")]
    out = df.groupBy(entity).agg(*aggs)
    return out.withColumn("listing_mode", listing_mode(F.col("is_for_sale"), F.col("is_for_rent")))


def attach(df: DataFrame, links: DataFrame, key: list[str], entity: str) -> DataFrame:
    """The entity of each row by ``key``, null equal to null; one entity for each key (the smallest)."""
    one = links.groupBy(*key).agg(F.min(entity).alias(entity))
    right = one.select(*[F.col(k).alias(f"_r_{k}") for k in key], entity)
    on = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    return df.join(right, on, "left").drop(*[f"_r_{k}" for k in key])


def propagate(df: DataFrame, entities: DataFrame, entity: str, replaced: list[str], keep: bool = True) -> DataFrame:
    """Attributes of the entity in place of the row's own; with ``keep`` the row's stay as ``listing_<name>``."""
    own = df.select(*[F.col(c).alias(f"listing_{c}") if c in replaced and keep else F.col(c) for c in df.columns if keep or c not in replaced])
    return own.join(entities.select(entity, *replaced).dropDuplicates([entity]), entity, "left")


def group_types(df: DataFrame, key: str, business: str, ordinal: str, carried: list[str]) -> DataFrame:
    """One row for each key: the first row's columns and all business types put together."""
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*carried), ordinal).alias("r"), F.sort_array(F.collect_set(business)).alias("types"))
    return grouped.select(key, *[F.col(f"r.{c}").alias(c) for c in carried], business_of(F.col("types")).alias("business_type"))


def business_of(types: Column) -> Column:
    sale, rent = (F.array_contains(types, t) | F.array_contains(types, "rent|sale") for t in ("sale", "rent"))
    return F.when(sale & rent, "rent|sale").when(rent, "rent").when(sale, "sale")
