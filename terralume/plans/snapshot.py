"""Canonical listings to snapshot tables, and the history store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terralume.functions.lineage import cut
from terralume.operators import incremental, latest, resolve

LISTING_KEY = ["source", "business_type", "property_id", "listing_url"]
UPSERT_KEY = ["source", "business_type", "property_id"]
LINK_COLUMNS = ["canonical_property_id", "source", "property_id", "business_type", "listing_url", "scraped_at"]
PROPAGATED = ["sale_price_brl", "rent_price_brl", "is_for_sale", "is_for_rent", "listing_mode"]


def with_canonical_id(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumn("canonical_property_id", resolve.canonical_id(c("city"), c("neighbourhood"), c("address"), c("area_m2"), c("bedrooms"), c("bathrooms"), c("source"), c("property_id"), c("listing_url")))


def unified(listings: DataFrame, ordinal: str = "_ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(listings with entity and flags, properties, links) of canonical listings.

    Duplicates are left out once, the entity is computed once as a function of the row, and availability comes from
    windows, so nothing is joined back. The three outputs share one written intermediate.
    """
    one = latest.latest_per_key(listings, LISTING_KEY, "scraped_at", ordinal)
    flagged = cut(resolve.with_availability(with_canonical_id(one), "canonical_property_id", "source", "property_id", "business_type", "sale_price_brl", "rent_price_brl"))
    properties = resolve.rollup(flagged, "canonical_property_id", F.struct("scraped_at", ordinal), "scraped_at", "property_id")
    return flagged, properties, flagged.select(*LINK_COLUMNS)


def snapshot(listings: DataFrame, ordinal: str = "_ord", keep_ordinal: bool = False) -> dict[str, DataFrame]:
    """The three tables of a day. Prices, flags and mode of the entity replace the row's own, which stay as ``listing_*``."""
    flagged, properties, links = unified(listings, ordinal)
    rows = resolve.propagate(flagged, properties.select("canonical_property_id", *PROPAGATED), "canonical_property_id", PROPAGATED)
    return {"listings": rows if keep_ordinal else rows.drop(ordinal), "properties": properties, "links": links}


def update_history(existing: DataFrame, incoming: DataFrame, run_at: Column, ordinal: str = "_ord") -> tuple[dict[str, DataFrame], DataFrame]:
    """(the store's tables after the run, one row of counters)."""
    merged = cut(incremental.upsert(existing, incoming, UPSERT_KEY, "scraped_at", ordinal, run_at))
    counts = incremental.upsert_counts(existing, incoming, UPSERT_KEY)
    flagged, properties, links = unified(merged, ordinal)
    return {"listings": flagged, "properties": properties, "links": links}, counts
