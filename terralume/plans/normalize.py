"""Raw listing records of any source to the canonical listing frame: one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terralume.functions import jsonx
from terralume.functions import scalars as S

#: The canonical columns in their order, by type.
TEXT, DOUBLE, BIGINT, BOOLEAN = "string", "double", "bigint", "boolean"
CANONICAL = {
    "source": TEXT, "business_type": TEXT, "property_id": TEXT, "listing_url": TEXT, "display_id": TEXT, "description": TEXT, "long_description": TEXT, "address": TEXT, "neighbourhood": TEXT, "city": TEXT, "state": TEXT, "zip_code": TEXT, "lat": DOUBLE, "lon": DOUBLE, "property_type": TEXT,
    "area_m2": DOUBLE, "total_area_m2": DOUBLE, "bedrooms": BIGINT, "bathrooms": BIGINT, "parking_spots": BIGINT, "suites": BIGINT, "floor": BIGINT, "furnished": BOOLEAN, "accepts_pets": BOOLEAN, "has_furniture": BOOLEAN,
    "sale_price_brl": BIGINT, "rent_price_brl": BIGINT, "total_price_brl": BIGINT, "condo_fee_brl": BIGINT, "iptu_brl": BIGINT, "home_protection_brl": BIGINT, "tenant_service_fee_brl": BIGINT, "rental_guarantee_min_brl": BIGINT, "rental_guarantee_max_brl": BIGINT,
    "condo_type": TEXT, "listing_created_at": TEXT, "rent_listing_created_at": TEXT, "sale_listing_created_at": TEXT, "rent_last_publication_date": TEXT, "sale_last_publication_date": TEXT, "rent_listing_status": TEXT, "sale_listing_status": TEXT,
    "amenities_json": TEXT, "practicality_commodities_json": TEXT, "comfort_commodities_json": TEXT, "installations_json": TEXT, "condominium_name": TEXT, "condominium_url": TEXT, "condominium_amenities_json": TEXT, "features_json": TEXT, "pois_json": TEXT, "scraped_at": TEXT,
}
#: Other names of a field in records of some source, first come first served.
ALIASES = {
    "property_id": ["property_id", "listing_id", "ad_id"], "address": ["street", "address"], "zip_code": ["zipcode", "zip_code"], "area_m2": ["area", "area_m2"], "parking_spots": ["parking_spots", "parking"],
    "total_price_brl": ["total_rent_price_brl", "total_price_brl"], "description": ["description", "short_sale_description", "short_rent_description"], "lat": ["lat", "latitude"], "lon": ["lon", "longitude"],
}
#: Amenities that fill a field: names of the object, part of its label as a second way.
AMENITIES = {
    "condo_fee_brl": (["condominio"], None), "iptu_brl": (["iptu"], None), "area_m2": (["size", "area"], None), "bedrooms": (["rooms"], None), "bathrooms": (["bathrooms"], None), "parking_spots": (["garage_spaces"], None),
    "suites": (["suites"], "suíte"), "floor": (["floor"], "andar"), "property_type": (["real_estate_type"], None),
}
LONG_TEXT = ["description", "long_description"]


def normalize(raw: DataFrame, scraped_at: Column, strict: bool = False) -> DataFrame:
    """The canonical columns of each record, and ``_ord`` if the records have it.

    Columns that a source doesn't have are null, others are dropped. Empty text is missing. Numbers are read value by value:
    plain ones as they stand, others in the Brazilian way (``strict``: digits only for whole numbers, Brazilian for all texts).
    A malformed amenity list is empty.
    """
    have = set(raw.columns)
    get = lambda name: S.pick(*[F.col(a).cast("string") for a in ALIASES.get(name, [name]) if a in have], F.lit(None).cast("string"))
    inferred = [F.col(c) if c in have else F.lit(None).cast("string") for c in ("_source", "_business")]
    whole, real = (S.digits_int, S.br_float) if strict else (S.to_int, S.to_float)
    source = S.pick(get("source"), inferred[0])
    business = F.coalesce(get("business_type"), inferred[1], F.lit("sale"))
    items = jsonx.objects(get("amenities_json"))
    extra = {f: jsonx.value_of(items, names, label) for f, (names, label) in AMENITIES.items()}
    number = lambda f, read: F.coalesce(read(get(f)), read(extra[f])) if f in extra else read(get(f))
    area, total_area = real(get("area_m2")), real(get("total_area_m2"))
    area = F.coalesce(area, total_area, real(extra["area_m2"]))
    price = whole(get("price"))
    sale = F.coalesce(whole(get("sale_price_brl")), F.when(business == "sale", price))
    rent = F.coalesce(whole(get("rent_price_brl")), F.when(business == "rent", price))
    record_id = F.coalesce(get("property_id"), F.lit(""))
    url = get("listing_url")
    kind = F.coalesce(get("property_type"), extra["property_type"])
    furnished, pets = (jsonx.has_label(items, ["re_features", "re_complex_features"], w) for w in ("mobiliado", "aceita animais"))
    out: dict[str, Column] = {c: get(c) for c in CANONICAL}
    out |= {
        "source": source, "business_type": business, "property_id": record_id,
        "listing_url": F.coalesce(url, F.when((source == "lopes") & (record_id != ""), F.concat(F.lit("https://www.lopes.com.br/imovel/"), record_id))),
        "description": S.compose(get("title"), get("description")), "state": S.state_name(get("state"), get("city")), "property_type": F.when(source == "olx", S.property_type(kind)).otherwise(kind),
        "lat": S.plain_float(get("lat")), "lon": S.plain_float(get("lon")), "area_m2": area, "total_area_m2": F.coalesce(total_area, area),
        "sale_price_brl": sale, "rent_price_brl": rent, "total_price_brl": S.first_nonzero(whole(get("total_price_brl")), sale, rent),
        "furnished": F.coalesce(S.flag(get("furnished")), F.when(furnished, True)), "accepts_pets": F.coalesce(S.flag(get("accepts_pets")), F.when(pets, True)), "has_furniture": F.coalesce(S.flag(get("has_furniture")), F.when(furnished, True)),
        "scraped_at": F.coalesce(get("scraped_at"), scraped_at.cast("string")),
    }
    for c, kind_of in CANONICAL.items():
        if kind_of == BIGINT and c not in ("sale_price_brl", "rent_price_brl", "total_price_brl"):
            out[c] = number(c, whole)
    passed = [F.col("_ord")] if "_ord" in have else []
    return raw.select(*[out[c].cast(t).alias(c) for c, t in CANONICAL.items()], *passed)


def align(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Exactly the canonical columns: missing ones null, others dropped, values that don't fit the type null."""
    wanted = CANONICAL if columns is None else columns
    return df.select(*[F.col(c).try_cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])


def without_long_text(df: DataFrame) -> DataFrame:
    return df.drop(*LONG_TEXT)


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
