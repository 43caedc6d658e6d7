"""Captured pages to raw listing records: what to read is a table of paths, how to read it one interpreter."""

from __future__ import annotations

import html as html_module
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.functions.scalars import absolute_url, digits_int

Json = object


# -- JSON inside pages -------------------------------------------------------------
def script_json(page: str, script_id: str) -> Json:
    """The JSON of the script element with this id; None if there is none or it can't be read."""
    m = re.search(rf"<script\b[^>]*\bid=[\"']{re.escape(script_id)}[\"'][^>]*>(.*?)</script>", page or "", re.S | re.I)
    return _loads(m[1]) if m else None


def _loads(text: str) -> Json:
    try:
        return json.loads(text)
    except ValueError:
        return None


def assigned_json(page: str, names: tuple[str, ...]) -> Iterator[Json]:
    """JSON values that scripts assign or push to ``names``: the decoder itself finds where a value ends."""
    decoder = json.JSONDecoder()
    pattern = rf"(?:window\.)?(?:{'|'.join(map(re.escape, names))})\s*(?:=\s*|\.push\s*\(\s*)(?=[\[{{])"
    for m in re.finditer(pattern, page or ""):
        try:
            yield decoder.raw_decode(page, m.end())[0]
        except ValueError:
            continue


def attribute_json(page: str, element_id: str, attribute: str) -> Json:
    m = re.search(rf"<[^>]*\bid=[\"']{re.escape(element_id)}[\"'][^>]*\b{re.escape(attribute)}=(\"[^\"]*\"|'[^']*')", page or "")
    return _loads(html_module.unescape(m[1][1:-1])) if m else None


def json_ld(page: str) -> Iterator[Json]:
    for m in re.finditer(r"<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>", page or "", re.S | re.I):
        block = _loads(m[1])
        yield from block if isinstance(block, list) else [block]


def meta_content(page: str, *names: str) -> str | None:
    for tag in re.findall(r"<meta\b[^>]*>", page or "", re.I):
        given = dict((k.lower(), v1 or v2) for k, v1, v2 in re.findall(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", tag))
        if (given.get("name") or given.get("property") or "").lower() in names and (text := clean_text(given.get("content"))):
            return text
    return None


def clean_text(value: Json) -> str | None:
    """Entities decoded, tags and repeated white space gone; None if nothing is left or it is no text."""
    if not isinstance(value, str):
        return None
    bare = re.sub(r"<[^>]*>", " ", html_module.unescape(value))
    return re.sub(r"\s+", " ", bare).strip() or None


def described(page: str) -> str | None:
    """A description from JSON-LD, else from a meta element."""
    for block in json_ld(page):
        if isinstance(block, dict) and (text := clean_text(block.get("description"))):
            return text
    return meta_content(page, "description", "og:description", "twitter:description")


def walk(value: Json) -> Iterator[dict]:
    """All objects in a value, outer ones first."""
    stack = [value]
    while stack:
        top = stack.pop()
        if isinstance(top, dict):
            yield top
            stack.extend(reversed(list(top.values())))
        elif isinstance(top, list):
            stack.extend(reversed(top))


@lru_cache(4096)
def _steps(path: str) -> tuple[tuple[str, str | None, str | None], ...]:
    """Key, and what an element of the list there must bear, of each step of a path."""
    found = [re.fullmatch(r"([\w-]*)(?:\[(\w+)=([^\]]+)\])?", step) for step in path.split(".")]
    return tuple((m[1], m[2], m[3].lower() if m[3] else None) for m in found)


def dig(value: Json, path: str) -> Json:
    """``a.b``, ``a[type=x].b``: the element of a list whose key has a value; None where the path ends early."""
    for key, field_name, wanted in _steps(path):
        if key:
            value = value.get(key) if isinstance(value, dict) else None
        if field_name:
            value = next((x for x in value if isinstance(x, dict) and str(x.get(field_name)).strip().lower() == wanted), None) if isinstance(value, list) else None
        if value is None:
            return None
    return value


# -- tables of fields ------------------------------------------------------------------
def _text(v: Json) -> str | None:
    return None if v is None or isinstance(v, (dict, list)) else str(v)


def _json(v: Json) -> str | None:
    return v if isinstance(v, str) else None if v is None else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def _zip(v: Json) -> str | None:
    m = re.search(r"\b(\d{5})-?(\d{3})\b", str(v)) if v is not None else None
    return f"{m[1]}-{m[2]}" if m else None


def _digits(v: Json) -> str | None:
    return re.sub(r"\D", "", str(v)) or None if v is not None else None


def _when(v: Json) -> str | None:
    s = _text(v)
    if s and s.isdigit() and int(s) > 0:
        return pd.Timestamp(int(s), unit="s", tz="UTC").isoformat()
    return s


@dataclass(frozen=True)
class PageKind:
    """How pages of a source are read: the payload, paths of each field in order of preference, defaults."""

    payload: Callable[[str], Json]
    fields: dict[str, list[str]]
    read: dict[str, Callable[[Json], str | None]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    #: Values of these are passed over although they are there.
    skip_zero: tuple[str, ...] = ()


def _card_payload(page: str) -> Json:
    best: dict | None = None
    for value in assigned_json(page, ("dataLayer", "__INITIAL_STATE__", "initialData", "__DATA__")):
        for item in value if isinstance(value, list) else [value]:
            if isinstance(item, dict) and (isinstance(item.get("page"), dict) or "adDetail" in item or "list_id" in item):
                best = best or item
    best = best or script_json(page, "__NEXT_DATA__")
    if not isinstance(best, dict):
        return None
    ad = attribute_json(page, "initial-data", "data-json")
    return {**best, "ad": dig(ad, "ad") if isinstance(ad, dict) else None, "described": described(page), "html": page}


def _nested_payload(page: str) -> Json:
    state = script_json(page, "ng-state")
    product = next((d["product"] for d in walk(state) if isinstance(d.get("product"), dict)), None)
    place = next((d["map"] for d in walk(state) if isinstance(d.get("map"), dict)), None)
    return {"p": product, "map": place} if product else None


def _house_payload(page: str) -> Json:
    house = dig(script_json(page, "__NEXT_DATA__"), "props.pageProps.initialState.house")
    return {"house": house, "i": dig(house, "houseInfo") or {}, "described": described(page)} if isinstance(house, dict) else None


#: Where each source's pages hold the fields of a record.
_CARD = {
    "property_id": ["page.detail.list_id", "detail.list_id", "list_id", "page.adDetail.listId", "page.adDetail.list_id", "adDetail.listId", "adDetail.list_id", "listId"], "ad_id": ["page.detail.ad_id", "detail.ad_id", "ad_id", "page.adDetail.adId", "page.adDetail.ad_id", "adDetail.adId", "adDetail.ad_id"],
    "zipcode": ["page.detail.zipcode", "page.detail.zipCode", "page.detail.postalCode", "detail.zipcode", "detail.zipCode", "detail.postalCode", "zipcode", "zipCode", "postalCode", "page.adDetail.zipcode", "page.adDetail.zipCode", "page.adDetail.postalCode", "adDetail.zipcode", "adDetail.zipCode", "adDetail.postalCode", "page.adDetail.street", "html"], "listing_created_at": ["page.detail.adDate", "detail.adDate", "adDate", "page.adDetail.origListTime"],
    "amenities_json": ["page.adProperties", "adProperties"], "property_type": ["page.adDetail.subCategory", "adDetail.subCategory", "subCategory", "subCategoryId"], "price": ["page.detail.price", "detail.price", "price"],
    "description": ["ad.body", "ad.description", "described", "page.adDetail.body", "page.adDetail.description", "page.detail.body", "page.detail.description", "detail.body", "detail.description", "body", "description"], "street": ["page.adDetail.street", "adDetail.street"], "city": ["page.adDetail.municipality", "adDetail.municipality", "municipality"],
    "state": ["page.adDetail.state", "page.state", "state"], "neighbourhood": ["page.adDetail.neighbourhood", "neighbourhood"], "lat": ["page.adDetail.listLat", "page.adDetail.lat", "adDetail.listLat", "adDetail.lat"], "lon": ["page.adDetail.listLon", "page.adDetail.lon", "adDetail.listLon", "adDetail.lon"],
} | {f: [f"{p}[name={n}].value" for p in ("page.adProperties", "adProperties") for n in names] for f, names in {
    "real_estate_type": ["real_estate_type"], "total_area_m2": ["size"], "bedrooms": ["rooms"], "bathrooms": ["bathrooms"], "parking": ["garage_spaces"], "suites": ["suites"], "floor": ["floor"], "condo_fee_brl": ["condominium", "condominio", "condo_fee", "condominium_fee"], "iptu_brl": ["iptu"],
}.items()}
_NESTED = {
    "description": ["p.description"], "address": ["p.address.formatted", "p.address.street", "p.address"], "street": ["p.address.street"], "city": ["p.address.city"], "neighbourhood": ["p.address.neighborhood"], "state": ["p.address.state"], "zipcode": [], "lat": ["map.lat"], "lon": ["map.lng"],
    "property_type": ["p.name"], "total_area_m2": ["p.attributes[type=total_area_attr].value", "p.attributes[type=area_attr].value"], "area": ["p.attributes[type=area_attr].value"], "suites": ["p.attributes[type=suite_attr].value"], "bedrooms": ["p.attributes[type=bedroom_attr].value"],
    "bathrooms": ["p.attributes[type=bathroom_attr].value"], "parking": ["p.attributes[type=parking_lots_attr].value"], "condominium_name": ["p.condominium.name"], "condominium_url": ["p.condominium.url"], "condominium_amenities_json": ["p.condominium.amenities"], "features_json": ["p.features"], "pois_json": ["p.pois"],
    "condo_fee_brl": ["p.prices.condominium"], "sale_price_brl": ["p.prices.sale"], "rent_price_brl": ["p.prices.rent"], "total_rent_price_brl": ["p.prices.fullMonthlyPrice"], "listing_url": ["p.seo.url"],
}
_HOUSE = {
    "display_id": ["i.displayId"], "zipcode": ["i.address.zipCode", "i.address.zipcode", "i.address.postalCode"], "street": ["i.address.address", "i.address.street", "i.address"], "neighbourhood": ["i.address.neighborhood", "i.address.neighbourhood"], "city": ["i.address.city"], "state": ["i.address.stateAcronym", "i.address.state"], "lat": ["i.address.lat"], "lon": ["i.address.lng", "i.address.lon"],
    "construction_year": ["i.constructionYear", "house.constructionYear"], "range_floor_min": ["i.rangeFloor.min"], "range_floor_max": ["i.rangeFloor.max"], "for_rent": ["i.forRent", "house.forRent"], "for_sale": ["i.forSale", "house.forSale"], "property_type": ["i.type"], "total_area_m2": ["i.area"], "bedrooms": ["i.bedrooms"], "bathrooms": ["i.bathrooms"],
    "parking_spots": ["i.parkingSpots", "i.parkingSpaces", "i.garageSpots", "i.garageSpaces", "i.parking"], "suites": ["i.suites"], "accepts_pets": ["i.acceptsPets"], "has_furniture": ["i.hasFurniture"], "furnished": ["i.hasFurniture"], "home_protection_brl": ["i.homeProtection"], "tenant_service_fee_brl": ["i.tenantServiceFee"],
    "rental_guarantee_min_brl": ["i.rentalGuarantee.minValue"], "rental_guarantee_max_brl": ["i.rentalGuarantee.maxValue"], "condo_type": ["i.condoType"], "condo_fee_brl": ["i.condoPrice"], "iptu_brl": ["i.iptu"], "sale_price_brl": ["i.salePrice"], "rent_price_brl": ["i.rentPrice"],
    "amenities_json": ["i.amenities"], "comfort_commodities_json": ["i.comfortCommodities"], "practicality_commodities_json": ["i.practicalityCommodities"], "installations_json": ["i.installations"], "pois_json": ["i.placesNearby"],
    "long_description": ["i.generatedDescription.longDescription", "i.remarks", "described"], "short_rent_description": ["i.generatedDescription.shortRentDescription"], "short_sale_description": ["i.generatedDescription.shortSaleDescription"],
    "description": ["i.generatedDescription.longDescription", "i.remarks", "described", "i.generatedDescription.shortRentDescription", "i.generatedDescription.shortSaleDescription"],
} | {f"{c.lower()}_{out}": [f"i.listings[businessContext={c}].{name}"] for c in ("RENT", "SALE") for out, name in (("listing_created_at", "firstPublicationDate"), ("last_publication_date", "lastPublicationDate"), ("listing_status", "status"))}
KINDS = {
    "olx": PageKind(_card_payload, _CARD, {"zipcode": _zip, "listing_created_at": _when, "amenities_json": _json, "description": clean_text}),
    "lopes": PageKind(_nested_payload, _NESTED, {f: _digits for f in ("total_area_m2", "area", "suites", "bedrooms", "bathrooms", "parking")} | {f: _json for f in ("condominium_amenities_json", "features_json", "pois_json")}, {"suites": "0", "parking": "0"}),
    "quinto": PageKind(_house_payload, _HOUSE, {f: _json for f in _HOUSE if f.endswith("_json")} | {"zipcode": _zip} | {f: clean_text for f in _HOUSE if "description" in f}, {"parking_spots": "0"}, skip_zero=("parking_spots",)),
}


def parse_page(source: str, page: str | None, url: str | None = None, business_type: str | None = None) -> dict[str, str | None]:
    """One page's record; empty if its payload isn't there or can't be read."""
    kind = KINDS[source]
    payload = kind.payload(page) if page else None
    if not payload:
        return {}
    record: dict[str, str | None] = {}
    for name, paths in kind.fields.items():
        read = kind.read.get(name, _text)
        found = (v for v in (read(dig(payload, p)) for p in paths) if v not in (None, "") and not (name in kind.skip_zero and v == "0"))
        record[name] = next(found, kind.defaults.get(name))
    record["listing_url"] = record.get("listing_url") or url
    if (address := record["listing_url"]) and address.startswith("/"):
        record["listing_url"] = f"https://www.lopes.com.br{address}"
    return record | resolve_business(source, record, business_type)


def resolve_business(source: str, record: dict, given: str | None) -> dict[str, str | None]:
    """Business type and id as far as flags, URL and what the caller knows tell them."""
    url = record.get("listing_url") or ""
    of_url = "rent" if re.search(r"/aluguel/|/alugar|/aluga-", url) else "sale" if re.search(r"/venda/|/comprar|/venda-", url) else None
    flags = {t for t, f in (("rent", "for_rent"), ("sale", "for_sale")) if record.get(f) == "True"}
    if source == "quinto":
        business = "rent|sale" if len(flags) == 2 else next(iter(flags), None) or given or of_url
    else:
        business = of_url or given
    m = re.search(r"/imovel/([^/?#]+)", url) or re.search(r"-(\d{6,})(?:[?#].*)?$", url)
    return {"business_type": business, "property_id": record.get("property_id") or (m[1] if m else None)}


def parse_pages(df: DataFrame, source: str, html: str, url: str, business_type: str | None = None, key: str | None = None) -> DataFrame:
    """A record for each page of ``df`` whose payload can be read, all columns text; ``key`` is carried through."""
    names = sorted({*KINDS[source].fields, "listing_url", "business_type", "property_id"})
    narrow = df.select(F.col(key or url).cast("string").alias("key"), F.col(html).alias("html"), F.col(url).alias("url"), (F.col(business_type) if business_type else F.lit(None)).cast("string").alias("bt"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [{"key": k, **r} for k, page, u, b in frame.itertuples(index=False) if (r := parse_page(source, page, u, b))]
            yield pd.DataFrame(out, columns=["key", *names], dtype=object)

    return narrow.mapInPandas(run, ", ".join(f"`{c}` string" for c in ["key", *names]))


# -- pages of cards --------------------------------------------------------------------------
#: How classes of the list of cards and of a card's three parts begin.
_LIST, _TOP, _MIDDLE, _BOTTOM, _DATE = "AdListing_adListContainer", "olx-adcard__topbody", "olx-adcard__mediumbody", "olx-adcard__bottombody", "adcard__date"
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class _Node:
    """An element with its texts and elements in order."""

    __slots__ = ("tag", "given", "parent", "inside")

    def __init__(self, tag: str, given: dict, parent: _Node | None):
        self.tag, self.given, self.parent, self.inside = tag, given, parent, []

    def classed(self, part: str) -> bool:
        return part in (self.given.get("class") or "")

    def elements(self) -> Iterator[_Node]:
        """This element and all in it, in order of the page."""
        stack = [self]
        while stack:
            top = stack.pop()
            yield top
            stack.extend(reversed([x for x in top.inside if isinstance(x, _Node)]))

    def texts(self) -> Iterator[str]:
        stack: list[_Node | str] = [self]
        while stack:
            top = stack.pop()
            if isinstance(top, _Node):
                stack.extend(reversed(top.inside))
            elif top.strip():
                yield top.strip()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = _Node(tag, dict(attrs), self.at)
        self.at.inside.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        open_ = self.at
        while open_ is not None and open_.tag != tag:
            open_ = open_.parent
        if open_ is not None and open_.parent is not None:
            self.at = open_.parent

    def handle_data(self, data: str) -> None:
        self.at.inside.append(data)


def _card_of(top: _Node, within: _Node) -> _Node:
    """The smallest element around a top part that holds a middle and a bottom part; else the largest below the list that holds one of them."""
    best, at = top, top
    while at.parent is not None and at.parent is not within:
        at = at.parent
        parts = [any(x.classed(part) for x in at.elements()) for part in (_MIDDLE, _BOTTOM)]
        if all(parts):
            return at
        if any(parts):
            best = at
    return best


def parse_cards(page: str | None) -> list[dict[str, str | None]]:
    """``listing_url, price_text, raw_card_date_text, title`` of each card in the first list of a page, first card of a URL.

    A card has a top part with the link and title, a middle part with the price, a bottom part with the date; what a card doesn't have
    is null. Cards without a link to a listing are passed over, and so are pages without a list.
    """
    tree = _Tree()
    tree.feed(page or "")
    within = next((x for x in tree.root.elements() if x.classed(_LIST)), None)
    out: dict[str, dict] = {}
    for top in [] if within is None else [x for x in within.elements() if x.classed(_TOP) and x.given.get("data-mode") == "horizontal"]:
        link = next((x for x in top.elements() if x.tag == "a" and "/imoveis/" in (x.given.get("href") or "")), None)
        if link is None or not re.search(r"/imoveis/.+-\d{6,}", link.given["href"]) or link.given["href"] in out:
            continue
        card = _card_of(top, within)
        part = lambda name, card=card: [t for x in card.elements() if x.classed(name) for t in x.texts()]
        price = next((m[0] for t in part(_MIDDLE) if (m := re.search(r"(?i)R\$\s*[\d.,]+", t))), None)
        dates = [t for x in card.elements() if x.classed(_BOTTOM) for y in x.elements() if y.classed(_DATE) for t in y.texts()]
        out[link.given["href"]] = {"listing_url": link.given["href"], "price_text": price, "raw_card_date_text": next(iter(dates), None), "title": next(link.texts(), None) or next(top.texts(), None)}
    return list(out.values())


def parse_card_pages(df: DataFrame, html: str, keys: list[str], base: str = "https://www.olx.com.br") -> DataFrame:
    """The cards of each page with ``keys`` of the page, ``position`` on it, absolute ``listing_url``, ``price_brl`` and texts."""
    kinds = dict(df.dtypes)
    narrow = df.select(*keys, F.col(html).alias("_html"))
    fields = ["listing_url", "price_text", "raw_card_date_text", "title"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(i, n, card) for i, page in enumerate(frame["_html"]) for n, card in enumerate(parse_cards(page))]
            out = frame[keys].iloc[[i for i, _, _ in found]].reset_index(drop=True)
            out["position"] = [n for _, n, _ in found]
            for f in fields:
                out[f] = pd.Series([card[f] for _, _, card in found], dtype=object)
            yield out

    cards = narrow.mapInPandas(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "position bigint", *(f"{f} string" for f in fields)]))
    return cards.withColumns({"listing_url": absolute_url(base, F.col("listing_url")), "price_brl": digits_int(F.col("price_text"))}).drop("price_text")


def picture_urls(pictures: Json, base: str = "https://www.olx.com.br") -> list[str]:
    """Addresses of pictures: of each object the first of its kinds that is there, of a text itself."""
    order = ("original", "large", "medium", "link", "url", "src")
    found = [next((p[k] for k in order if p.get(k)), None) if isinstance(p, dict) else p for p in pictures] if isinstance(pictures, list) else []
    return [urljoin(base, p) for p in found if isinstance(p, str) and p]


def parse_address_page(page: str | None, zip_code: str) -> dict[str, str] | None:
    """``street · neighbourhood · city/UF`` of a page about a zip code: the first, if the code is on the page or there is no other."""
    found = [p for p in (re.split(r"\s*·\s*", t) for t in re.findall(r"[^<>]+·[^<>]+/[A-Z]{2}", page or "")) if len(p) == 3]
    digits = re.sub(r"\D", "", zip_code)
    if not found or not (digits in re.sub(r"(?<=\d)-(?=\d)", "", page) or len(found) == 1):
        return None
    city, state = found[0][2].rsplit("/", 1)
    return {"street": found[0][0].strip(), "neighbourhood": found[0][1], "city": city, "state": state.strip()}
