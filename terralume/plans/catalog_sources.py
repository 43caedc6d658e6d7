"""Scans, sinks, pages, parsers, card flows, enrichment and streams as queries, with their SQL.

Queries of files write the driver's tables as such files first, into the shared checkpoint folder, and read them again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terralume.functions import markup
from terralume.functions import scalars as S
from terralume.functions.instants import parse_instant
from terralume.functions.lineage import checkpoint_root, cut
from terralume.functions.places import STATES
from terralume.operators import cards, enrich, incremental, latest, quality
from terralume.plans import normalize, pipeline, resume, snapshot
from terralume.sources import pages, scans, sinks
from terralume.streaming import delta

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach."""
    root = checkpoint_root(spark)
    path = os.path.join(root[5:] if root.startswith("file:") else root, f"files-{uuid.uuid4().hex}")
    return "/" + path.lstrip("/")


def _xml_files(entries: DataFrame, root: str, most: int = 50_000) -> str:
    """Entries (one text column) as XML files of at most ``most`` each, as sitemaps are; row by row, never all at once."""
    folder = _folder(entries.sparkSession)
    os.makedirs(folder)
    file, n = None, 0
    for row in entries.toLocalIterator(prefetchPartitions=False):
        if file is None or n % most == 0:
            if file is not None:
                file.write(f"</{root}>")
                file.close()
            file = open(os.path.join(folder, f"part-{n // most}.xml"), "w", encoding="utf-8")  # noqa: SIM115
            file.write(f'<?xml version="1.0" encoding="UTF-8"?><{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">')
        file.write(row[0] + "\n")
        n += 1
    if file is not None:
        file.write(f"</{root}>")
        file.close()
    return folder


# -- files ---------------------------------------------------------------------------
@query("select 'olx' as source, 'rent' as business, s_suppkey::varchar as id, s_name as name, null as cents, s_suppkey as place from supplier union all select 'lopes', 'sale', c_custkey::varchar, c_name, cast(round(c_acctbal * 100) as bigint)::varchar, c_custkey + 1000000000000 from customer")
def listing_file_scan(spark, directory):
    """CSV and Parquet files of different columns as one table of text, with source and business type from their names, in order."""
    folder = _folder(spark)
    rent, sale = os.path.join(folder, "olx_aluguel_day.csv"), os.path.join(folder, "lopes_venda_day.parquet")
    sinks.write_csv(_t(spark, directory, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).orderBy("id").coalesce(1), rent)
    sinks.write_parquet(_t(spark, directory, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents")), sale)
    found = scans.scan_listings(spark, [rent, os.path.join(folder, "gone.csv"), sale])
    # the first file's rows stand before the second's
    place = F.col("id").cast("bigint") + F.when(F.col("_ord") >= 1 << 48, 1_000_000_000_000).otherwise(0)
    return found.select(F.col("_source").alias("source"), F.col("_business").alias("business"), "id", "name", "cents", place.alias("place"))


@query("select event_id::varchar event_id, event_type, user_id::varchar user_id from events")
def jsonl_scan(spark, directory):
    """A ledger appended to twice, with blank, broken and foreign lines among its rows."""
    path = _folder(spark)
    rows = _t(spark, directory, "events").select("event_id", "event_type", "user_id")
    early = F.col("event_id") < 5000
    sinks.append_jsonl(rows.where(early), path)
    sinks.append_jsonl(rows.where(~early), path)
    spark.createDataFrame([("",), ("{broken",), ("[1, 2]",), ('"text"',)], "value string").coalesce(1).write.mode("append").text(path)
    return scans.read_jsonl(spark, path, scans.text_schema(["event_id", "event_type", "user_id"]))


_CEP_ORDER = "coalesce(cep,'') || '|' || coalesce(logradouro,'') || '|' || coalesce(localidade,'') || '|' || coalesce(nome_municipio,'') || '|' || coalesce(sigla_uf,'') || '|' || coalesce(centroide,'')"
_POINT = r"try_cast(nullif(regexp_extract(centroide, 'POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', {}), '') as double)"
_ZIP_REFERENCE = rf"""select lpad(d, 8, '0') zip, logradouro street, localidade neighbourhood, nome_municipio city, sigla_uf state, {_POINT.format(2)} lat, {_POINT.format(1)} lon
    from (select *, row_number() over (partition by lpad(d, 8, '0') order by {_CEP_ORDER}) n from (select *, regexp_replace(cep, '[^0-9]', '', 'g') d from cepaberto) where length(d) between 1 and 8) where n = 1"""


def _zip_reference(spark: SparkSession, directory: str) -> DataFrame:
    order = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ("cep", "logradouro", "localidade", "nome_municipio", "sigla_uf", "centroide")])
    return scans.zip_reference(_t(spark, directory, "cepaberto").withColumn("_order", order), "_order")


@query(_ZIP_REFERENCE)
def zip_reference_scan(spark, directory):
    return _zip_reference(spark, directory)


_RESOLVED = r"""select lpad(d, 8, '0') zip, street, neighbourhood, city, state, case when not isnan(lat) then lat end lat, case when not isnan(lon) then lon end lon, source, failed
    from (select *, row_number() over (partition by lpad(d, 8, '0') order by enrichment_id) n from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from zipcode_enrichment) where length(d) between 1 and 8) where n = 1"""


def _resolved(spark: SparkSession, directory: str) -> DataFrame:
    known = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return enrich.first_per_zip(_t(spark, directory, "zipcode_enrichment"), "zip_code", "enrichment_id").select(F.col("zip_digits").alias("zip"), "street", "neighbourhood", "city", "state", known("lat"), known("lon"), "source", "failed")


@query(_RESOLVED)
def zip_cache_round(spark, directory):
    """Resolved zip codes written as a cache file and read again."""
    path = os.path.join(_folder(spark), "zip_cache.json")
    sinks.write_zip_cache(enrich.cache_entries(_resolved(spark, directory)), path)
    return scans.zip_cache(spark, path)


_PAGED = "select *, listing_url || case when business_type = 'rent' then '/alugar/' else '/comprar/' end as loc, strftime(date '2026-01-01' + cast(listing_id % 300 as integer), '%Y-%m-%d') as lastmod from listings"


@query(rf"select loc as listing_url, nullif(regexp_extract(loc, '/imovel/([^/?#]+)', 1), '') as listing_id, case when loc like '%/alugar/' then 'rent' else 'sale' end as business_type, max(lastmod) as lastmod from ({_PAGED}) where loc like '%/imovel/%' group by loc")
def sitemap_scan(spark, directory):
    """Links of all listings as a sitemap; entries repeat with other dates, some have no location or are no listing."""
    rows = _t(spark, directory, "listings").select(F.concat("listing_url", F.when(F.col("business_type") == "rent", "/alugar/").otherwise("/comprar/")).alias("loc"), F.date_format(F.expr("date_add(date'2026-01-01', cast(listing_id % 300 as int))"), "yyyy-MM-dd").alias("lastmod"))
    rows = rows.unionByName(spark.createDataFrame([("https://h/guia/1", "2027-01-01"), (None, "2027-01-01"), (" ", None)], "loc string, lastmod string"))
    entry = F.concat(F.lit("<url><loc> "), F.coalesce("loc", F.lit("")), F.lit(" </loc><lastmod>"), F.coalesce("lastmod", F.lit("")), F.lit("</lastmod></url>"))
    return scans.discovery(scans.read_sitemap(spark, _xml_files(rows.select(entry), "urlset")), "quinto")


@query("select 'https://h/sitemap-imoveis-' || c_custkey::varchar || '.xml' as loc, '2026-01-01' as lastmod from customer")
def sitemap_index_scan(spark, directory):
    """An index of sitemaps, of which those of listings are read."""
    c = _t(spark, directory, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    entry = lambda name: F.concat(F.lit(f"<sitemap><loc>https://h/{name}"), "k", F.lit(".xml</loc><lastmod>2026-01-01</lastmod></sitemap>"))
    both = c.select(F.explode(F.array(entry("sitemap-imoveis-"), entry("sitemap-blog-"))))
    return scans.read_sitemap_index(spark, _xml_files(both, "sitemapindex"), "lopes")


@query("select s_suppkey, s_name, case when s_nationkey < 10 then null else 'n' || s_nationkey::varchar end as note, null as gone from supplier")
def store_round(spark, directory):
    """A stored table read with columns it has and one it hasn't; blank texts were written as nulls; it is swapped with itself once."""
    path = os.path.join(_folder(spark), "store")
    s = _t(spark, directory, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_nationkey") < 10, "  ").otherwise(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("note"), F.lit(1).alias("extra"))
    sinks.write_parquet(s, path)
    sinks.swap_in(spark.read.parquet(path), path)
    return scans.read_history(spark, path, ["s_suppkey", "s_name", "note", "gone"])


@query("select c_custkey::varchar c_custkey, c_name, c_mktsegment from customer")
def csv_export(spark, directory):
    """A table as one CSV with byte-order mark, read again."""
    path = os.path.join(_folder(spark), "customers.csv")
    sinks.export_csv_file(_t(spark, directory, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return scans.read_csv(spark, path)


# -- projections -----------------------------------------------------------------------
_PLAIN = {"display_id": "null", "long_description": "null", "neighbourhood": "nullif(neighbourhood,'')", "city": "nullif(city,'')", "zip_code": "nullif(zip_code,'')", "furnished": "furnished", "accepts_pets": "accepts_pets", "has_furniture": "null::boolean", "amenities_json": "nullif(amenities_json,'')", "installations_json": "nullif(installations_json,'')", "condominium_name": "nullif(condominium_name,'')"}
_SQL_52 = {c: {"string": "null::varchar", "bigint": "null::bigint", "double": "null::double", "boolean": "null::boolean"}[t] for c, t in normalize.CANONICAL.items()} | _PLAIN | {
    "source": "nullif(source,'')", "business_type": "coalesce(nullif(business_type,''),'sale')", "property_id": "coalesce(nullif(property_id,''), nullif(listing_id::varchar,''), '')",
    "listing_url": "case when nullif(listing_url,'') is null and source = 'lopes' and coalesce(nullif(property_id,''), listing_id::varchar) <> '' then 'https://www.lopes.com.br/imovel/' || coalesce(nullif(property_id,''), listing_id::varchar) else nullif(listing_url,'') end",
    "description": "null::varchar", "address": "coalesce(nullif(street,''), nullif(address,''))", "state": "case when state = 'SP' then 'São Paulo' when coalesce(state,'') <> '' then state when city = 'São Paulo' then 'São Paulo' end",
    "property_type": "case when source = 'olx' then (case when lower(property_type) like '%apartamento%' then 'Apartamento' when lower(property_type) like '%casa%' then 'Casa' else nullif(trim(property_type), '') end) else nullif(property_type,'') end",
    "lat": "lat", "lon": "lon", "area_m2": "coalesce(area_m2, total_area_m2)", "total_area_m2": "coalesce(total_area_m2, area_m2)", "bedrooms": "bedrooms", "bathrooms": "bathrooms", "parking_spots": "parking_spots", "suites": "suites", "floor": "floor",
    "sale_price_brl": "sale_price_brl", "rent_price_brl": "rent_price_brl", "total_price_brl": "coalesce(nullif(sale_price_brl,0), rent_price_brl)", "condo_fee_brl": "condo_fee_brl", "iptu_brl": "iptu_brl", "scraped_at": "coalesce(nullif(scraped_at,''), '2026-01-01T00:00:00+00:00')",
}


@query("select listing_id as _ord, " + ", ".join(f'{e} as "{c}"' for c, e in _SQL_52.items()) + " from listings")
def normalize_columns(spark, directory):
    """All 52 columns of every listing."""
    raw = _t(spark, directory, "listings")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns], F.col("listing_id").alias("_ord"))
    return normalize.normalize(text, F.lit("2026-01-01T00:00:00+00:00"))


def _amenities(*named: tuple[str, Column]) -> Column:
    """A JSON list of objects with name and value; those without a value are left out, as JSON does."""
    return F.to_json(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in named]))


@query(r"""select listing_id as _ord, condo_fee_brl, iptu_brl, bedrooms, bathrooms, parking_spots, suites, floor,
    case when business_type = 'sale' then sale_price_brl end as sale_price_brl, case when business_type = 'rent' then sale_price_brl end as rent_price_brl, case when business_type = 'sale' then nullif(sale_price_brl, 0) when business_type = 'rent' then sale_price_brl end as total_price_brl,
    coalesce(furnished, false) as furnished, coalesce(furnished, false) as has_furniture from listings""")
def normalize_amenities(spark, directory):
    """Fields that only a record's amenities hold, and a price without kind that goes where the business type says."""
    l = _t(spark, directory, "listings")  # noqa: E741
    fields = {"condominio": "condo_fee_brl", "iptu": "iptu_brl", "rooms": "bedrooms", "bathrooms": "bathrooms", "garage_spaces": "parking_spots", "suites": "suites", "floor": "floor"}
    text = _amenities(*[(n, F.col(c)) for n, c in fields.items()], ("re_features", F.when(F.col("furnished"), "Mobiliado")))
    raw = l.select(F.col("listing_id").alias("_ord"), "business_type", "source", F.col("listing_id").cast("string").alias("ad_id"), text.alias("amenities_json"), F.col("sale_price_brl").cast("string").alias("price"))
    out = normalize.normalize(raw, F.lit("2026-01-01"))
    yes = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return out.select("_ord", *fields.values(), "sale_price_brl", "rent_price_brl", "total_price_brl", yes("furnished"), yes("has_furniture"))


@query("select s_suppkey as property_id, s_name as city, null as state, null::double as area_m2 from supplier")
def align_columns(spark, directory):
    """Exactly the wanted columns: others go, missing ones and values that don't fit are null."""
    s = _t(spark, directory, "supplier").select(F.col("s_suppkey").cast("string").alias("property_id"), F.col("s_name").alias("city"), F.lit("n/d").alias("area_m2"), "s_acctbal")
    return normalize.align(s, {"property_id": "bigint", "city": "string", "state": "string", "area_m2": "double"})


@query(r"""select p_partkey, p_size::bigint as area, cast(floor(p_retailprice) as bigint) as plain, p_partkey as digits, null::bigint as flag, (p_size + 0.5)::double as coordinate, null::double as no_coordinate, p_size::bigint as money from part""")
def number_texts(spark, directory):
    part = _t(spark, directory, "part")
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    label = F.concat(F.lit("IPTU mensal: R$ "), size, F.lit(" Condomínio: R$ 9"))
    return part.select("p_partkey", S.to_int(F.concat(size, F.lit(" m²"))).alias("area"), S.price(F.format_string("%.2f", F.floor(F.col("p_retailprice")) + 0.25)).alias("plain"), S.price(F.concat(F.lit("R$ "), key)).alias("digits"), S.price(F.lit("true")).alias("flag"), S.plain_float(F.concat(F.lit(" "), size, F.lit(".5 "))).alias("coordinate"), S.plain_float(F.concat(size, F.lit(",5"))).alias("no_coordinate"), S.labelled_money(label, "iptu").alias("money"))


@query(r"""with z as (select listing_id, regexp_replace(zip_code, '[^0-9]', '', 'g') d, regexp_extract(zip_code, '\b(\d{5}-?\d{3})\b', 1) m, regexp_extract(address, '\b(\d{5}-?\d{3})\b', 1) a from listings)
    select listing_id, case when length(d) between 1 and 8 then left(lpad(d, 8, '0'), 5) || '-' || right(lpad(d, 8, '0'), 3) when m <> '' then left(m, 5) || '-' || right(m, 3) end as zip_any,
    case when a <> '' then left(a, 5) || '-' || right(a, 3) when m <> '' then left(m, 5) || '-' || right(m, 3) end as first_zip from z""")
def zip_forms(spark, directory):
    return _t(spark, directory, "listings").select("listing_id", S.zip_any(F.col("zip_code")).alias("zip_any"), S.first_zip(F.col("address"), F.col("zip_code")).alias("first_zip"))


@query(r"""select listing_id, 'https://h.example/imovel/' || property_id as absolute, 'https://h.example/a?sf=1' || case when listing_id % 7 > 1 then '&o=' || (listing_id % 7)::varchar else '' end as page,
    case when business_type = 'rent' then 'rent' else 'sale' end as flow, case when business_type = 'rent' then 'rent' else 'sale' end as hinted, case when business_type = 'rent' then 'rent' else 'sale' end as by_slug, listing_url as kept from listings""")
def url_forms(spark, directory):
    rent = F.col("business_type") == "rent"
    path = F.concat(F.lit("https://h/"), F.when(rent, "aluguel").otherwise("venda"), F.lit("/x-1234567"))
    hint = F.concat(F.lit("https://h/imoveis/casa-"), F.when(rent, "para-alugar").otherwise("a-venda"), F.lit("-1234567"))
    slug = F.concat(F.lit("https://h/imovel/REO1/"), F.when(rent, "aluguel").otherwise("venda"), F.lit("-casa/"))
    l = _t(spark, directory, "listings")  # noqa: E741
    return l.select("listing_id", S.absolute_url("https://h.example/", F.concat(F.lit("/imovel/"), "property_id")).alias("absolute"), S.page_url(F.lit("https://h.example/a"), F.col("listing_id") % 7).alias("page"), S.flow_from_url(path).alias("flow"), S.flow_from_url(hint).alias("hinted"), S.slug_business(slug).alias("by_slug"), S.absolute_url("https://h.example/", F.nullif(F.col("listing_url"), F.lit(""))).alias("kept"))


_UF = " ".join(f"when '{code}' then '{name.replace(' ', '-')}'" for code, name in STATES.items())


@query(rf"""select distinct state, coalesce(case upper(trim(state)) {_UF} end, trim(regexp_replace(strip_accents(lower(state)), '[^a-z0-9]+', '-', 'g'), '-')) as slug, trim(regexp_replace(strip_accents(lower(state)), '[^\x00-\x7F]', '', 'g')) as token from listings where state is not null""")
def state_slugs(spark, directory):
    return _t(spark, directory, "listings").where(F.col("state").isNotNull()).select("state", S.state_slug(F.col("state")).alias("slug"), S.token(F.col("state")).alias("token")).distinct()


_SPACE = r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(rf"""with h as (select doc_id, '<p class="a">' || coalesce(text, '') || '</p>é' as html from documents)
    select doc_id, length(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '{_SPACE}+', ' ', 'g'), '^ | $', '', 'g')) as n_clean, length(regexp_replace(html, '^{_SPACE}+|{_SPACE}+$', '', 'g')) as n_described from h""")
def html_clean(spark, directory):
    """Every text with its marks as entities, decoded and cleaned."""
    html = F.concat(F.lit('&lt;p class=&quot;a&quot;&gt;'), F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("</p>&eacute;"))
    return _t(spark, directory, "documents").select("doc_id", F.length(markup.clean_text(html)).cast("bigint").alias("n_clean"), F.length(markup.clean_description(html)).cast("bigint").alias("n_described"))


@query(r"""with e as (select *, cast(ts as date) d, case when extract(month from ts) = 12 then 'dez' when extract(month from ts) = 1 then 'jan' else 'fev' end mon from events)
    select event_id, d as run_date, strftime(ts, '%Y-%m-%dT%H:%M') || ':00-03:00' as this_year, strftime(d - interval 1 year + interval 40 day, '%Y-%m-%d') || 'T07:05:00-03:00' as year_before, epoch_us(ts) + 10800000000 as naive, epoch_us(ts) as zulu from e""")
def more_dates(spark, directory):
    """Dates of runs and of cards with day and month, and instants with and without offset."""
    months = F.create_map(*[x for k, v in S.MONTHS.items() for x in (F.lit(v), F.lit(k))])
    e = _t(spark, directory, "events").withColumn("d", F.to_date("ts"))
    worded = lambda day, at: F.concat(F.dayofmonth(day).cast("string"), F.lit(" de "), F.try_element_at(months, F.month(day)), F.lit(", "), at)
    later = F.date_add(F.add_months("d", -12), 40)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return e.select("event_id", S.run_date(F.date_format("d", "dd-MM-yyyy")).alias("run_date"), S.card_date(worded(F.col("d"), F.date_format("ts", "HH:mm")), F.col("d")).alias("this_year"), S.card_date(worded(later, F.lit("7:05")), F.col("d")).alias("year_before"), F.unix_micros(parse_instant(iso)).alias("naive"), F.unix_micros(parse_instant(F.concat(iso, F.lit("Z")))).alias("zulu"))


# -- pages -------------------------------------------------------------------------------
def _script(kind: str, value: Column) -> Column:
    return F.concat(F.lit(kind), F.replace(F.replace(F.to_json(value), F.lit("<"), F.lit("\\u003c")), F.lit(">"), F.lit("\\u003e")), F.lit("</script></html>"))


def _parsed(df: DataFrame, source: str, html: Column, url: Column, fields: list[str]) -> DataFrame:
    rows = df.select(F.col("listing_id").alias("id"), html.alias("html"), url.alias("url"))
    return pages.parse_pages(rows, source, "html", "url", key="id").select(F.col("key").cast("bigint").alias("listing_id"), *fields)


@query("""select listing_id, nullif(property_id,'') property_id, nullif(city,'') city, nullif(state,'') state, nullif(neighbourhood,'') neighbourhood, nullif(street,'') street, sale_price_brl::varchar price, bedrooms::varchar bedrooms, bathrooms::varchar bathrooms, floor::varchar floor,
    'sale' as business_type, '2026-01-04T05:06:07+00:00' as listing_created_at from listings""")
def parse_card_detail(spark, directory):
    """Pages whose payload a script assigns, one for each listing."""
    l = _t(spark, directory, "listings")  # noqa: E741
    props = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for n, c in (("rooms", "bedrooms"), ("bathrooms", "bathrooms"), ("floor", "floor"))])
    page = F.struct(F.struct(F.col("property_id").alias("list_id"), F.col("sale_price_brl").cast("string").alias("price"), F.lit("1767503167").alias("adDate")).alias("detail"), F.struct(F.col("city").alias("municipality"), "state", "neighbourhood", "street").alias("adDetail"), props.alias("adProperties"))
    html = F.concat(F.lit("<html><script>window.dataLayer = ["), F.to_json(F.struct(page.alias("page"))), F.lit("];</script></html>"))
    return _parsed(l, "olx", html, F.lit("https://sp.olx.example/venda/imoveis"), ["property_id", "city", "state", "neighbourhood", "street", "price", "bedrooms", "bathrooms", "floor", "business_type", "listing_created_at"])


@query("""select listing_id, nullif(street,'') address, nullif(city,'') city, nullif(neighbourhood,'') neighbourhood, nullif(property_type,'') property_type, bedrooms::varchar bedrooms, coalesce(suites::varchar, '0') suites, nullif(condominium_name,'') condominium_name, sale_price_brl::varchar sale_price_brl,
    '["' || listing_id::varchar || '"]' as features_json, 'https://www.lopes.com.br/imovel/REO' || listing_id::varchar || '/venda-casa/' as listing_url, 'REO' || listing_id::varchar as property_id, 'sale' as business_type from listings""")
def parse_nested_detail(spark, directory):
    """Pages whose product lies somewhere in the state of a script element."""
    l = _t(spark, directory, "listings")  # noqa: E741
    attributes = F.array(F.struct(F.lit("bedroom_attr").alias("type"), F.col("bedrooms").cast("string").alias("value")), F.struct(F.lit("suite_attr").alias("type"), F.col("suites").cast("string").alias("value")))
    seo = F.struct(F.concat(F.lit("/imovel/REO"), F.col("listing_id").cast("string"), F.lit("/venda-casa/")).alias("url"))
    product = F.struct(F.struct("street", "city", F.col("neighbourhood").alias("neighborhood")).alias("address"), F.col("property_type").alias("name"), attributes.alias("attributes"), F.struct(F.col("condominium_name").alias("name")).alias("condominium"), F.struct(F.col("sale_price_brl").alias("sale")).alias("prices"), F.array(F.col("listing_id").cast("string")).alias("features"), seo.alias("seo"))
    html = _script('<html><script id="ng-state" type="application/json">', F.struct(F.struct(F.struct(product.alias("product")).alias("b")).alias("key")))
    return _parsed(l, "lopes", html, F.lit(None).cast("string"), ["address", "city", "neighbourhood", "property_type", "bedrooms", "suites", "condominium_name", "sale_price_brl", "features_json", "listing_url", "property_id", "business_type"])


@query("""select listing_id, nullif(street,'') street, nullif(city,'') city, bedrooms::varchar bedrooms, case when coalesce(parking_spots, 0) = 0 then '0' else parking_spots::varchar end parking_spots, 'on' as sale_listing_status, 'off' as rent_listing_status, sale_price_brl::varchar sale_price_brl, case when furnished then 'True' when not furnished then 'False' end as furnished,
    case when sale_price_brl > 0 and rent_price_brl > 0 then 'rent|sale' when sale_price_brl > 0 then 'sale' when rent_price_brl > 0 then 'rent' else 'sale' end as business_type, listing_id::varchar as property_id from listings""")
def parse_house_detail(spark, directory):
    """Pages with a house in the state of the application; its flags tell the business type, else the URL."""
    l = _t(spark, directory, "listings")  # noqa: E741
    listings = F.array(*[F.struct(F.lit(c).alias("businessContext"), F.lit(s).alias("status")) for c, s in (("RENT", "off"), ("SALE", "on"))])
    info = F.struct(F.struct(F.col("street").alias("address"), "city").alias("address"), "bedrooms", F.col("parking_spots").alias("parkingSpots"), F.col("furnished").alias("hasFurniture"), F.col("sale_price_brl").alias("salePrice"), (F.coalesce("sale_price_brl", F.lit(0)) > 0).alias("forSale"), (F.coalesce("rent_price_brl", F.lit(0)) > 0).alias("forRent"), listings.alias("listings"))
    state = F.struct(F.struct(F.struct(F.struct(F.struct(info.alias("houseInfo")).alias("house")).alias("initialState")).alias("pageProps")).alias("props"))
    html = _script('<html><script id="__NEXT_DATA__" type="application/json">', state)
    url = F.concat(F.lit("https://h.example/imovel/"), F.col("listing_id").cast("string"), F.lit("/comprar/"))
    return _parsed(l, "quinto", html, url, ["street", "city", "bedrooms", "parking_spots", "sale_listing_status", "rent_listing_status", "sale_price_brl", "furnished", "business_type", "property_id"])


@query(r"""with c as (select listing_id // 40 as page, listing_id, '/imoveis/casa-' || property_id as href, row_number() over (partition by listing_id // 40, property_id order by listing_id) n, sale_price_brl from listings where regexp_matches('/imoveis/casa-' || property_id, '/imoveis/.+-\d{6,}'))
    select cast(page as bigint) as page, 'https://www.olx.com.br' || href as listing_url, case when sale_price_brl >= 0 then sale_price_brl end as price_brl, case when listing_id % 5 = 0 then null else 'Hoje, 10:16' end as raw_card_date_text, 'Casa ' || listing_id::varchar as title from c where n = 1""")
def parse_card_page(spark, directory):
    """Pages of forty cards in one list; of cards with one link the first counts."""
    l = _t(spark, directory, "listings").withColumn("page", F.expr("listing_id div 40"))  # noqa: E741
    text = lambda c: F.col(c).cast("string")
    top = F.concat(F.lit('<div class="olx-adcard"><div class="olx-adcard__topbody" data-mode="horizontal"><a href="/imoveis/casa-'), F.coalesce("property_id", F.lit("")), F.lit('"><h2>Casa '), text("listing_id"), F.lit("</h2></a></div>"))
    middle = F.concat(F.lit('<div class="olx-adcard__mediumbody"><h3>'), F.coalesce(F.concat(F.lit("R$ "), text("sale_price_brl")), F.lit("A combinar")), F.lit("</h3></div>"))
    bottom = F.concat(F.lit('<div class="olx-adcard__bottombody">'), F.when(F.col("listing_id") % 5 == 0, "").otherwise('<p class="olx-adcard__date">Hoje, 10:16</p>'), F.lit("</div></div>"))
    built = l.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("listing_id", F.concat(top, middle, bottom).alias("card")))).alias("cards"))
    html = F.concat(F.lit('<html><body><div class="AdListing_adListContainer__x">'), F.array_join(F.transform("cards", lambda c: c.card), ""), F.lit("</div></body></html>"))
    return pages.parse_card_pages(built.select("page", html.alias("html")), "html", ["page"]).drop("position")


_CARDS = r"""with c as (select case when event_type in ('click', 'error', 'view') then 'rent' else 'sale' end flow, cast(event_id // 50 as bigint) page, event_id as position, 'https://h/imoveis/x-' || user_id::varchar url, case when value >= 5 then cast(floor(value / 20) as bigint) end price, strftime(ts, '%Y-%m-%dT%H:%M:%S-03:00') posted, ts from events),
    p as (select url, arg_max(coalesce(price, -1), position) previous from c where ts < timestamp '2024-01-12' group by 1), f as (select flow, max(posted) newest from c where ts < timestamp '2024-01-12' group by 1),
    v as (select *, row_number() over (partition by flow, url order by page, position) n from c where price is not null),
    j as (select v.*, posted <= newest as old, case when n > 1 then 'duplicate' when previous = price then 'same_price' else 'kept' end verdict from v left join p on v.url = p.url left join f on v.flow = f.flow),
    a as (select flow, page, old, verdict from j union all select flow, page, false, 'invalid' from c where price is null),
    g as (select flow, page, count(*) items_seen, count(*) filter (where verdict = 'kept') items_kept, count(*) filter (where verdict = 'duplicate') duplicates_in_run, count(*) filter (where verdict = 'same_price') same_price_ignored, count(*) filter (where verdict = 'invalid') invalid_records, count(*) filter (where old and verdict = 'kept') useful_overlap,
        count(*) filter (where old) > 0 and count(*) filter (where not old and verdict <> 'invalid') = 0 as fully_in_overlap from a group by 1, 2),
    s as (select *, fully_in_overlap and useful_overlap = 0 as sterile from g),
    r as (select *, sum(case when sterile then 0 else 1 end) over (partition by flow order by page) run from s), i as (select flow, run, min(page) first, count(*) len from r where sterile group by 1, 2), st as (select flow, min(first) + 2 stop_at from i where len >= 3 group by 1)"""


def _card_run(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = _t(spark, directory, "events")
    found = e.select(F.when(F.col("event_type").isin("click", "error", "view"), "rent").otherwise("sale").alias("flow"), F.expr("event_id div 50").alias("page"), F.col("event_id").alias("position"), F.concat(F.lit("https://h/imoveis/x-"), F.col("user_id").cast("string")).alias("listing_url"), F.when(F.col("value") >= 5, F.floor(F.col("value") / 20)).alias("price_brl"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-03:00'").alias("listing_posted_at"), F.lit("Hoje").alias("raw_card_date_text"), "ts")
    before = found.where("ts < '2024-01-12'").select("listing_url", F.col("flow").alias("business_type"), F.coalesce("price_brl", F.lit(-1).cast("bigint")).alias("price_brl"), "listing_posted_at", "position")
    prices, flows = cards.card_state(before, "position")
    return cards.run_cards(found.drop("ts"), prices, flows)


@query(_CARDS + " select s.* from s left join st on s.flow = st.flow where stop_at is null or page <= stop_at")
def card_page_flow(spark, directory):
    """Counts of each page of a run over all events as cards, up to where their flow stops."""
    return _card_run(spark, directory)[2]


@query(_CARDS + " select j.url as listing_url, j.flow as business_type, price as price_brl, posted as listing_posted_at, page, position from j left join st on j.flow = st.flow where verdict = 'kept' and (stop_at is null or page <= stop_at)")
def cards_kept(spark, directory):
    return _card_run(spark, directory)[0]


@query(_CARDS + " select c.flow, 'missing_price' as invalid_reason, url as listing_url, count(*) as n from c left join st on c.flow = st.flow where price is null and (stop_at is null or page <= stop_at) group by all")
def cards_rejected(spark, directory):
    return _card_run(spark, directory)[1].groupBy("flow", "invalid_reason", "listing_url").agg(F.count("*").alias("n"))


@query(r"""select business_type, min(ts) as oldest, max(ts) as newest from (select case when lower(trim(business_type)) in ('sale','rent') then lower(trim(business_type)) end business_type, make_timestamp(epoch_us(last_seen_at)) ts, listing_url from listings_unificados) where business_type is not null and trim(coalesce(listing_url,'')) <> '' group by 1""")
def card_windows(spark, directory):
    """Oldest and newest posting of each flow in the store."""
    rows = _t(spark, directory, "listings_unificados").select("listing_url", "business_type", F.col("price").alias("price_brl"), F.concat(F.date_format("last_seen_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("listing_posted_at"), "row_id")
    return cards.card_state(rows, "row_id")[1].select(F.col("flow").alias("business_type"), F.col("oldest").cast("timestamp_ntz").alias("oldest"), F.col("newest").cast("timestamp_ntz").alias("newest"))


@query(r"""select listing_id, rank() over (order by t desc nulls last) as place from (select listing_id, case when regexp_full_match(trim(scraped_at), '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|\+00:00)') then epoch_us(try_cast(left(regexp_replace(trim(scraped_at), '(Z|\+00:00)$', ''), 26) as timestamp)) end t from listings)""")
def posted_order(spark, directory):
    """Listings by the instant written on them, newest first, unreadable ones last."""
    plain = F.col("scraped_at").rlike(r"^\s*\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|\+00:00)\s*$")
    rows = _t(spark, directory, "listings").select("listing_id", F.when(plain, F.col("scraped_at")).alias("at"))
    # rows of one instant share a place: the number of rows before them, from sums over the distinct instants
    each = rows.withColumn("t", parse_instant(F.col("at"))).groupBy("t").agg(F.count("*").alias("n"))
    placed = latest.numbered(each, [F.col("t").desc_nulls_last()], "i")
    before = placed.withColumn("chunk", F.expr("i div 1024"))
    chunks = before.groupBy("chunk").agg(F.sum("n").alias("c")).withColumn("ahead", F.coalesce(F.sum("c").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("chunk").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = before.withColumn("inside", inside).join(chunks, "chunk").select(F.col("t").alias("u"), (1 + F.col("ahead") + F.col("inside")).alias("place"))
    return rows.withColumn("t", parse_instant(F.col("at"))).join(ranks, F.col("t").eqNullSafe(F.col("u"))).select("listing_id", "place")


# -- enrichment ----------------------------------------------------------------------------
_FILLED = rf"""with z as ({_RESOLVED}), base as (select * from z where not failed), sec as ({_ZIP_REFERENCE}),
    cand as (select distinct lpad(d, 8, '0') zip from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from listings) where length(d) between 1 and 8),
    txt as (select coalesce(base.zip, sec.zip) zip, coalesce(case when regexp_matches(base.street,'\S') then base.street end, sec.street) street, coalesce(case when regexp_matches(base.city,'\S') then base.city end, sec.city) city, coalesce(case when regexp_matches(base.state,'\S') then base.state end, sec.state) state, coalesce(base.lat, sec.lat) lat, coalesce(base.lon, sec.lon) lon from base full join sec on base.zip = sec.zip)"""


def _enriched(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    listings = _t(spark, directory, "listings").select("listing_id", "zip_code", "neighbourhood", "address", "city", "state", "lat", "lon")
    known = _resolved(spark, directory)
    base = known.where(~F.col("failed")).drop("failed")
    secondary = _zip_reference(spark, directory).withColumn("source", F.lit("cepaberto"))
    return enrich.enrich_listings(listings, known.limit(0), base, secondary, base.limit(0))


@query(_FILLED + r""" select l.listing_id, case when regexp_matches(l.address,'\S') then l.address else t.street end address, case when regexp_matches(l.city,'\S') then l.city else t.city end city, case when regexp_matches(l.state,'\S') then l.state else t.state end state, coalesce(l.lat, t.lat) lat, coalesce(l.lon, t.lon) lon
    from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from listings) l left join txt t on length(l.d) between 1 and 8 and lpad(l.d, 8, '0') = t.zip""")
def enrich_run(spark, directory):
    """Listings with the gaps filled that their zip codes can fill."""
    return _enriched(spark, directory)[0].select("listing_id", "address", "city", "state", "lat", "lon")


@query(_FILLED + r""", o as (select *, lpad(d, 8, '0') zip, not coalesce(regexp_matches(address,'\S'), false) na, lat is null nl, lon is null nn from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from listings) where length(d) between 1 and 8 and (not coalesce(regexp_matches(address,'\S'), false) or not coalesce(regexp_matches(city,'\S'), false) or not coalesce(regexp_matches(state,'\S'), false) or lat is null or lon is null)),
    k as (select o.*, t.street, t.lat tlat, t.lon tlon, coalesce(t.street, t.city, t.state, tn.neighbourhood, t.lat::varchar, t.lon::varchar) is not null found from o left join txt t on o.zip = t.zip left join (select coalesce(base.zip, sec.zip) zip, coalesce(case when regexp_matches(base.neighbourhood,'\S') then base.neighbourhood end, sec.neighbourhood) neighbourhood from base full join sec on base.zip = sec.zip) tn on o.zip = tn.zip)
    select (select count(distinct zip) from o) zip_codes_consulted, (select count(*) - count(distinct zip) from o) zip_code_cache_hits, count(*) filter (where na and found and regexp_matches(street,'\S')) zip_code_address_filled_count,
    count(*) filter (where found and ((nl and tlat is not null) or (nn and tlon is not null))) zip_code_coordinates_filled_count, count(*) filter (where not found) zip_code_resolution_failures from k""")
def enrich_counts(spark, directory):
    """What the enrichment counts: codes looked up, answers used again, gaps filled, codes without answer."""
    return _enriched(spark, directory)[2].select("zip_codes_consulted", "zip_code_cache_hits", "zip_code_address_filled_count", "zip_code_coordinates_filled_count", "zip_code_resolution_failures")


@query(rf"""with z as ({_RESOLVED}), sec as ({_ZIP_REFERENCE}), w as (select distinct lpad(d, 8, '0') zip from (select regexp_replace(zip_code, '[^0-9]', '', 'g') d from listings) where length(d) between 1 and 8),
    r as (select zip, nullif(address,'') street, lat, lon from (select lpad(d, 8, '0') zip, address, lat, lon, row_number() over (partition by lpad(d, 8, '0') order by canonical_property_id) n from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from properties_unified) where length(d) between 1 and 8) where n = 1)
    select w.zip, case when coalesce(z.failed, false) and z.source is distinct from 'cepbrasil' then z.street else coalesce(case when regexp_matches(case when not z.failed then z.street end,'\S') then z.street end, case when regexp_matches(sec.street,'\S') then sec.street end, r.street) end street,
    case when coalesce(z.failed, false) then z.lat else coalesce(z.lat, sec.lat, r.lat) end lat,
    case when coalesce(z.failed, false) then true else coalesce(case when not z.failed and regexp_matches(z.street,'\S') then z.street end, case when regexp_matches(sec.street,'\S') then sec.street end, r.street, z.neighbourhood, sec.neighbourhood, z.city, sec.city, z.state, sec.state, z.lat::varchar, sec.lat::varchar, r.lat::varchar, z.lon::varchar, sec.lon::varchar, r.lon::varchar) is null end failed
    from w left join z on w.zip = z.zip left join sec on w.zip = sec.zip left join r on w.zip = r.zip""")
def zip_lookup_chain(spark, directory):
    """The zip codes of all listings looked up in the cache (failures stay failures), the reference, and answers fetched beforehand."""
    z = _resolved(spark, directory)
    dimension = _zip_reference(spark, directory).withColumn("source", F.lit("cepaberto"))
    nothing = F.lit(None).cast("string")
    fetched = enrich.first_per_zip(_t(spark, directory, "properties_unified"), "zip_code", "canonical_property_id").select(F.col("zip_digits").alias("zip"), F.nullif("address", F.lit("")).alias("street"), nothing.alias("neighbourhood"), nothing.alias("city"), nothing.alias("state"), "lat", "lon", F.lit("page").alias("source"))
    wanted = _t(spark, directory, "listings").select(S.zip_digits(F.col("zip_code")).alias("zip"))
    return enrich.lookup_chain(wanted, z, dimension, fetched, "zip").select("zip", "street", "lat", "failed")


@query(r"""select enrichment_id, case when regexp_matches(coalesce(street,''), '\S') and regexp_matches(coalesce(neighbourhood,''), '\S') and regexp_matches(coalesce(city,''), '\S') and regexp_matches(coalesce(state,''), '\S')
    then trim(street) || ', ' || trim(neighbourhood) || ', ' || trim(city) || ', ' || trim(state) || case when regexp_matches(coalesce(zip_code,''), '\S') then ', ' || trim(zip_code) else '' end || ', Brasil' end as exact, case when regexp_matches(coalesce(street,''), '\S') and regexp_matches(coalesce(neighbourhood,''), '\S') and regexp_matches(coalesce(city,''), '\S') and regexp_matches(coalesce(state,''), '\S')
    then trim(street) || ', ' || trim(neighbourhood) || ', ' || trim(city) || ', ' || trim(state) || ', Brasil' end as wide from zipcode_enrichment""")
def geocode_variants(spark, directory):
    z = _t(spark, directory, "zipcode_enrichment").withColumn("q", enrich.geocode_queries("street", "neighbourhood", "city", "state", "zip_code"))
    return z.select("enrichment_id", F.get("q", F.lit(0)).alias("exact"), F.try_element_at("q", F.lit(-1)).alias("wide"))


# -- resuming --------------------------------------------------------------------------------
@query("""select id, min(part) part from (select o_custkey::varchar id, 0 part from orders union all select c_custkey::varchar, 1 from customer) group by 1""")
def recover_records(spark, directory):
    """Records there are and records of another round, first of each id; those there were come first."""
    have = _t(spark, directory, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.lit("u").alias("url"), F.col("o_orderkey").alias("n"), F.lit(0).alias("part"))
    more = _t(spark, directory, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.lit("u").alias("url"), F.col("c_custkey").alias("n"), F.lit(1).alias("part"))
    return incremental.recover(have, more, "id", "url", "n").select("id", "part")


@query("""with o as (select event_type as label, event_id, value < 40 failed, event_id % 11 = 0 as neutral from events), k as (select *, sum(case when failed then 0 else 1 end) over (partition by label order by event_id) run from o where not neutral),
    n as (select *, row_number() over (partition by label, run order by event_id) i from k where failed) select label, min(event_id) as stop_at from n where i = 5 group by 1""")
def failure_breaker(spark, directory):
    """Where each flow of outcomes breaks off: at its fifth failure on end, outcomes that count as neither passed over."""
    e = _t(spark, directory, "events")
    status = F.when(F.col("event_id") % 11 == 0, "not_found").when(F.col("value") < 40, "failed").otherwise("saved")
    return resume.breaker_stop(e.select(F.col("event_type").alias("label"), "event_id", status.alias("status")), "event_id", "status", ("failed",), at_least=5, flow="label")


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 49) order by p_partkey limit 500")
def batch_slice(spark, directory):
    """The next batch of pending work: a batch is 500 records."""
    done = _t(spark, directory, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return resume.next_batch(incremental.pending(_t(spark, directory, "part"), done, ["p_partkey"], "p_partkey").select("p_partkey"), "p_partkey")


@query("""select trim(listing_id::varchar) as key, 'saved' as status, '2026-01-01' as updated_at, nullif(trim(listing_url),'') listing_url, nullif(trim(property_id),'') property_id, nullif(trim(business_type),'') business_type, 'olx' as label, listing_id as scheduled_index from listings""")
def ledger_rows(spark, directory):
    rows = _t(spark, directory, "listings").select(F.col("listing_id").cast("string").alias("key"), F.lit("saved").alias("status"), "listing_url", "property_id", "business_type", F.col("listing_id").alias("scheduled_index"))
    return resume.ledger_entries(rows, "olx", F.lit("2026-01-01"))


@query("""select 'id:' || trim(property_id) as key, count(*) as n from listings where regexp_matches(property_id, '\\S') group by 1 union all select 'url:' || trim(listing_url), count(*) from listings where not coalesce(regexp_matches(property_id, '\\S'), false) and regexp_matches(listing_url, '\\S') group by 1""")
def resume_keys(spark, directory):
    c = F.col
    rows = _t(spark, directory, "listings").where(c("property_id").rlike(r"\S") | c("listing_url").rlike(r"\S"))
    return rows.select(incremental.resume_key(F.lit(None).cast("string"), c("property_id"), c("listing_url"), F.lit("")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


# -- checks ------------------------------------------------------------------------------------
@query("""select count(*) as rows, bool_and(coalesce(regexp_matches(business_type, '\\S'), false) and (coalesce(regexp_matches(property_id, '\\S'), false) or coalesce(regexp_matches(listing_url, '\\S'), false))) as keyed, bool_and(source is not null) as has_source, bool_and(coalesce(sale_price_brl, 0) >= 0) as price_sane from listings""")
def quality_report(spark, directory):
    """The checks that a day's listings must pass, in one pass."""
    return quality.row_checks(_t(spark, directory, "listings"), {"keyed": latest.required_key("business_type", "property_id", "listing_url"), "has_source": F.col("source").isNotNull(), "price_sane": F.coalesce("sale_price_brl", F.lit(0)) >= 0})


@query("""select * from (values ('canonical_columns', false), ('not_empty', true), ('links_have_properties', true), ('business_keys', (select bool_and(source is not null and coalesce(regexp_matches(business_type, '\\S'), false) and (coalesce(regexp_matches(property_id, '\\S'), false) or coalesce(regexp_matches(listing_url, '\\S'), false))) from listings))) t(name, passed)""")
def snapshot_checks(spark, directory):
    """The checks of a snapshot over all listings; their table lacks canonical columns, and the check says so."""
    tables = snapshot.snapshot(_t(spark, directory, "listings").withColumn("_ord", F.col("listing_id")).drop("canonical_property_id"))
    checks = pipeline.snapshot_checks({k: cut(v) for k, v in tables.items()})
    return spark.createDataFrame([(c.name, bool(c.passed)) for c in checks], "name string, passed boolean")


# -- streams -------------------------------------------------------------------------------------
def stream_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table as a stream of its files, from where it lies."""
    path = f"{directory}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if whole else reader.option("pathGlobFilter", f"{name}.parquet").parquet(directory)


def run_stream(df: DataFrame, mode: str) -> DataFrame:
    """What a stream writes when it has read all there is; table and state lie in the shared checkpoint folder."""
    spark = df.sparkSession
    out = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{out}/state").option("path", f"{out}/rows").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


@query("""with s as (select user_id, event_type, event_id, lag(event_type) over (partition by user_id order by event_id) p, row_number() over (partition by user_id order by event_id) n from events)
    select user_id, event_type, event_id, case when n = 1 then 'new' when p = event_type then 'unchanged' else 'updated' end change from s""")
def stream_delta(spark, directory):
    return run_stream(delta.stream_changes(stream_table(spark, directory, "events"), "user_id", "event_type", "event_id"), "append")


@query("""select time_bucket(interval 1 day, ts) as window_start, event_type, count(*) as n from events group by 1, 2 having time_bucket(interval 1 day, ts) + interval 1 day <= (select max(ts) from events) - interval 2 hour""")
def windowed_counts(spark, directory):
    """Events by day and type; a day comes out when the watermark has passed its end."""
    stream = stream_table(spark, directory, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = run_stream(delta.windowed_counts(stream, "at", "2 hours", "1 day", "event_type"), "append")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("select user_id, event_type, max(event_id) as event_id from events group by 1, 2")
def upsert_stream(spark, directory):
    """The newest event of each user and type, kept up by micro-batches."""
    target = f"{checkpoint_root(spark)}/upsert-{uuid.uuid4().hex}"
    stream = stream_table(spark, directory, "events").select("user_id", "event_type", "event_id")
    delta.upsert_stream(stream, f"{target}/table", ["user_id", "event_type"], ["event_id"], f"{target}/state").awaitTermination()
    return delta.read_upserted(spark, f"{target}/table").select("user_id", "event_type", "event_id")
