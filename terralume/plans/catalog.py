"""Every reference operator as a query over the driver's tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralume.functions import jsonx
from terralume.functions import scalars as S
from terralume.operators import enrich, incremental, latest, quality, resolve
from terralume.plans import normalize, snapshot

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


#: SQL of the canonical key and the availability flags, used by several oracles.
_KEY = r"""lower(regexp_replace(coalesce({0},''), '^\s+|\s+$', '', 'g'))"""
_CID = r"""case when {c} || {n} || {a} <> '' or {s} > 0 or coalesce(bedrooms,0) > 0 or coalesce(bathrooms,0) > 0
    then {c} || '|' || {n} || '|' || {a} || '|' || {s}::varchar || '|' || coalesce(bedrooms,0)::varchar || '|' || coalesce(bathrooms,0)::varchar
    else coalesce(source,'') || '|' || case when trim(coalesce(property_id,'')) <> '' then trim(property_id) else trim(coalesce(listing_url,'')) end end""".format(
    c=_KEY.format("city"), n=_KEY.format("neighbourhood"), a=_KEY.format("address"), s="cast(round_even(coalesce(area_m2,0), 0) as bigint)"
)
_LATEST = """select * exclude (rn) from (select *, row_number() over (partition by coalesce(source,''), coalesce(business_type,''), coalesce(property_id,''), coalesce(listing_url,'')
    order by scraped_at desc nulls last, listing_id desc) rn from listings) where rn = 1"""
_FLAGGED = f"""
    with one as ({_LATEST}), keyed as (select * exclude (canonical_property_id), {_CID} as cid from one),
    own as (select *, coalesce(lower(trim(business_type)) in ('sale','rent|sale'), false) s, coalesce(lower(trim(business_type)) in ('rent','rent|sale'), false) r,
        source is not null and coalesce(regexp_matches(property_id, '[^\\s]'), false) known from keyed),
    flagged as (select *,
        bool_or(s) over (partition by cid) or (known and bool_or(s and known) over (partition by source, property_id)) or coalesce(sale_price_brl,0) > 0 is_for_sale,
        bool_or(r) over (partition by cid) or (known and bool_or(r and known) over (partition by source, property_id)) or coalesce(rent_price_brl,0) > 0 is_for_rent,
        row_number() over (order by scraped_at nulls first, listing_id) o from own)"""


# -- one row for each key -------------------------------------------------------
@query(f"select listing_id, source, business_type, property_id, scraped_at from ({_LATEST})")
def latest_per_key(spark, directory):
    return latest.latest_per_key(_t(spark, directory, "listings"), snapshot.LISTING_KEY, "scraped_at", "listing_id").select("listing_id", "source", "business_type", "property_id", "scraped_at")


@query("select user_id, event_type, event_id, ts from (select *, row_number() over (partition by user_id, event_type order by event_id) n from events) where n = 1")
def first_per_key(spark, directory):
    return latest.first_per_key(_t(spark, directory, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "ts")


@query("""select listing_id from (select listing_id, row_number() over (partition by coalesce(source,''), coalesce(business_type,''),
    case when regexp_matches(coalesce(property_id,''), '\\S') then trim(property_id) else '' end, case when regexp_matches(coalesce(property_id,''), '\\S') then '' else trim(listing_url) end order by listing_id) n
    from listings where regexp_matches(coalesce(property_id,''), '\\S') or regexp_matches(coalesce(listing_url,''), '\\S')) where n = 1""")
def dedupe_records(spark, directory):
    return latest.dedupe_records(_t(spark, directory, "listings"), "source", "business_type", "property_id", "listing_url", "listing_id").select("listing_id")


@query("""select p_brand || '|' || p_type as url, max(p_retailprice) as lastmod, min(p_partkey) filter (where p_retailprice = m) as p_partkey
    from (select *, max(p_retailprice) over (partition by p_brand || '|' || p_type) m from part) group by 1""")
def max_lastmod_per_url(spark, directory):
    parts = _t(spark, directory, "part").withColumn("url", F.concat_ws("|", "p_brand", "p_type"))
    return latest.top_per_key(parts, ["url"], [F.col("p_retailprice").desc_nulls_last(), F.col("p_partkey").asc()]).select("url", F.col("p_retailprice").alias("lastmod"), "p_partkey")


@query("""with daily as (select event_type, cast(ts as date) d, count(*) n from events group by 1, 2),
    marked as (select *, n < avg(n) over (partition by event_type) sterile, row_number() over (partition by event_type order by d) pos from daily),
    runs as (select *, sum(case when sterile then 0 else 1 end) over (partition by event_type order by pos) run from marked),
    isl as (select event_type, run, min(pos) first, count(*) len from runs where sterile group by 1, 2)
    select event_type, cast(min(first) + 2 as bigint) stop_at from isl where len >= 3 group by 1""")
def late_page_stop(spark, directory):
    from pyspark.sql import Window

    daily = _t(spark, directory, "events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    placed = daily.withColumn("pos", F.row_number().over(Window.partitionBy("event_type").orderBy("d"))).withColumn("mean", F.avg("n").over(Window.partitionBy("event_type")))
    runs = latest.islands(placed, "event_type", "pos", F.col("n") < F.col("mean"))
    return latest.stop_position(runs, "event_type").select("event_type", F.col("stop_at").cast("bigint").alias("stop_at"))


# -- entities ---------------------------------------------------------------------
@query(f"select listing_id, {_CID} as canonical_property_id from listings")
def canonical_id(spark, directory):
    return snapshot.with_canonical_id(_t(spark, directory, "listings")).select("listing_id", "canonical_property_id")


@query(_FLAGGED + " select listing_id, is_for_sale, is_for_rent, case when is_for_sale and is_for_rent then 'sale_rent' when is_for_sale then 'sale' else 'rent' end listing_mode from flagged")
def availability(spark, directory):
    rows = snapshot.unified(_t(spark, directory, "listings"), "listing_id")[0]
    return rows.select("listing_id", "is_for_sale", "is_for_rent", resolve.listing_mode(F.col("is_for_sale"), F.col("is_for_rent")).alias("listing_mode"))


_ROLLED = ", ".join([*(f"arg_max({c}, o) filter (where {c} is not null) {c}" for c in resolve.ATTRIBUTES_FIRST), *(f"max({c}) {c}" for c in resolve.ATTRIBUTES_MAX), *(f"bool_or({c}) {c}" for c in resolve.ATTRIBUTES_ANY)])


@query(_FLAGGED + f""" select cid canonical_property_id, {_ROLLED}, min(scraped_at) first_seen_at, max(scraped_at) last_seen_at, count(property_id) listings_count,
    bool_or(is_for_sale) is_for_sale, bool_or(is_for_rent) is_for_rent,
    case when bool_or(is_for_sale) and bool_or(is_for_rent) then 'sale_rent' when bool_or(is_for_sale) then 'sale' else 'rent' end listing_mode from flagged group by cid""")
def canonical_rollup(spark, directory):
    return snapshot.unified(_t(spark, directory, "listings"), "listing_id")[1]


@query(_FLAGGED + " select cid canonical_property_id, source, property_id, business_type, listing_url, scraped_at from flagged")
def entity_links(spark, directory):
    return snapshot.unified(_t(spark, directory, "listings"), "listing_id")[2]


@query(_FLAGGED + """, e as (select cid, arg_max(sale_price_brl, o) filter (where sale_price_brl is not null) sp, arg_max(rent_price_brl, o) filter (where rent_price_brl is not null) rp, bool_or(is_for_sale) s1, bool_or(is_for_rent) r1 from flagged group by 1)
    select listing_url, scraped_at, f.cid canonical_property_id, f.sale_price_brl listing_sale_price_brl, f.rent_price_brl listing_rent_price_brl, e.sp sale_price_brl, e.rp rent_price_brl,
    case when s1 and r1 then 'sale_rent' when s1 then 'sale' else 'rent' end listing_mode from flagged f join e on f.cid = e.cid""")
def snapshot_pipeline(spark, directory):
    rows = snapshot.snapshot(_t(spark, directory, "listings").withColumn("_ord", F.col("listing_id")).drop("canonical_property_id"))["listings"]
    return rows.select("listing_url", "scraped_at", "canonical_property_id", "listing_sale_price_brl", "listing_rent_price_brl", "sale_price_brl", "rent_price_brl", "listing_mode")


@query("""with l as (select distinct on (source, property_id, business_type) source, property_id, business_type, canonical_property_id from (select source, property_id, business_type, min(canonical_property_id) canonical_property_id from listings group by all))
    select r.listing_id, l.canonical_property_id from (select listing_id, source, property_id, nullif(business_type, 'rent') business_type from listings) r
    left join (select source, property_id, nullif(business_type,'rent') business_type, min(canonical_property_id) canonical_property_id from l group by all) l
    on r.source is not distinct from l.source and r.property_id is not distinct from l.property_id and r.business_type is not distinct from l.business_type""")
def attach_canonical(spark, directory):
    rows = _t(spark, directory, "listings").withColumn("business_type", F.nullif(F.col("business_type"), F.lit("rent")))
    links = rows.select("source", "property_id", "business_type", "canonical_property_id")
    return resolve.attach(rows.drop("canonical_property_id"), links, ["source", "property_id", "business_type"], "canonical_property_id").select("listing_id", "canonical_property_id")


@query("""select o_custkey, first_order, business_type from (select o_custkey, min(o_orderkey) first_order, bool_or(o_orderstatus in ('F','P')) s, bool_or(o_orderstatus in ('O','P')) r from orders group by 1),
    lateral (select case when s and r then 'rent|sale' when r then 'rent' when s then 'sale' end business_type)""")
def group_types(spark, directory):
    kinds = F.when(F.col("o_orderstatus") == "F", "sale").when(F.col("o_orderstatus") == "O", "rent").otherwise("rent|sale")
    orders = _t(spark, directory, "orders").withColumns({"bt": kinds, "first_order": F.col("o_orderkey")})
    return resolve.group_types(orders, "o_custkey", "bt", "o_orderkey", ["first_order"])


@query("select l_suppkey, l_returnflag, min(l_shipdate) first_seen_at, max(l_shipdate) last_seen_at, count(l_partkey) listings_count from lineitem group by 1, 2")
def first_last_seen(spark, directory):
    return _t(spark, directory, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.min("l_shipdate").alias("first_seen_at"), F.max("l_shipdate").alias("last_seen_at"), F.count("l_partkey").alias("listings_count"))


@query("""select c_custkey, n_name from (select c_custkey, nullif(c_nationkey, 3) k from customer) c left join (select nullif(n_nationkey, 3) k, n_name from nation) n on c.k is not distinct from n.k""")
def nullsafe_join(spark, directory):
    three = F.lit(3)
    c = _t(spark, directory, "customer").select("c_custkey", F.nullif(F.col("c_nationkey"), three).alias("k"))
    n = _t(spark, directory, "nation").select(F.nullif(F.col("n_nationkey"), three).alias("k"), "n_name")
    return resolve.attach(c, n, ["k"], "n_name").select("c_custkey", "n_name")


# -- incremental --------------------------------------------------------------------
def _stores(spark, directory):
    """All rows split by one date: before it they are in the store, from it on (or without a date) they come in."""
    rows = _t(spark, directory, "listings_unificados").select("row_id", "source", "business_type", "property_id", "price", F.col("last_seen_at").alias("scraped_at"))
    early = F.coalesce(F.col("scraped_at") < F.lit("2026-02-01").cast("timestamp_ntz"), F.lit(False))
    old = rows.where(early).withColumns({"first_seen_at": F.lit("2026-01-01").cast("timestamp"), "created_at": F.lit("2026-01-01").cast("timestamp"), "last_seen_at": F.lit("2026-02-01").cast("timestamp"), "updated_at": F.lit("2026-02-01").cast("timestamp")})
    return old, rows.where(~early)


_SPLIT = """with u as (select row_id, coalesce(source,'') s, coalesce(business_type,'') b, coalesce(property_id,'') p, price, last_seen_at a, case when last_seen_at < timestamp '2026-02-01' then 0 else 1 end run from listings_unificados)"""


@query(f"""{_SPLIT}, w as (select *, row_number() over (partition by s, b, p order by a desc nulls last, run desc, row_id desc) n, min(run) over (partition by s, b, p) lo from u)
    select row_id, s as source, b as business_type, p as property_id, price, a as scraped_at, case when lo = 0 then '2026-01-01' else '2026-04-01' end first_seen, case when run = 1 then '2026-04-01' else '2026-02-01' end last_seen from w where n = 1""")
def upsert_history(spark, directory):
    old, new = _stores(spark, directory)
    out = incremental.upsert(old, new, snapshot.UPSERT_KEY, "scraped_at", "row_id", F.lit("2026-04-01").cast("timestamp"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return out.select("row_id", *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in snapshot.UPSERT_KEY], "price", "scraped_at", day("first_seen_at").alias("first_seen"), day("last_seen_at").alias("last_seen"))


@query(f"""{_SPLIT}, k as (select s, b, p, min(run) lo, max(run) hi from u group by 1, 2, 3)
    select count(*) filter (where lo = 1) inserted, count(*) filter (where lo = 0 and hi = 1) updated from k""")
def upsert_counts(spark, directory):
    return incremental.upsert_counts(*_stores(spark, directory), snapshot.UPSERT_KEY)


_DELTA = """with keyed as (select user_id::varchar || '|' || event_type url, ts from events),
    prev as (select url, max(cast(ts as date)) lastmod from keyed where ts < timestamp '2024-01-25' group by 1),
    wm as (select max(lastmod) w from prev), cur as (select url, max(cast(ts as date)) lastmod from keyed group by 1),
    cl as (select cur.url, cur.lastmod, case when cur.lastmod < w - interval 1 day then 'filtered' when prev.url is null then 'new' when prev.lastmod is distinct from cur.lastmod then 'updated' else 'unchanged' end change
        from cur left join prev on cur.url = prev.url cross join wm)"""


def _classified(spark, directory):
    """All events against those before a date."""
    keyed = _t(spark, directory, "events").select(F.concat(F.col("user_id").cast("string"), F.lit("|"), "event_type").alias("url"), F.to_date("ts").alias("lastmod"))
    state = keyed.where(F.col("lastmod") < "2024-01-25").groupBy("url").agg(F.max("lastmod").alias("previous"))
    current = keyed.groupBy("url").agg(F.max("lastmod").alias("lastmod")).withColumn("n", F.col("url"))
    return incremental.classify_delta(current, state, ["url"], "lastmod", F.col("lastmod"), state.agg(F.max("previous").alias("watermark")), "n")


@query(_DELTA + " select url, lastmod, change from cl")
def incremental_delta(spark, directory):
    return _classified(spark, directory).select("url", "lastmod", "change")


@query(_DELTA + " select count(*) filter (where change='new') rows_new, count(*) filter (where change='updated') rows_updated, count(*) filter (where change='unchanged') rows_unchanged, count(*) filter (where change='filtered') rows_filtered from cl")
def delta_counts(spark, directory):
    return incremental.change_counts(_classified(spark, directory))


@query(_DELTA + " select url, lastmod, row_number() over (order by coalesce(lastmod::varchar,'') desc, url) place from cl where change in ('new','updated')")
def delta_sort(spark, directory):
    rows = incremental.delta(_classified(spark, directory)).select("url", "lastmod")
    return latest.numbered(rows, incremental.delta_order("lastmod", "url"), "place")


@query("""with p as (select l_partkey, arg_max(l_quantity, l_orderkey * 10 + l_linenumber) previous from lineitem where l_shipdate < timestamp '1996-01-01' group by 1),
    c as (select l_partkey, arg_min(l_quantity, l_orderkey * 10 + l_linenumber) price from lineitem where l_shipdate >= timestamp '1996-01-01' group by 1)
    select c.l_partkey, price, case when previous is null then 'new' when previous = price then 'same' else 'changed' end change from c left join p on c.l_partkey = p.l_partkey""")
def price_delta(spark, directory):
    lines = _t(spark, directory, "lineitem").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    state = incremental.last_state(lines.where("l_shipdate < '1996-01-01'"), ["l_partkey"], "l_quantity", "o")
    current = lines.where("l_shipdate >= '1996-01-01'").groupBy("l_partkey").agg(F.min_by("l_quantity", "o").alias("price"))
    change = F.when(F.col("previous").isNull(), "new").when(F.col("previous") == F.col("price"), "same").otherwise("changed")
    return current.join(state, "l_partkey", "left").select("l_partkey", "price", change.alias("change"))


@query("""with n as (select event_type, max(ts) newest from events where ts < timestamp '2024-01-15' group by 1),
    c as (select e.event_type, cast(e.event_id // 100 as bigint) page, coalesce(e.ts <= n.newest, false) old from events e left join n on e.event_type = n.event_type)
    select event_type, page, count(*) filter (where old) overlap, count(*) filter (where not old) newer, count(*) filter (where old) > 0 and count(*) filter (where not old) = 0 fully_in_overlap from c group by 1, 2""")
def page_overlap(spark, directory):
    events = _t(spark, directory, "events").withColumn("page", F.expr("event_id div 100"))
    newest = events.where("ts < '2024-01-15'").groupBy("event_type").agg(F.max("ts").alias("newest"))
    return incremental.page_overlap(events, "event_type", "page", "ts", newest)


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 49)")
def pending_work(spark, directory):
    done = _t(spark, directory, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return incremental.pending(_t(spark, directory, "part"), done, ["p_partkey"], "p_partkey").select("p_partkey")


@query("""select distinct k from (select l_partkey k from lineitem where l_quantity > 49 union all select l_partkey from lineitem where l_returnflag in ('A') or trim(l_returnflag) = '')""")
def completed_keys(spark, directory):
    lines = _t(spark, directory, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("status"), "l_quantity")
    return incremental.completed_keys(lines.where("l_quantity > 49"), lines, "k", "status", ("A",))


@query("""select o_orderkey, o_custkey from (select o_orderkey, nullif(o_custkey, 7) o_custkey from orders) o where o_custkey is null or o_custkey not in (select c_custkey from customer where c_acctbal > 0)""")
def missing_ids(spark, directory):
    orders = _t(spark, directory, "orders").select(F.nullif(F.col("o_custkey"), F.lit(7)).alias("o_custkey"), "o_orderkey")
    return incremental.missing_ids(orders, _t(spark, directory, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


# -- dimensions -------------------------------------------------------------------------
_DIMS = r"""with z0 as (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from zipcode_enrichment where not failed),
    z as (select lpad(d, 8, '0') zip, street, neighbourhood, city, state, source, row_number() over (partition by lpad(d, 8, '0') order by enrichment_id) n from z0 where length(d) between 1 and 8),
    c0 as (select *, regexp_replace(cep, '[^0-9]', '', 'g') d from cepaberto),
    c as (select lpad(d, 8, '0') zip, min(logradouro) street, min(nome_municipio) city, min(sigla_uf) state from c0 where length(d) between 1 and 8 group by 1),
    dim as (select coalesce(z.zip, c.zip) zip, coalesce(case when regexp_matches(z.street, '\S') then z.street end, c.street) street, coalesce(case when regexp_matches(z.city, '\S') then z.city end, c.city) city, coalesce(case when regexp_matches(z.state, '\S') then z.state end, c.state) state,
        array_to_string(list_distinct_ordered, '+') as source from (select * from z where n = 1) z full join c on z.zip = c.zip, lateral (select case when z.source = 'cepaberto' then ['cepaberto'] else list_filter([z.source, case when c.zip is not null then 'cepaberto' end], lambda x: x is not null) end list_distinct_ordered))"""


def _dimension(spark, directory):
    z = _t(spark, directory, "zipcode_enrichment").where(~F.col("failed"))
    base = enrich.first_per_zip(z, "zip_code", "enrichment_id").select(F.col("zip_digits").alias("zip"), "street", "city", "state", "source")
    c = _t(spark, directory, "cepaberto").withColumn("zip", S.zip_digits(F.col("cep"))).where(F.col("zip").isNotNull())
    secondary = c.groupBy("zip").agg(F.min("logradouro").alias("street"), F.min("nome_municipio").alias("city"), F.min("sigla_uf").alias("state")).withColumn("source", F.lit("cepaberto"))
    return enrich.merge_dimensions(base, secondary, "zip", ["street", "city", "state"])


@query(_DIMS + " select zip, street, city, state, source from dim")
def zip_dimension(spark, directory):
    return _dimension(spark, directory).select("zip", "street", "city", "state", "source")


@query(_DIMS + r"""select l.listing_id, case when regexp_matches(l.city, '\S') then l.city else dim.city end city, case when regexp_matches(l.state, '\S') then l.state else dim.state end state, case when regexp_matches(l.address, '\S') then l.address else dim.street end address
    from (select *, regexp_replace(zip_code, '[^0-9]', '', 'g') d from listings) l left join dim on length(l.d) between 1 and 8 and lpad(l.d, 8, '0') = dim.zip""")
def zip_fill(spark, directory):
    rows = _t(spark, directory, "listings").select("listing_id", "zip_code", "city", "state", "address")
    return enrich.fill_missing(rows, "zip_code", _dimension(spark, directory), "zip", {"city": "city", "state": "state", "address": "street"}).select("listing_id", "city", "state", "address")


@query(r"""select enrichment_id, case when regexp_matches(coalesce(street,''), '\S') and regexp_matches(coalesce(neighbourhood,''), '\S') and regexp_matches(coalesce(city,''), '\S') and regexp_matches(coalesce(state,''), '\S')
    then trim(street) || ', ' || trim(neighbourhood) || ', ' || trim(city) || ', ' || trim(state) end q from zipcode_enrichment""")
def geocode_queries(spark, directory):
    return _t(spark, directory, "zipcode_enrichment").select("enrichment_id", enrich.geocode_query("street", "neighbourhood", "city", "state").alias("q"))


@query(r"""select cep, try_cast(nullif(regexp_extract(centroide, 'POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 2), '') as double) lat, try_cast(nullif(regexp_extract(centroide, 'POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 1), '') as double) lon from cepaberto""")
def parse_point(spark, directory):
    lat, lon = S.point(F.col("centroide"))
    return _t(spark, directory, "cepaberto").select("cep", lat.alias("lat"), lon.alias("lon"))


# -- scalar functions ---------------------------------------------------------------------
@query(r"""select c_custkey, try_cast(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') as bigint) digits,
    try_cast(replace(replace('R$ ' || printf('%.2f', c_acctbal), '.', ','), 'R$ ', '') as varchar) as_text, round(c_acctbal, 2) br, c_custkey % 3 = 1 flag from customer where c_custkey % 3 <> 2
    union all select c_custkey, try_cast(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') as bigint), replace(printf('%.2f', c_acctbal), '.', ','), round(c_acctbal, 2), null from customer where c_custkey % 3 = 2""")
def scalar_numbers(spark, directory):
    text = F.replace(F.format_string("%.2f", "c_acctbal"), F.lit("."), F.lit(","))
    word = F.when(F.col("c_custkey") % 3 == 1, " Sim ").when(F.col("c_custkey") % 3 == 0, "não").otherwise("talvez")
    return _t(spark, directory, "customer").select("c_custkey", S.digits_int(F.col("c_name")).alias("digits"), text.alias("as_text"), S.br_float(F.concat(F.lit("R$ "), text)).alias("br"), S.flag(word).alias("flag"))


@query(r"""with d as (select listing_id, regexp_replace(zip_code, '[^0-9]', '', 'g') d, regexp_extract(zip_code, '\b(\d{5}-?\d{3})\b', 1) m from listings)
    select listing_id, case when length(d) between 1 and 8 then lpad(d, 8, '0') end zip_digits, case when m <> '' then left(m, 5) || '-' || right(m, 3) end zip_dashed from d""")
def zip_codes(spark, directory):
    return _t(spark, directory, "listings").select("listing_id", S.zip_digits(F.col("zip_code")).alias("zip_digits"), S.zip_dashed(F.col("zip_code")).alias("zip_dashed"))


@query("""select distinct city, trim(regexp_replace(strip_accents(lower(city)), '[^a-z0-9]+', '-', 'g'), '-') slug from listings where city not like '%�%'""")
def slugs(spark, directory):
    return _t(spark, directory, "listings").where(F.col("city").isNotNull()).select("city", S.slug(F.col("city")).alias("slug")).distinct()


@query("""select listing_id, case when state = 'SP' then 'São Paulo' when coalesce(state,'') <> '' then state when city = 'São Paulo' then 'São Paulo' end state,
    case when lower(property_type) like '%apartamento%' then 'Apartamento' when lower(property_type) like '%casa%' then 'Casa' else nullif(trim(property_type), '') end property_type,
    coalesce(nullif(street,''), nullif(address,'')) address, nullif(concat_ws(chr(10) || chr(10), nullif(condominium_name,''), nullif(address,'')), '') description,
    coalesce(nullif(sale_price_brl, 0), nullif(rent_price_brl, 0), condo_fee_brl) total from listings""")
def listing_projection(spark, directory):
    c = F.col
    return _t(spark, directory, "listings").select("listing_id", S.state_name(c("state"), c("city")).alias("state"), S.property_type(c("property_type")).alias("property_type"), S.pick(c("street"), c("address")).alias("address"), S.compose(c("condominium_name"), c("address")).alias("description"), S.first_nonzero(c("sale_price_brl"), c("rent_price_brl"), c("condo_fee_brl")).alias("total"))


@query(r"""select listing_id, nullif(regexp_extract(listing_url, '/imovel/([^/?#]+)', 1), '') url_id, regexp_matches(listing_url, '/imovel/') is_listing from listings""")
def url_fields(spark, directory):
    return _t(spark, directory, "listings").select("listing_id", S.id_from_url(F.col("listing_url")).alias("url_id"), F.col("listing_url").rlike("/imovel/").alias("is_listing"))


@query(r"""select event_id, strftime(ts, '%Y-%m-%dT') || strftime(ts, '%H:%M') || ':00-03:00' today, strftime(ts - interval 1 day, '%Y-%m-%dT') || strftime(ts, '%H:%M') || ':00-03:00' yesterday, cast(ts as date) lastmod,
    strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') unix from events""")
def dates(spark, directory):
    e = _t(spark, directory, "events").withColumn("hm", F.date_format("ts", "HH:mm"))
    on = F.to_date("ts")
    return e.select("event_id", S.card_date(F.concat(F.lit("Hoje, "), "hm"), on).alias("today"), S.card_date(F.concat(F.lit("Ontem, "), "hm"), on).alias("yesterday"), S.lastmod_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("lastmod"), S.unix_iso(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("unix"))


@query(r"""with h as (select doc_id, '<html><head><title>' || coalesce(source, '') || '</title></head><body><p class="a">' || coalesce(replace(text, '<', ' '), '') || '</p> <b>' || doc_id::varchar || '</b></body></html>' html from documents)
    select doc_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') title, length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) as n_text from h""")
def html_text(spark, directory):
    """Every document with its whole text: a null text is an empty paragraph, a null source a page without title."""
    d = _t(spark, directory, "documents")
    empty = F.lit("")
    html = F.concat(F.lit("<html><head><title>"), F.coalesce("source", empty), F.lit('</title></head><body><p class="a">'), F.coalesce(F.replace("text", F.lit("<"), F.lit(" ")), empty), F.lit("</p> <b>"), F.col("doc_id").cast("string"), F.lit("</b></body></html>"))
    return d.select("doc_id", F.nullif(F.regexp_extract(html, "<title>([^<]*)</title>", 1), empty).alias("title"), F.length(S.strip_tags(html)).cast("bigint").alias("n_text"))


# -- JSON -----------------------------------------------------------------------------------
@query("""select event_type, sum(try_cast(json_extract_string(props, '$.k') as bigint))::bigint total, count(json_extract_string(props, '$.missing')) missing from events group by 1""")
def json_props(spark, directory):
    e = _t(spark, directory, "events")
    return e.groupBy("event_type").agg(F.sum(jsonx.prop(F.col("props"), "$.k").try_cast("bigint")).alias("total"), F.count(jsonx.prop(F.col("props"), "$.missing")).alias("missing"))


@query("""select event_id, json_extract_string(props, '$.k') condo, event_type as by_label, event_type = 'click' as has from events""")
def json_amenities(spark, directory):
    e = _t(spark, directory, "events")
    text = F.concat(F.lit('["x", {"name": "Condominio ", "value": "'), jsonx.prop(F.col("props"), "$.k"), F.lit('"}, {"name": "z", "label": "Andar do imovel", "value": "'), "event_type", F.lit('"}, {"name": "f", "values": [{"label": "'), "event_type", F.lit('"}]}]'))
    items = jsonx.objects(text)
    return e.select("event_id", jsonx.value_of(items, ["condominio"]).alias("condo"), jsonx.value_of(items, ["floor"], "andar").alias("by_label"), jsonx.has_label(items, ["f"], "click").alias("has"))


# -- quality, rejects, sets ---------------------------------------------------------------------
_REASON = "case when coalesce(listing_url,'') = '' then 'missing_url' when coalesce(sale_price_brl, rent_price_brl) is null then 'missing_price' when coalesce(scraped_at,'') = '' then 'missing_date' when not regexp_matches(scraped_at, '^[0-9]{4}-') then 'unparsed_date' end"


@query(f"select {_REASON} invalid_reason, count(*) n from listings group by 1")
def dead_letter(spark, directory):
    c = F.col
    reasons = {"missing_url": S.missing(c("listing_url")), "missing_price": F.coalesce(c("sale_price_brl"), c("rent_price_brl")).isNull(), "missing_date": S.missing(c("scraped_at")), "unparsed_date": ~c("scraped_at").rlike("^[0-9]{4}-")}
    valid, rejected = quality.split_rejects(_t(spark, directory, "listings"), reasons)
    return valid.withColumn("invalid_reason", F.lit(None).cast("string")).unionByName(rejected).groupBy("invalid_reason").agg(F.count("*").alias("n"))


@query("select source, business_type, property_id, count(*) n from listings group by 1, 2, 3 having count(*) > 1")
def duplicate_keys(spark, directory):
    return quality.duplicate_keys(_t(spark, directory, "listings"), snapshot.UPSERT_KEY)


@query("select distinct property_id from listings_unificados where property_id is null or property_id not in (select property_id from listings where property_id is not null)")
def orphan_keys(spark, directory):
    return quality.orphans(_t(spark, directory, "listings_unificados"), _t(spark, directory, "listings"), "property_id", "property_id")


@query("select c_custkey id, c_name as name, c_mktsegment segment, null::integer nation from customer union all select s_suppkey, s_name, null, s_nationkey from supplier")
def union_align(spark, directory):
    c = _t(spark, directory, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, directory, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return normalize.union_all(c, s)


@query("""select (select count(*) from (select property_id from listings union select property_id from listings_unificados)) n_union, (select count(*) from (select property_id from listings intersect select property_id from listings_unificados)) n_both,
    (select count(*) from (select property_id from listings except select property_id from listings_unificados)) n_only""")
def key_sets(spark, directory):
    side = lambda t, n: _t(spark, directory, t).select("property_id", F.lit(n).alias("s"))
    seen = side("listings", 0).unionByName(side("listings_unificados", 1)).groupBy("property_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    return seen.agg(F.count("*").alias("n_union"), F.count_if(F.expr("lo <> hi")).alias("n_both"), F.count_if(F.expr("hi = 0")).alias("n_only"))
