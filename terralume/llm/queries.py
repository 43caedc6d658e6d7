"""The queries of the subpackage over the listing and document tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralume.functions.instants import parse_instant
from terralume.functions.lineage import cut
from terralume.functions.scalars import point
from terralume.functions.usable import PLACEHOLDER_WORDS, source_name, usable_amount, usable_count, usable_text, usable_zip
from terralume.llm import address_match, byte_bpe, canonical_values, entity_match, mixing, shared_spans, survivorship

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


# -- 1: best representative of each duplicate group ---------------------------
FOUND_FIELDS = ["property_type", "zip_code", "parking_spots", "sale_price_brl", "rent_price_brl", "condo_fee_brl", "condominium_name"]
RECORD_FIELDS = ["city", "neighbourhood", "address", "street", "state", "lat", "lon", "area_m2", "total_area_m2", "bedrooms", "bathrooms", "suites", "floor", "furnished", "accepts_pets", "iptu_brl", "amenities_json", "installations_json"]


def _usable(field: str) -> F.Column:
    c = F.col(field)
    if field == "zip_code":
        return usable_zip(c)
    if field.endswith("_brl"):
        return usable_amount(c)
    if field in ("parking_spots", "bedrooms", "bathrooms", "suites"):
        return usable_count(c)
    if field in ("area_m2", "total_area_m2"):
        return c > 0
    if field in ("lat", "lon"):
        return (F.abs("lat") <= 90) & (F.abs("lon") <= 180) & ((F.col("lat") != 0) | (F.col("lon") != 0))
    if field in ("floor", "furnished", "accepts_pets"):
        return c.isNotNull() if field != "floor" else usable_count(c)
    return usable_text(c)


def _trusted(spark: SparkSession, directory: str) -> tuple[DataFrame, list[F.Column]]:
    """Listings with the order in which their values are trusted: instant, then rank of the source."""
    listings = _read(spark, directory, "listings").withColumn("_source", source_name(F.col("source")))
    trust = _read(spark, directory, "source_trust").select(source_name(F.col("source")).alias("_source"), "trust_rank").groupBy("_source").agg(F.min("trust_rank").alias("trust_rank"))
    rank = F.when(F.col("_source").isNull(), 1 << 40).otherwise(F.coalesce(F.col("trust_rank"), F.lit(1 << 39)))
    return listings.join(trust, "_source", "left"), [F.unix_micros(parse_instant(F.col("scraped_at"))), -rank]


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    listings, order = _trusted(spark, directory)
    best = survivorship.survive(listings, "canonical_property_id", "listing_id", {f: _usable(f) for f in FOUND_FIELDS}, order, values=False)
    return survivorship.survivors_by_field(best, "canonical_property_id", FOUND_FIELDS, "listing_id")


def p1_records(spark: SparkSession, directory: str) -> DataFrame:
    """The surviving record of every group, single rows too."""
    listings, order = _trusted(spark, directory)
    fields = FOUND_FIELDS + RECORD_FIELDS
    best = survivorship.survive(listings, "canonical_property_id", "listing_id", {f: _usable(f) for f in fields}, order, least_rows=1)
    return best.select("canonical_property_id", F.col("n_rows").alias("listings_count"), *fields)


# -- 2: same address written differently --------------------------------------
def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return address_match.same_addresses(_read(spark, directory, "listings"), "listing_id", "street", "address", "neighbourhood", "city")


# -- 3: matching entities across sources ---------------------------------------
def _matched(spark: SparkSession, directory: str) -> DataFrame:
    fields = ["area_m2", "bedrooms", "bathrooms", "suites", "floor", "condominium_name", "property_type", "lat", "lon"]
    return entity_match.match_entities(_read(spark, directory, "listings"), {f: _usable(f) for f in fields})


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    return _matched(spark, directory).select("listing_id_a", "listing_id_b")


def p3_confidence(spark: SparkSession, directory: str) -> DataFrame:
    """The same pairs with their confidence."""
    return _matched(spark, directory)


# -- 4: mapping typed towns to the reference list -----------------------------
def _typed_towns(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(distinct typed towns that no one town's name is, with their rows counted; what they map to)."""
    towns = _read(spark, directory, "cepaberto")
    unique = canonical_values.exact_names(towns, "nome_municipio", "id_municipio").select(F.col("nome_municipio").alias("city"))
    typed = _read(spark, directory, "listings").groupBy("city", "state").agg(F.count("*").alias("n_rows"))
    typed = cut(typed.where(F.col("city").rlike(r"\S")).join(unique, "city", "left_anti"))
    return typed, cut(canonical_values.map_to_reference(typed, "city", "state", towns, "nome_municipio", "id_municipio", "sigla_uf"))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    mapped = _typed_towns(spark, directory)[1].withColumnsRenamed({"city": "c", "state": "s"})
    fields = [F.col("zip_code").alias("zip"), F.col("neighbourhood").alias("quarter"), F.when(_usable("lat") & ~F.isnan("lat"), F.col("lat")).alias("lat"), F.when(_usable("lon") & ~F.isnan("lon"), F.col("lon")).alias("lon")]
    rows = _read(spark, directory, "listings").select("listing_id", "city", "state", *fields)
    both = rows.join(mapped, (rows["city"] == mapped["c"]) & rows["state"].eqNullSafe(mapped["s"]))
    lat, lon = point(F.col("centroide"))
    evidence = _read(spark, directory, "cepaberto").select(F.col("id_municipio").alias("id"), F.col("cep").alias("zip"), F.col("localidade").alias("quarter"), lat.alias("lat"), lon.alias("lon"))
    settled = canonical_values.settle_namesakes(both.where("namesakes is not null"), "listing_id", evidence)
    return both.where("namesakes is null").select("listing_id", "id_municipio").unionByName(settled.select("listing_id", F.col("id").alias("id_municipio")))


def p4_unmatched(spark: SparkSession, directory: str) -> DataFrame:
    """Typed values that are no town of the reference list, with their rows."""
    typed, mapped = _typed_towns(spark, directory)
    none = mapped.where("id_municipio = ''").select("city").dropDuplicates()
    return typed.join(none, "city", "left_semi").groupBy("city").agg(F.sum("n_rows").alias("n_rows"))


def p4_ambiguous(spark: SparkSession, directory: str) -> DataFrame:
    """Typed values that several towns bear where the state doesn't tell which, with those towns and the rows."""
    typed, mapped = _typed_towns(spark, directory)
    open_ = mapped.where("namesakes is not null").select("city", "state", "namesakes")
    return typed.join(open_.withColumnsRenamed({"city": "c", "state": "s"}), (F.col("city") == F.col("c")) & F.col("state").eqNullSafe(F.col("s"))).select("city", "state", "n_rows", F.array_join("namesakes", "|").alias("namesakes"))


def _vocabulary(spark: SparkSession) -> str:
    """The vocabulary file, on every worker; the session's ``terralume.vocabulary`` names another one."""
    return spark.conf.get("terralume.vocabulary", byte_bpe.DEFAULT_VOCABULARY)


# -- 7: encoding of the whole corpus ------------------------------------------
def p7_ids(spark: SparkSession, directory: str) -> DataFrame:
    return byte_bpe.encode_column(_read(spark, directory, "documents"), "doc_id", "text", vocabulary=_vocabulary(spark))


# -- 8: mixing sources --------------------------------------------------------
def _mixed(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    sized = byte_bpe.count_tokens(_read(spark, directory, "documents").select("doc_id", "source", "text"), "text", vocabulary=_vocabulary(spark))
    return mixing.mix(sized, _read(spark, directory, "mix_targets"), "doc_id", "source", "n_tokens")


def p8_mix(spark: SparkSession, directory: str) -> DataFrame:
    return _mixed(spark, directory)[0]


def p8_shares(spark: SparkSession, directory: str) -> DataFrame:
    return _mixed(spark, directory)[1]


# -- 9: long exact spans ------------------------------------------------------
def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    return shared_spans.shared_spans(_read(spark, directory, "documents"), "doc_id", "text")


def p9_portions(spark: SparkSession, directory: str) -> DataFrame:
    """How much of each document is found elsewhere."""
    documents = _read(spark, directory, "documents").select("doc_id", "text")
    return shared_spans.shared_portion(documents, shared_spans.shared_spans(documents, "doc_id", "text"), "doc_id", "text")


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found, "p1_records": p1_records,
        "p2_found": p2_found,
        "p3_found": p3_found, "p3_confidence": p3_confidence,
        "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p4_ambiguous": p4_ambiguous,
        "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares,
        "p9_found": p9_found, "p9_portions": p9_portions,
    }


_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in PLACEHOLDER_WORDS)
_TEXT = r"""coalesce(length({w}) > 0 and {w} not in (""" + _WORDS + r""") and not regexp_full_match({w}, 'x{{2,}}|z{{2,}}'), false)"""
_BARE = r"regexp_replace(strip_accents(lower({c})), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"
_AMOUNT = r"coalesce({c} > 1 and length(replace({c}::varchar, left({c}::varchar, 1), '')) > 0 and {c}::varchar not in ('12345','123456','1234567','12345678','123456789','1234567890'), false) or coalesce({c} > 1 and {c} < 10000 and length(replace({c}::varchar, left({c}::varchar, 1), '')) = 0, false)"


_NINES = "coalesce({c} >= 0 and not regexp_full_match({c}::varchar, '9{{2,}}'), false)"


def _usable_sql(field: str) -> str:
    if field == "zip_code":
        return r"coalesce(regexp_full_match(regexp_replace(zip_code, '[\s.\-]', '', 'g'), '\d{8}') and length(replace(regexp_replace(zip_code, '[\s.\-]', '', 'g'), left(zip_code, 1), '')) > 0, false)"
    if field in ("parking_spots", "bedrooms", "bathrooms", "suites", "floor"):
        return _NINES.format(c=field)
    if field.endswith("_brl"):
        return _AMOUNT.format(c=field)
    if field in ("area_m2", "total_area_m2"):
        return f"coalesce({field} > 0 or isnan({field}), false)"
    if field in ("lat", "lon"):
        return "coalesce(abs(lat) <= 90 and abs(lon) <= 180 and (lat <> 0 or lon <> 0), false)"
    if field in ("furnished", "accepts_pets"):
        return f"({field} is not null)"
    return _TEXT.format(w=_BARE.format(c=field))


_INSTANT = r"""case when regexp_full_match(s, '\d{1,11}') then cast(s as bigint) * 1000000
        when regexp_matches(s, '^\d{2}/') then epoch_us(try_strptime(s, '%d/%m/%Y %H:%M:%S')) + 10800000000
        when regexp_matches(s, '(Z|[+-]\d{2}:\d{2})$') and regexp_matches(s, '^\d{4}-\d{2}-\d{2}T') then epoch_us(try_cast(left(regexp_replace(s, '(Z|[+-]\d{2}:\d{2})$', ''), 26) as timestamp)) - case when s like '%Z' then 0 else (case when regexp_matches(s, '-\d{2}:\d{2}$') then -1 else 1 end) * (cast(left(right(s, 5), 2) as bigint) * 60 + cast(right(s, 2) as bigint)) * 60000000 end
        when regexp_matches(s, '^\d{4}-\d{2}-\d{2}[ T]') then epoch_us(try_cast(s as timestamp)) + 10800000000 end"""


def _ranked_sql(fields: list[str], least: int) -> str:
    """Rows in the order of trust, with a flag for each usable field, of groups of at least ``least`` rows."""
    flags = ", ".join(f"({_usable_sql(f)}) as u_{f}" for f in fields)
    many = " + ".join(f"u_{f}::int" for f in fields)
    return f"""l as (select *, trim(scraped_at) s, nullif(lower(trim(source)), '') src, {flags} from listings where canonical_property_id is not null),
        timed as (select l.*, {_INSTANT} ts, {many} many, case when src is null then 99 else coalesce(t.trust_rank, 98) end rk from l left join source_trust t on l.src = lower(trim(t.source))),
        ranked as (select * from (select *, count(*) over (partition by canonical_property_id) n from timed) where n >= {least})"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can say: survivors and shared spans. The rest is tested against brute force, a public library or held-out cases."""
    order = "order by ts desc nulls last, rk, many desc, listing_id"
    picked = " union all ".join(f"select canonical_property_id, '{f}' field_name, first(listing_id {order}) listing_id from ranked where u_{f} group by 1" for f in FOUND_FIELDS)
    every = FOUND_FIELDS + RECORD_FIELDS
    values = ", ".join(f"first({f} {order}) filter (where u_{f}) as {f}" for f in every)
    spans = """w as (select doc_id, i, substring(text, i::bigint + 1, 200) t from (select distinct doc_id, text from documents where length(text) >= 200), lateral (select unnest(range(0, length(text) - 199)) i)),
        hit as (select w.doc_id, w.i from w join (select t from w group by t having count(distinct doc_id) > 1) g on w.t = g.t group by 1, 2),
        r as (select doc_id, i, case when i <= max(i) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) + 200 then 0 else 1 end fresh from hit),
        u as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) run from r), found as (select doc_id, min(i) span_start, max(i) + 200 span_end from u group by doc_id, run)"""
    return {
        "p1_found": f"with {_ranked_sql(FOUND_FIELDS, 2)} {picked}",
        "p1_records": f"with {_ranked_sql(every, 1)} select canonical_property_id, count(*) as listings_count, {values} from ranked group by 1",
        "p9_found": f"with {spans} select doc_id, span_start::bigint span_start, span_end::bigint span_end from found",
        "p9_portions": f"with {spans}, c as (select doc_id, sum(span_end - span_start) shared_chars, count(*) n_spans from found group by 1) select d.doc_id, coalesce(length(text), 0) n_chars, coalesce(shared_chars, 0)::bigint shared_chars, coalesce(n_spans, 0) n_spans, case when coalesce(length(text), 0) > 0 then round(coalesce(shared_chars, 0) / length(text), 6) else 0.0::double end shared_share from documents d left join c on d.doc_id = c.doc_id",
    }
