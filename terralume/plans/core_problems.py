"""Core operators over the listing tables: price history and neighbouring points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralume.functions.scalars import point
from terralume.functions.usable import source_name
from terralume.operators.history import version_history
from terralume.operators.proximity import locate_in_regions, pairs_within, usable_point


def _history(spark: SparkSession, directory: str) -> DataFrame:
    seen = spark.read.parquet(f"{directory}/listings_unificados.parquet").where(F.col("property_id").rlike(r"\S")).withColumn("source", source_name(F.col("source")))
    return version_history(seen, ["source", "business_type", "property_id"], "last_seen_at", "price", "updated_at", "row_id", F.col("price") > 0, F.date_trunc("week", "at"))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    return _history(spark, directory).select("source", "business_type", "property_id", F.substring(F.col("valid_from").cast("string"), 1, 19).alias("valid_from"))


def p5_history(spark: SparkSession, directory: str) -> DataFrame:
    """Each version with its price and the period in which it was valid."""
    return _history(spark, directory)


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    return pairs_within(spark.read.parquet(f"{directory}/zipcode_enrichment.parquet"), "enrichment_id", "lat", "lon", 150.0).select("enrichment_id_a", "enrichment_id_b")


def p6_regions(spark: SparkSession, directory: str) -> DataFrame:
    """The surroundings of towns (diamonds of 0.05 degrees around the mean of a town's points) that each point lies in."""
    lat, lon = point(F.col("centroide"))
    towns = spark.read.parquet(f"{directory}/cepaberto.parquet").where(F.col("id_municipio").rlike(r"\S")).groupBy("id_municipio").agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon")).where("lat is not null")
    corners = [F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y")) for dx, dy in ((0.05, 0), (0, 0.05), (-0.05, 0), (0, -0.05))]
    points = spark.read.parquet(f"{directory}/zipcode_enrichment.parquet").where(usable_point(F.col("lat"), F.col("lon")))
    return locate_in_regions(points, "enrichment_id", "lon", "lat", towns.withColumn("ring", F.array(*corners)), "id_municipio", "ring")


QUERIES = {"p5_found": p5_found, "p5_history": p5_history, "p6_found": p6_found, "p6_regions": p6_regions}

ORACLES = {
    "p6_regions": r"""
        with t as (select id_municipio, avg(try_cast(regexp_extract(centroide, 'POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 2) as double)) y, avg(try_cast(regexp_extract(centroide, 'POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 1) as double)) x
            from cepaberto where trim(id_municipio) <> '' group by 1)
        select distinct enrichment_id, id_municipio from zipcode_enrichment z join t on abs(z.lat - t.y) + abs(z.lon - t.x) < 0.05
        where z.lat between -90 and 90 and z.lon between -180 and 180 and not isnan(z.lat) and not isnan(z.lon) and not (z.lat = 0 and z.lon = 0)""",
    "p5_found": """
        with one as (
            select lower(trim(source)) source, business_type, property_id, last_seen_at, price,
                   row_number() over (partition by lower(trim(source)), business_type, property_id, last_seen_at order by updated_at desc, row_id desc) n
            from listings_unificados where trim(property_id) <> ''),
        seen as (
            select *, lag(price) over (partition by source, business_type, property_id order by last_seen_at) earlier
            from one where n = 1 and price > 0)
        select source, business_type, property_id, strftime(last_seen_at, '%Y-%m-%d %H:%M:%S') valid_from
        from seen where earlier is null or earlier <> price""",
    "p5_history": """
        with one as (
            select lower(trim(source)) source, business_type, property_id, last_seen_at, price,
                   row_number() over (partition by lower(trim(source)), business_type, property_id, last_seen_at order by updated_at desc, row_id desc) n
            from listings_unificados where trim(property_id) <> ''),
        seen as (
            select *, lag(price) over (partition by source, business_type, property_id order by last_seen_at) earlier
            from one where n = 1 and price > 0),
        starts as (select * from seen where earlier is null or earlier <> price)
        select source, business_type, property_id, price, last_seen_at as valid_from,
               lead(last_seen_at) over (partition by source, business_type, property_id order by last_seen_at) as valid_to
        from starts""",
    "p6_found": """
        with p as (
            select distinct enrichment_id id, lat, lon, floor((lat + 90) / 0.0027) c from zipcode_enrichment
            where lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) and not (lat = 0 and lon = 0)),
        q as (select id, lat, lon, c + d.d as c from p, (values (-1), (0), (1)) d(d))
        select least(p.id, q.id) enrichment_id_a, greatest(p.id, q.id) enrichment_id_b
        from p join q on p.c = q.c and p.id < q.id
        where 2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) <= 150""",
}
