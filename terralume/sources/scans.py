"""Scans: files at rest to frames of text, with their origin."""

from __future__ import annotations

import json
import os
from datetime import date, datetime
from glob import glob

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terralume.functions.scalars import point, zip_digits
from terralume.operators.latest import top_per_key

#: Texts that stand for no value in tables written by dataframe tools.
NA_TOKENS = ["", "#N/A", "#NA", "-NaN", "-nan", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV with header, every column as text (a file's values must not decide each other's types); NA tokens are null."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("inferSchema", False)
    df = reader.csv(path)
    first = df.columns[0] if df.columns else None
    if first and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    df = df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns])
    for c in columns or []:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def source_of_file(name: Column) -> Column:
    """The source that a file is named after: what stands before the first underscore."""
    return F.element_at(F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_"), 1)


def business_of_file(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("aluguel"), "rent").when(low.contains("venda"), "sale")


def scan_listings(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Listing files (CSV, Parquet) of any columns as text, with ``_file``, ``_source``, ``_business`` and ``_ord`` (file, then row).

    Missing, unreadable and empty files are passed over; None if nothing is left.
    """
    parts = []
    for i, path in enumerate(paths):
        if not os.path.exists(path):
            continue
        try:
            df = spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)
            if df.isEmpty():
                continue
        except Exception as failure:  # noqa: BLE001 - an unreadable file is reported, not fatal
            print(f"[WARN] {path}: {type(failure).__name__}")
            continue
        name = F.lit(os.path.basename(path))
        text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        parts.append(text.withColumns({"_file": name, "_source": source_of_file(name), "_business": business_of_file(name), "_ord": F.lit(i).cast("bigint") * (1 << 48) + F.monotonically_increasing_id()}))
    if not parts:
        return None
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def records(spark: SparkSession, batch: str, rows: list[dict]) -> DataFrame | None:
    """Records in memory as a frame of text."""
    columns = sorted({k for r in rows for k in r})
    if not columns:
        return None
    text = [[None if r.get(c) is None else (json.dumps(r[c], ensure_ascii=False) if isinstance(r[c], (dict, list)) else str(r[c])) for c in columns] for r in rows]
    name = F.lit(batch)
    df = spark.createDataFrame([[*t, i] for i, t in enumerate(text)], T.StructType([*text_schema(columns).fields, T.StructField("_ord", T.LongType())]))
    return df.withColumns({"_source": source_of_file(name), "_business": business_of_file(name)})


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines: blank and malformed lines and lines that are no objects are left out."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*\{"))
    return lines.where(F.try_parse_json("value").isNotNull()).select(F.from_json("value", schema).alias("r")).select("r.*")


def zip_reference(df: DataFrame, ordinal: str) -> DataFrame:
    """The zip dimension of a reference table: first row of each code, columns that aren't there are null."""
    for c in ("cep", "logradouro", "localidade", "nome_municipio", "sigla_uf", "centroide"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    lat, lon = point(F.col("centroide"))
    coded = df.withColumn("zip", zip_digits(F.col("cep"))).where(F.col("zip").isNotNull())
    one = top_per_key(coded, ["zip"], [F.col(ordinal).asc()])
    return one.select("zip", F.col("logradouro").alias("street"), F.col("localidade").alias("neighbourhood"), F.col("nome_municipio").alias("city"), F.col("sigla_uf").alias("state"), lat.alias("lat"), lon.alias("lon"))


CACHE_ENTRY = "struct<street:string,neighbourhood:string,city:string,state:string,lat:string,lon:string,source:string,failed:string>"


def zip_cache(spark: SparkSession, path: str) -> DataFrame:
    """A cache file (one JSON object by code) as rows; an unreadable one is empty, entries that are no objects are left out."""
    text = spark.read.text(path, wholetext=True)
    # values as their JSON text: a variant has a largest size, a file of many codes is larger
    entries = text.select(F.explode(F.coalesce(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}), F.create_map().cast("map<string,string>"))).alias("k", "v"))
    parsed = entries.where(F.col("v").startswith("{")).select(zip_digits(F.col("k")).alias("zip"), F.from_json("v", CACHE_ENTRY).alias("e")).where(F.col("zip").isNotNull())
    return parsed.select("zip", "e.street", "e.neighbourhood", "e.city", "e.state", F.col("e.lat").try_cast("double").alias("lat"), F.col("e.lon").try_cast("double").alias("lon"), "e.source", (F.lower("e.failed") == "true").alias("failed"))


def read_history(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A stored table with just these columns; what isn't there is null, and a missing store is empty."""
    if not os.path.exists(path):
        return spark.createDataFrame([], text_schema(columns))
    df = spark.read.parquet(path)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def previous_snapshot(root: str, run: date, name: str) -> str | None:
    """The file ``name`` of the newest run folder (``dd-MM-yyyy``) before ``run`` that holds rows beside its header."""
    dated = []
    for folder in glob(os.path.join(root, "*")):
        try:
            dated.append((datetime.strptime(os.path.basename(folder), "%d-%m-%Y").date(), folder))
        except ValueError:
            continue
    for day, folder in sorted(dated, reverse=True):
        path = os.path.join(folder, name)
        if day < run and os.path.exists(path):
            with open(path, encoding="utf-8-sig") as file:
                next(file, None)
                if any(line.strip(" ,\r\n\"") for line in file):
                    return path
    return None


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """``loc, lastmod`` of a sitemap; entries without location are left out."""
    df = spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)
    return df.select(F.trim("loc").alias("loc"), F.nullif(F.trim("lastmod"), F.lit("")).alias("lastmod")).where(F.col("loc") != "")


def read_sitemap_index(spark: SparkSession, path: str, source: str) -> DataFrame:
    """``loc, lastmod`` of the sitemaps of listings that an index names."""
    df = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string, lastmod string").load(path)
    return df.select(F.trim("loc").alias("loc"), F.nullif(F.trim("lastmod"), F.lit("")).alias("lastmod")).where(F.col("loc").rlike(LISTING_SITEMAPS[source]))


LISTING_SITEMAPS = {"lopes": r"/sitemap-imoveis(-\d+)?\.xml$", "quinto": r"/sitemap-v2-listings-part-\d+\.xml$"}


def discovery(entries: DataFrame, source: str) -> DataFrame:
    """Sitemap entries as discovery records: the newest ``lastmod`` of each URL, the earlier row of equals."""
    from terralume.functions.scalars import business_from_url, id_from_url

    kept = entries.where(F.col("loc").contains("/imovel/")) if source in LISTING_SITEMAPS else entries
    numbered = kept.withColumn("_n", F.monotonically_increasing_id())
    one = top_per_key(numbered, ["loc"], [F.col("lastmod").desc_nulls_last(), F.col("_n").asc()])
    return one.select(F.col("loc").alias("listing_url"), id_from_url(F.col("loc")).alias("listing_id"), business_from_url(F.col("loc")).alias("business_type"), "lastmod")


