import datetime
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terralume.sources import scans, sinks


def test_csv_is_text_and_na_is_null(spark, tmp_path):
    (tmp_path / "olx_aluguel.csv").write_text('﻿property_id,price,note\n0012,1.5,"a, ""b""\nc"\n,NA,None\n', encoding="utf-8")
    df = scans.read_csv(spark, str(tmp_path / "olx_aluguel.csv"), ["zip"])
    assert df.columns == ["property_id", "price", "note", "zip"]
    assert [tuple(r) for r in df.collect()] == [("0012", "1.5", 'a, "b"\nc', None), (None, None, None, None)]


def test_scan_listings_passes_over_what_is_not_there(spark, tmp_path, capsys):
    (tmp_path / "olx_aluguel.csv").write_text("a\n1\n")
    (tmp_path / "lopes_venda.csv").write_text("b\n2\n")
    (tmp_path / "quinto_x.csv").write_text("b\n")
    (tmp_path / "bad.parquet").write_text("no")
    df = scans.scan_listings(spark, [str(tmp_path / n) for n in ("olx_aluguel.csv", "none.csv", "bad.parquet", "quinto_x.csv", "lopes_venda.csv")])
    assert [(r.a, r.b, r._source, r._business) for r in df.orderBy("_ord").collect()] == [("1", None, "olx", "rent"), (None, "2", "lopes", "sale")]
    assert scans.scan_listings(spark, ["/nope.csv"]) is None
    assert "WARN" in capsys.readouterr().out


def test_jsonl_skips_bad_lines(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"k": "a"}\n\n[1]\n{"k": \n{"k": "b", "z": 1}\n')
    df = scans.read_jsonl(spark, str(tmp_path / "l.jsonl"), T.StructType([T.StructField("k", T.StringType())]))
    assert sorted(r.k for r in df.collect()) == ["a", "b"]


def test_zip_reference_and_cache(spark, tmp_path):
    ref = spark.createDataFrame([("04000000", "Rua Teste", "Moema", "Sao Paulo", "SP", "POINT(-46.6 -23.5)", 1), ("4000-000", "Other", None, None, None, None, 2), ("x", None, None, None, None, None, 3)], "cep string, logradouro string, localidade string, nome_municipio string, sigla_uf string, centroide string, o int")
    assert [tuple(r) for r in scans.zip_reference(ref, "o").collect()] == [("04000000", "Rua Teste", "Moema", "Sao Paulo", "SP", -23.5, -46.6)]
    (tmp_path / "cache.json").write_text(json.dumps({"04000-000": {"street": "a", "lat": "1.5", "failed": False}, "1": 3, "bad": {"street": "b"}, "05000000": {"failed": True}}, indent=2))
    got = {r.zip: (r.street, r.lat, r.failed) for r in scans.zip_cache(spark, str(tmp_path / "cache.json")).collect()}
    assert got == {"04000000": ("a", 1.5, False), "05000000": (None, None, True)}
    (tmp_path / "broken.json").write_text("{")
    assert scans.zip_cache(spark, str(tmp_path / "broken.json")).count() == 0


def test_sitemap(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://h/imovel/1/comprar/ </loc><lastmod>2026-01-01</lastmod></url><url><loc>https://h/imovel/1/comprar/</loc><lastmod>2026-01-05</lastmod></url><url><loc></loc></url><url><loc>https://h/other</loc></url></urlset>')
    df = scans.discovery(scans.read_sitemap(spark, str(tmp_path / "s.xml")), "quinto")
    assert [tuple(r) for r in df.collect()] == [("https://h/imovel/1/comprar/", "1", "sale", "2026-01-05")]


def test_previous_snapshot(tmp_path):
    for day, text in (("01-01-2026", "a\n1\n"), ("02-01-2026", "a\n"), ("03-01-2026", "a\n3\n"), ("notes", "a\n9\n")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "d.csv").write_text(text)
    assert scans.previous_snapshot(str(tmp_path), datetime.date(2026, 1, 3), "d.csv").endswith("01-01-2026/d.csv")
    assert scans.previous_snapshot(str(tmp_path), datetime.date(2026, 1, 1), "d.csv") is None


def test_swap_in_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.createDataFrame([(1, " ")], "a int, b string"), path)
    assert spark.read.parquet(path).collect()[0].b is None
    sinks.swap_in(spark.read.parquet(path).withColumn("a", F.col("a") + 1), path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [2]
    sinks.export_csv_file(spark.read.parquet(path), str(tmp_path / "x.csv"))
    assert (tmp_path / "x.csv").read_bytes() == "﻿a,b\r\n2,\r\n".encode()
    assert scans.read_history(spark, str(tmp_path / "none"), ["a"]).count() == 0
    assert scans.read_history(spark, path, ["a", "z"]).columns == ["a", "z"]
    sinks.write_json({"é": 1}, str(tmp_path / "m.json"))
    assert sinks.read_json(str(tmp_path / "m.json")) == {"é": 1}
