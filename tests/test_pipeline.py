import json

from terralume.plans import pipeline

SITEMAP = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{}</urlset>'


def capture(root, date, links, records):
    folder = root / "captured" / date
    folder.mkdir(parents=True)
    (folder / "quinto.xml").write_text(SITEMAP.format("".join(f"<url><loc>https://h/imovel/{i}/comprar</loc><lastmod>{d}</lastmod></url>" for i, d in links)))
    (folder / "quinto.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records) + "broken\n")


def test_two_days(spark, tmp_path):
    record = {"property_id": "1", "business_type": "sale", "listing_url": "https://h/imovel/1/comprar", "city": "São Paulo", "area": "50", "sale_price_brl": "R$ 1.000.000"}
    capture(tmp_path, "01-01-2026", [(1, "2026-01-01"), (2, "2026-01-01")], [record, record, {"city": "keyless"}])
    first = pipeline.run_all(pipeline.Run(spark, str(tmp_path), "01-01-2026"))
    assert first["status"] == "success", first
    assert [r["step"] for r in first["results"]] == ["discover", "collect", "snapshot", "history"]
    assert first["results"][0]["metrics"]["new_links_total"] == 2 and first["results"][1]["metrics"]["rows_total"] == 1
    assert (first["results"][3]["metrics"]["inserted"], first["results"][3]["metrics"]["updated"]) == (1, 0)

    capture(tmp_path, "02-01-2026", [(1, "2026-01-02"), (2, "2026-01-01"), (3, "2026-01-02")], [record | {"sale_price_brl": "R$ 1.100.000"}, record | {"property_id": "3", "listing_url": "https://h/imovel/3/comprar", "area": "60"}])
    second = pipeline.run_all(pipeline.Run(spark, str(tmp_path), "02-01-2026"))
    assert second["status"] == "success", second
    assert second["results"][0]["metrics"]["quinto"] == {"rows_new": 1, "rows_updated": 1, "rows_unchanged": 1, "rows_filtered": 0}
    assert (second["results"][3]["metrics"]["inserted"], second["results"][3]["metrics"]["updated"]) == (1, 1)
    stored = {r.property_id: (r.sale_price_brl, str(r.first_seen_at)[:10], str(r.last_seen_at)[:10]) for r in spark.read.parquet(str(tmp_path / "history" / "listings")).collect()}
    assert stored == {"1": (1_100_000, "2026-01-01", "2026-01-02"), "3": (1_000_000, "2026-01-02", "2026-01-02")}

    again = pipeline.run_all(pipeline.Run(spark, str(tmp_path), "02-01-2026"))
    assert again["results"][0]["skipped"] and again["results"][3]["metrics"]["inserted"] == 0


def test_gates(spark, tmp_path, capsys):
    run = pipeline.Run(spark, str(tmp_path), "01-01-2026", ["quinto", "QUINTO "])
    assert run.scope == "sources__quinto"
    assert pipeline.run_all(run)["stop_reason"] == "blocked_by_discover"
    assert pipeline.main(["list-steps"]) == 0 and capsys.readouterr().out.split()[-4:] == list(pipeline.STEPS)
