"""Card runs, resumable collection, enrichment and streams against small cases worked out by hand."""

import datetime
import json
import os

from pyspark.sql import functions as F

from terralume.functions import markup
from terralume.functions import scalars as S
from terralume.operators import cards, enrich
from terralume.plans import pipeline, resume
from terralume.sources import scans, sinks
from terralume.streaming import delta


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CARD = "flow string, page bigint, position bigint, listing_url string, price_brl bigint, listing_posted_at string, raw_card_date_text string, title string"


def test_card_run(spark):
    stored = spark.createDataFrame([("a", "sale", 1, "2026-04-01T10:00:00-03:00", 1), ("a", "sale", 5, None, 2), ("/venda/b", "x", 7, "2026-04-03T10:00:00-03:00", 3), (" ", "sale", 1, "2026-04-09T10:00:00-03:00", 4)], "listing_url string, business_type string, price_brl bigint, listing_posted_at string, n int")
    prices, flows = cards.card_state(stored, "n")
    assert rows(prices) == [("/venda/b", 7), ("a", 5)]
    assert [(r.flow, r.oldest, r.newest) for r in flows.collect()] == [("sale", datetime.datetime(2026, 4, 1, 13), datetime.datetime(2026, 4, 3, 13))]
    new, old = "2026-04-05T10:00:00-03:00", "2026-04-02T10:00:00-03:00"
    found = [("sale", 1, 0, "a", 5, new, "x", "t"), ("sale", 1, 1, "a", 6, new, "x", "t"), ("sale", 1, 2, "c", 3, new, "x", "t"), ("sale", 1, 3, "/venda/b", 8, old, "x", "t"), ("sale", 1, 4, "", 1, new, "x", "t"), ("sale", 1, 5, "d", None, new, "x", "t"), ("sale", 1, 6, "e", 1, None, "ontem?", "t"), ("sale", 1, 7, "f", 1, None, " ", "t"), ("sale", 1, 8, "g", 1, "no date", "x", "t"), ("rent", 1, 0, "a", 6, old, "x", "t")]
    found += [("sale", p, 0, "a", 5, old, "x", "t") for p in (2, 3, 4)] + [("sale", 5, 0, "late", 1, new, "x", "t")]
    kept, rejected, pages = cards.run_cards(spark.createDataFrame(found, CARD), prices, flows)
    assert rows(kept.select("listing_url", "business_type", "price_brl")) == [("/venda/b", "sale", 8), ("a", "rent", 6), ("c", "sale", 3)]  # the first card of a counts, at its known price; page 5 lies behind the stop
    assert rows(rejected.select("listing_url", "invalid_reason")) == [("d", "missing_price"), ("e", "unparsed_card_date_text"), ("f", "missing_card_date_text"), ("g", "unexpected_invalid_record"), (None, "missing_listing_url")]
    assert rows(pages.where("flow = 'sale'").select("page", "items_kept", "duplicates_in_run", "same_price_ignored", "invalid_records", "useful_overlap", "sterile"))[0] == (1, 2, 1, 1, 5, 1, False)
    assert rows(pages.where("sterile").select("page")) == [(2,), (3,), (4,)]
    nothing = cards.run_cards(spark.createDataFrame([], CARD), prices, flows)
    assert [df.count() for df in nothing] == [0, 0, 0]


def test_breaker(spark):
    seen = [("x", i, s) for i, s in enumerate("ffs-f-fff")] + [("y", 0, "f"), ("y", 1, None), ("y", 2, "f")]
    df = spark.createDataFrame(seen, "label string, i int, status string")
    assert rows(resume.breaker_stop(df, "i", "status", ("f",), ("-",), at_least=3, flow="label")) == [("x", 7)]
    assert resume.breaker_stop(df.limit(0), "i", "status", ("f",), at_least=1).count() == 0


def test_collection_goes_on_where_it_stood(spark, tmp_path):
    records = spark.createDataFrame([(f"k{i}", f"u{i}", f"{i}", "sale", i) for i in range(7)], "key string, listing_url string, property_id string, business_type string, n bigint")
    calls = []

    def fetch(batch):
        keys = [r.key for r in batch.orderBy("n").collect()]
        calls.append(keys)
        status = F.when(F.col("key") == "k1", "not_found").when(F.col("key").isin(*lost), "failed").otherwise("saved")
        out = batch.withColumns({"status": status, "scheduled_index": F.col("n") + 100 * len(calls)})
        return out.where("status = 'saved'").select("key", "listing_url", "property_id", "business_type"), out

    lost = ["k2"]
    saved, metrics = resume.collect_in_batches(spark, records, "key", "n", fetch, str(tmp_path / "r"), "olx", batch_rows=3)
    assert metrics["stop_reason"] == "pending_transient_failures" and metrics["items_kept"] == 5 and metrics["pending_records"] == 1
    assert calls == [["k0", "k1", "k2"], ["k2", "k3", "k4"], ["k2", "k5", "k6"], ["k2"]] and os.path.exists(tmp_path / "r" / "incomplete_records")
    lost.clear()
    saved, metrics = resume.collect_in_batches(spark, records, "key", "n", fetch, str(tmp_path / "r"), "olx", batch_rows=3)
    assert calls[4:] == [["k2"]] and metrics["stop_reason"] == "completed" and metrics["batches_started"] == 5
    assert rows(saved.select("key")) == [("k0",), ("k2",), ("k3",), ("k4",), ("k5",), ("k6",)] and not os.path.exists(tmp_path / "r" / "incomplete_records")
    lost.extend(f"k{i}" for i in range(7))
    assert resume.collect_in_batches(spark, records, "key", "n", fetch, str(tmp_path / "s"), "olx", most_failures=2)[1]["stop_reason"] == "max_consecutive_failures"
    assert resume.restored({"a": 1, "b": 2}, {"a": 5, "z": 3}) == {"a": 5, "b": 2} and resume.restored({"a": 1}, None) == {"a": 1}


DIM = "zip string, street string, neighbourhood string, city string, state string, lat double, lon double, source string"


def test_enrichment(spark):
    listing = "id int, zip_code string, address string, city string, state string, lat double, lon double, neighbourhood string"
    data = [(1, "01000-000", None, None, "SP", None, None, None), (2, "01000000", "own", "own", "own", 1.0, None, None), (3, "02000000", "", "C", "S", 1.0, 2.0, None), (4, "03000000", None, "C", "S", 1.0, 2.0, None), (5, None, None, None, None, None, None, None), (6, "04000000", "a", "C", "S", None, None, None), (7, "05000000", "a", "b", "c", 1.0, 2.0, None), (8, "06000000", None, None, None, None, None, None)]
    cache = spark.createDataFrame([("03000000", None, None, None, None, None, None, "brazilguide", True), ("02000000", "kept", "n", "c", "s", 8.0, 9.0, "x", False), ("06000000", None, None, None, None, None, None, "cepbrasil", True)], DIM + ", failed boolean")
    base = spark.createDataFrame([("01000000", "Rua A", "B", "Town", "SP", None, None, "base_ceps"), ("02000000", "other", "n", "c", "s", 0.0, 0.0, "base_ceps")], DIM)
    second = spark.createDataFrame([("01000000", "Rua Z", "Z", "Z", "Z", -23.0, -46.0, "cepaberto")], DIM)
    fetched = spark.createDataFrame([("06000000", "page", "p", "p", "p", None, None, "brazilguide")], DIM)
    filled, answers, counts = enrich.enrich_listings(spark.createDataFrame(data, listing), cache, base, second, fetched)
    got = {r.id: (r.address, r.city, r.state, r.lat, r.lon) for r in filled.collect()}
    assert got == {1: ("Rua A", "Town", "SP", -23.0, -46.0), 2: ("own", "own", "own", 1.0, -46.0), 3: ("kept", "C", "S", 1.0, 2.0), 4: (None, "C", "S", 1.0, 2.0), 5: (None,) * 5, 6: ("a", "C", "S", None, None), 7: ("a", "b", "c", 1.0, 2.0), 8: ("page", "p", "p", None, None)}
    c = counts.collect()[0].asDict()
    want = {"zip_codes_consulted": 3, "zip_code_cache_hits": 3, "zip_code_address_filled_count": 3, "zip_code_coordinates_filled_count": 2, "zip_code_resolution_failures": 2, "zip_code_base_ceps_hits": 1, "zip_code_cepaberto_hits": 1, "zip_code_brazilguide_requests": 2, "zip_code_brazilguide_successes": 1, "zip_code_brazilguide_failures": 1, "zip_code_negative_cache_hits": 1, "zip_code_geocode_skipped_incomplete_context": 0, "zip_code_geocode_failures": 1}
    assert {k: c[k] for k in want} == want and len(c) == 16
    assert rows(answers.select("zip", "failed")) == [("01000000", False), ("02000000", False), ("03000000", True), ("04000000", True), ("06000000", False)]
    q = spark.createDataFrame([("Rua A", "B", "C", "S", "1"), ("Rua A", " ", "C", "S", "1"), ("Rua A", "B", "C", "S", None)], "a string, b string, c string, d string, z string")
    assert [r[0] for r in q.select(enrich.geocode_queries("a", "b", "c", "d", "z")).collect()] == [["Rua A, B, C, S, 1, Brasil", "Rua A, B, C, S, Brasil"], [], ["Rua A, B, C, S, Brasil"]]


def test_day_of_pages_cards_and_zip_codes(spark, tmp_path):
    folder = tmp_path / "captured" / "01-02-2026"
    folder.mkdir(parents=True)
    (tmp_path / "reference").mkdir()
    (tmp_path / "reference" / "zip_base.csv").write_text("cep,logradouro,localidade,nome_municipio,sigla_uf,centroide\n01310200,Rua Teste,Moema,Sao Paulo,SP,POINT(-46.6 -23.5)\n")
    card = lambda n, price: f'<div class="olx-adcard"><div class="olx-adcard__topbody" data-mode="horizontal"><a href="/venda/imoveis/casa-{n}"><h2>T</h2></a></div><div class="olx-adcard__mediumbody">{price}</div><div class="olx-adcard__bottombody"><p class="olx-adcard__date">Hoje, 10:16</p></div></div>'
    page = '<div class="AdListing_adListContainer__x">' + card(7654321, "R$ 500") + card(7654322, "A combinar") + card(7654323, "R$ 9") + "</div>"
    (folder / "olx_cards.jsonl").write_text(json.dumps({"flow": "sale", "page": 1, "html": page}) + "\n")
    layer = [{"page": {"detail": {"list_id": 7654321, "price": "500", "zipcode": "01310200"}, "adProperties": [{"name": "rooms", "value": "2"}]}}]
    pages = [{"url": f"https://www.olx.com.br/venda/imoveis/casa-{n}", "html": f"<script>window.dataLayer = {json.dumps(layer)};</script>" if n == 7654321 else "<html>", "business_type": "sale"} for n in (7654321, 7654323)]
    (folder / "olx_pages.jsonl").write_text("".join(json.dumps(p) + "\n" for p in pages))
    run = pipeline.Run(spark, str(tmp_path), "01-02-2026", ["olx"])
    done = pipeline.run_all(run)
    assert done["status"] == "success", done
    first = done["results"][0]
    assert first["metrics"]["new_links_total"] == 2 and first["metrics"]["olx"] == {"pages": 1, "items_seen": 3, "items_kept": 2, "duplicates_in_run": 0, "same_price_ignored": 0, "invalid_records": 1}
    assert "missing_price" in open(next(a["path"] for a in first["artifacts"] if a["metadata"]["role"] == "rejects"), encoding="utf-8-sig").read()
    listing = spark.read.parquet(str(tmp_path / "history" / "listings")).collect()
    assert [(r.property_id, r.address, r.city, r.lat, r.bedrooms, r.sale_price_brl) for r in listing] == [("7654321", "Rua Teste", "Sao Paulo", -23.5, 2, 500)]
    assert done["results"][2]["metrics"]["enrichment"]["zip_code_base_ceps_hits"] == 1
    assert "01310200" in (tmp_path / "reference" / "zip_cache.json").read_text() and "check" in open(done["results"][2]["log_path"]).read()
    assert open(os.path.join(run.folder(), "snapshot", "listings.csv"), "rb").read().startswith(b"\xef\xbb\xbfcanonical_property_id,source,")
    assert pipeline.recover(run, "olx") == {"links": 2, "collected": 1, "missing": 1, "recovered": 0}
    (folder / "olx_recovered.jsonl").write_text(json.dumps({"property_id": "7654323", "business_type": "sale", "listing_url": "https://h/casa-7654323"}) + "\n")
    assert pipeline.recover(run, "olx") == {"links": 2, "collected": 1, "missing": 1, "recovered": 1}


def test_texts(spark):
    df = spark.createDataFrame([("&lt;b&gt;Um&nbsp;&amp;  dois</b> ", "1.800", "Aluguel: R$ 2.500, IPTU: R$ 90", "sp"), (None, "TRUE", None, None), ("&nbsp;", "A combinar", "IPTU", "Sergipe")], "html string, price string, text string, uf string")
    got = df.select(markup.clean_text(F.col("html")), markup.clean_description(F.col("html")), S.price(F.col("price")), S.labelled_money(F.col("text"), "iptu"), S.state_slug(F.col("uf")))
    assert [tuple(r) for r in got.collect()] == [("Um & dois", "<b>Um\xa0&  dois</b>", 1, 90, "sao-paulo"), (None, None, None, None, None), (None, None, None, None, "sergipe")]


def test_sinks(spark, tmp_path):
    sinks.write_rejects(spark.createDataFrame([], "flow string, invalid_reason string"), str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_text(encoding="utf-8-sig").strip() == "flow,invalid_reason,listing_url,price_brl,listing_posted_at,raw_card_date_text,title"
    (tmp_path / "i.xml").write_text('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>https://h/sitemap-imoveis-2.xml</loc></sitemap><sitemap><loc>https://h/sitemap-blog.xml</loc></sitemap></sitemapindex>')
    assert rows(scans.read_sitemap_index(spark, str(tmp_path / "i.xml"), "lopes")) == [("https://h/sitemap-imoveis-2.xml", None)]


def test_stream_upsert_writes_touched_buckets_only(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for n, data in enumerate([[(i, "a", 1) for i in range(40)], [(3, "b", 2), (None, "c", 1)], [(3, "old", 1)]]):
        spark.createDataFrame(data, "k int, v string, o int").coalesce(1).write.parquet(f"{source}/{n}")
    for n in range(3):
        stream = spark.readStream.schema("k int, v string, o int").parquet(f"{source}/{n}")
        delta.upsert_stream(stream, f"{target}/t", ["k"], ["o"], f"{target}/state{n}").awaitTermination() if n == 0 else _merge(spark, f"{source}/{n}", f"{target}/t", n)
    got = {r.k: r.v for r in delta.read_upserted(spark, f"{target}/t").collect()}
    assert len(got) == 41 and got[3] == "b" and got[None] == "c" and got[7] == "a"
    assert len([p for p in os.listdir(f"{target}/t/_version=1") if p.startswith("_bucket")]) == 2
    delta.compact(spark, f"{target}/t", 9)
    assert {r.k: r.v for r in delta.read_upserted(spark, f"{target}/t").collect()} == got


def _merge(spark, path, target, batch_id):
    delta.merge_batch(spark.read.parquet(path), target, batch_id, ["k"], ["o"])
