import datetime
import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from terralume.operators import enrich, incremental, latest, quality, resolve
from terralume.operators.history import VersionStore, changed_leaves, tree_depth, version_history
from terralume.operators.proximity import decompose, locate_in_regions, pairs_within
from terralume.plans import normalize, snapshot


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_ties_nulls_and_idempotence(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "2", 2), ("a", "2", 3), (None, "1", 4), ("", "0", 5)], "k string, at string, o int")
    one = latest.latest_per_key(df, ["k"], "at", "o")
    assert rows(one.select("o")) == [(3,), (4,)]
    assert rows(latest.latest_per_key(one, ["k"], "at", "o").select("o")) == [(3,), (4,)]
    assert latest.latest_per_key(df.limit(0), ["k"], "at", "o").count() == 0


def test_numbered(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("x")).repartition(7)
    assert [(r.x, r.n) for r in latest.numbered(df, [F.col("x").desc()], "n").orderBy("n").collect()] == [(499 - i, i + 1) for i in range(500)]
    assert latest.numbered(df.limit(0), [F.col("x").desc()], "n").count() == 0


def test_islands(spark):
    df = spark.createDataFrame([("f", i, s) for i, s in enumerate([1, 1, 0, 1, 1, 1, 1])], "flow string, page int, s int")
    runs = latest.islands(df, "flow", "page", F.col("s") == 1)
    assert rows(latest.stop_position(runs, "flow")) == [("f", 5)]


LISTING = "source string, business_type string, property_id string, listing_url string, city string, neighbourhood string, address string, state string, zip_code string, lat double, lon double, property_type string, condominium_name string, amenities_json string, installations_json string, sale_price_brl bigint, rent_price_brl bigint, area_m2 double, total_area_m2 double, bedrooms bigint, bathrooms bigint, parking_spots bigint, suites bigint, floor bigint, furnished boolean, accepts_pets boolean, scraped_at string, _ord bigint"


def listing(**given):
    names = [c.split()[0] for c in LISTING.split(", ")]
    return tuple(given.get(n) for n in names)


def test_sale_and_rent_rows_are_one_property(spark):
    place = {"source": "quinto", "city": "São Paulo", "neighbourhood": "Moema", "address": "Rua A, 1", "area_m2": 50.5, "bedrooms": 2, "bathrooms": 1}
    df = spark.createDataFrame([listing(**place, business_type="sale", property_id="1", sale_price_brl=1_000_000, scraped_at="2026-01-01", _ord=1), listing(**place, business_type="rent", property_id="2", rent_price_brl=5000, scraped_at="2026-01-02", _ord=2)], LISTING)
    tables = snapshot.snapshot(df)
    p = tables["properties"].collect()
    assert len(p) == 1 and (p[0].sale_price_brl, p[0].rent_price_brl, p[0].listing_mode, p[0].listings_count) == (1_000_000, 5000, "sale_rent", 2)
    assert p[0].canonical_property_id == "são paulo|moema|rua a, 1|50|2|1"  # halves to even
    assert tables["links"].count() == 2
    assert {(r.sale_price_brl, r.rent_price_brl) for r in tables["listings"].collect()} == {(1_000_000, 5000)}


def test_blank_identity_falls_back(spark):
    df = spark.createDataFrame([listing(source="olx", business_type="sale", property_id=i, scraped_at="1", _ord=n) for n, i in enumerate(["a", "b"])], LISTING)
    assert rows(snapshot.unified(df)[1].select("canonical_property_id", "listing_mode")) == [("olx|a", "sale"), ("olx|b", "sale")]


def test_availability_needs_known_source_and_id(spark):
    df = spark.createDataFrame([listing(source=None, business_type="rent", property_id="x", address="a", scraped_at="1", _ord=1), listing(source=None, business_type="sale", property_id="x", address="b", scraped_at="1", _ord=2)], LISTING)
    assert rows(snapshot.unified(df)[0].select("address", "is_for_sale", "is_for_rent")) == [("a", False, True), ("b", True, False)]


def test_upsert_two_days(spark):
    first = spark.createDataFrame([("lopes", "sale", "1", "2026-01-01", 10, 1)], "source string, business_type string, property_id string, scraped_at string, price int, o int")
    empty = first.limit(0)
    day1 = incremental.upsert(empty, first, snapshot.UPSERT_KEY, "scraped_at", "o", F.lit("2026-01-01").cast("timestamp"))
    assert rows(incremental.upsert_counts(empty, first, snapshot.UPSERT_KEY)) == [(1, 0)]
    second = spark.createDataFrame([("lopes", "sale", "1", "2026-01-02", 11, 1), ("lopes", "rent|sale", "1", "2026-01-02", 12, 2), ("lopes", "sale", "9", "2026-01-02", 1, 3)], first.schema)
    day2 = incremental.upsert(day1, second, snapshot.UPSERT_KEY, "scraped_at", "o", F.lit("2026-01-02").cast("timestamp"))
    assert rows(incremental.upsert_counts(day1, second, snapshot.UPSERT_KEY)) == [(2, 1)]
    kept = {(r.business_type, r.property_id): (r.price, r.first_seen_at.day, r.last_seen_at.day) for r in day2.collect()}
    assert kept == {("sale", "1"): (11, 1, 2), ("rent|sale", "1"): (12, 2, 2), ("sale", "9"): (1, 2, 2)}
    late = incremental.upsert(day2, first, snapshot.UPSERT_KEY, "scraped_at", "o", F.lit("2026-01-03").cast("timestamp"))
    assert {(r.business_type, r.property_id): r.price for r in late.collect()}["sale", "1"] == 11  # an older day loses


def test_delta_window(spark):
    d = "2026-04-"
    current = spark.createDataFrame([("old-new", d + "26", 1), ("window-new", d + "27", 2), ("window-new", d + "27", 3), ("known", d + "28", 4), ("changed", d + "29", 5), ("no-lastmod", None, 6)], "url string, lastmod string, o int")
    previous = spark.createDataFrame([("known", d + "28"), ("changed", d + "28")], "url string, previous string")
    wm = spark.createDataFrame([(datetime.date(2026, 4, 28),)], "watermark date")
    out = incremental.classify_delta(current, previous, ["url"], "lastmod", F.to_date("lastmod"), wm, "o")
    assert rows(incremental.change_counts(out)) == [(2, 1, 1, 1)]
    assert [r.url for r in incremental.delta(out).orderBy(*incremental.delta_order("lastmod", "url")).collect()] == ["changed", "window-new", "no-lastmod"]


def test_pending_and_missing(spark):
    work = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, o int")
    done = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows(incremental.pending(work, done, ["k"], "o").select("o")) == [(1,), (4,)]
    assert rows(incremental.missing_ids(work, done, "k").select("o")) == [(1,), (2,), (4,)]
    ledger = spark.createDataFrame([("x", "not_found"), ("y", "error"), ("z", "")], "k string, status string")
    assert rows(incremental.completed_keys(done, ledger, "k", "status")) == [("b",), ("x",), ("z",)]


def test_attach_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    links = spark.createDataFrame([(None, "x"), ("a", "y"), ("a", "y")], "k string, e string")
    assert rows(resolve.attach(left, links, ["k"], "e").select("n", "e")) == [(1, "x"), (2, "y"), (3, None)]


def test_fill_never_overwrites(spark):
    df = spark.createDataFrame([(1, "04000-000", None, " "), (2, "04000000", "Rua B", "X"), (3, "bad", None, None), (4, None, None, None)], "id int, zip string, address string, city string")
    dim = spark.createDataFrame([("04000000", "Rua Teste", "Sao Paulo")], "zip string, street string, town string")
    out = enrich.fill_missing(df, "zip", dim, "zip", {"address": "street", "city": "town"})
    assert rows(out.select("id", "address", "city")) == [(1, "Rua Teste", "Sao Paulo"), (2, "Rua B", "X"), (3, None, None), (4, None, None)]


def test_rejects(spark):
    df = spark.createDataFrame([(None, 1), ("u", None), ("u", 2)], "url string, price int")
    good, bad = quality.split_rejects(df, {"no_url": F.col("url").isNull(), "no_price": F.col("price").isNull()})
    assert rows(good) == [("u", 2)] and rows(bad.select("invalid_reason")) == [("no_price",), ("no_url",)]
    assert rows(quality.row_checks(df.limit(0), {"x": F.col("price") > 0})) == [(0, True)]


def test_normalize_aliases_and_amenities(spark):
    raw = spark.createDataFrame([("7", "olx", "lindo APARTAMENTO", "Rua A", "x", "SP", '[{"name":"size","value":"96"},{"name":"condominio","value":"R$ 1.760"},{"name":"rooms","value":"5 ou mais"}]', "0", "1800", 1)], "ad_id string, source string, property_type string, street string, address string, state string, amenities_json string, sale_price_brl string, rent_price_brl string, _ord bigint")
    r = normalize.normalize(raw, F.lit("2026-01-01")).collect()[0]
    assert (r.property_id, r.address, r.state, r.property_type, r.area_m2, r.total_area_m2, r.condo_fee_brl, r.bedrooms, r.total_price_brl, r.business_type) == ("7", "Rua A", "São Paulo", "Apartamento", 96.0, 96.0, 1760, 5, 1800, "sale")
    assert list(normalize.CANONICAL) == normalize.align(raw).columns and len(normalize.CANONICAL) == 52


def test_history_against_loop(spark):
    rng = random.Random(3)
    data = [(n, rng.choice(["a", "b", None]), datetime.datetime(2026, 1, 1) + datetime.timedelta(hours=rng.randint(0, 900)), rng.choice([100, 100, 200, 0, None]), datetime.datetime(2026, 3, 1) + datetime.timedelta(hours=rng.randint(0, 9))) for n in range(400)]
    df = spark.createDataFrame(data + data[:20], "n bigint, k string, at timestamp_ntz, price bigint, written timestamp_ntz")
    expected = []
    for k in ("a", "b", None):
        best = {}
        for n, key, at, price, written in data:
            if key == k and (at not in best or (written, n) > best[at][0]):
                best[at] = ((written, n), price)
        seen = [(at, p) for at, (_, p) in sorted(best.items()) if p]
        starts = [x for i, x in enumerate(seen) if not i or seen[i - 1][1] != x[1]]
        expected += [(k or "", p, at, starts[i + 1][0] if i + 1 < len(starts) else None) for i, (at, p) in enumerate(starts)]
    for most in (1000, 9, 1):  # crowded periods are sliced, which finds the same
        assert rows(version_history(df, ["k"], "at", "price", "written", "n", F.col("price") > 0, F.date_trunc("week", "at"), most)) == sorted(expected, key=repr)
    assert version_history(df.limit(0), ["k"], "at", "price", "written", "n", F.col("price") > 0, F.date_trunc("week", "at")).count() == 0


def test_leaves_grow_with_keys():
    assert [tree_depth(n) for n in (0, 100, 1000, 100_000, 10**9)] == [1, 1, 2, 4, 7]


def test_version_store_against_a_dictionary(spark, tmp_path):
    rng = random.Random(6)
    store = VersionStore(spark, str(tmp_path / "s"), ["a", "b"], "price", depth=2)
    last, want = {}, []
    prices = {(f"k{i}", None if i % 7 == 0 else "x"): i for i in range(120)}
    for day in range(1, 5):
        for k in rng.sample(sorted(prices, key=repr), 3 if day > 1 else 0):
            prices[k] += 1
        there = {k: v for k, v in prices.items() if rng.random() > (0.02 if day > 1 else 0)}
        at = datetime.datetime(2026, 1, day)
        began = {k: v for k, v in there.items() if last.get(k) != v}
        want += [(k[0], k[1] or "", str(v), at) for k, v in began.items()]
        last |= there
        df = spark.createDataFrame([(*k, v) for k, v in there.items()] + [("gone", "x", None)], "a string, b string, price bigint")
        for _ in range(2 if day == 3 else 1):  # a run that is done again changes nothing
            counts = store.append(df, day, F.lit(at))
        assert counts["versions"] == len(began) and (day == 1 or counts["differing"] < counts["leaves"] / 2)
    assert rows(store.versions().drop("valid_to")) == sorted(want, key=repr)
    assert store.versions().where("valid_to is null").count() == 120
    assert VersionStore(spark, str(tmp_path / "none"), ["a"], "price", 1).versions().count() == 0


def test_changed_leaves(spark):
    df = spark.createDataFrame([(0, i, i * 7, i * 7 + (i in (5, 4000))) for i in range(0, 4096, 5)] + [(0, 4000, 1, 2)], "g int, leaf bigint, before bigint, after bigint").groupBy("g", "leaf").agg(F.bit_xor("before").alias("before"), F.bit_xor("after").alias("after"))
    assert {r.leaf for r in changed_leaves(df, ["g"], "leaf", 3).collect()} == {5, 4000}


def haversine(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))


def test_pairs_within_against_all_pairs(spark):
    rng = random.Random(5)
    centres = [(-23.5, -46.6), (0.0, 179.9999), (0.0, -179.9999), (89.9995, 10.0), (-90.0, 0.0), (60.0, 0.05)]
    points = [(i, c[0] + rng.uniform(-0.003, 0.003), c[1] + rng.uniform(-0.004, 0.004)) for i, c in enumerate(rng.choice(centres) for _ in range(500))]
    points = [(i, max(-90.0, min(90.0, la)), (lo + 180) % 360 - 180) for i, la, lo in points] + [(900, None, 1.0), (901, float("nan"), 1.0), (902, 0.0, 0.0), (903, 91.0, 1.0), (904, -23.5, -46.6), (905, -23.5, -46.6), (905, -23.5, -46.6)]
    df = spark.createDataFrame(points, "id bigint, lat double, lon double").withColumn("metres", F.lit("clash"))
    usable = [p for p in dict.fromkeys(points) if p[1] is not None and p[1] == p[1] and abs(p[1]) <= 90 and (p[1] or p[2])]
    expected = sorted((a[0], b[0]) for a, b in itertools.combinations(sorted(usable), 2) if haversine(a[1:], b[1:]) <= 150)
    assert len(expected) > 500
    for most_points in (20_000, 7):  # crowded cells are shared out, which finds the same
        assert sorted((a, b) for a, b, _ in pairs_within(df, "id", "lat", "lon", 150.0, most_points).collect()) == expected
    assert pairs_within(df.limit(0), "id", "lat", "lon", 150.0).count() == 0


def test_regions_against_ray_casting(spark):
    rng = random.Random(8)
    rings = {"star": [(math.cos(t) * r, math.sin(t) * r) for t, r in ((i * math.pi / 5, 1.0 if i % 2 else 0.4) for i in range(10))], "square": [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5)]}
    points = [(i, rng.uniform(-1.1, 1.1), rng.uniform(-1.1, 1.1)) for i in range(400)]

    def inside(x, y, ring):
        hit = False
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y0 <= y) != (y1 <= y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) <= x:
                hit = not hit
        return hit

    regions = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in r]) for n, r in rings.items()], "region string, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([*points, (999, None, 1.0)], "id bigint, x double, y double")
    want = sorted(((i, n) for i, x, y in points for n, r in rings.items() if inside(x, y, r)), key=repr)
    for slab, most_points in ((0.5, 20_000), (0.13, 5), (40.0, 50)):
        assert rows(locate_in_regions(df, "id", "x", "y", regions, "region", "ring", slab, most_points)) == want
    far = (1 << 62) + 1
    big = spark.createDataFrame([(far, 0.1, 0.1)], "id bigint, x double, y double")
    assert rows(locate_in_regions(big, "id", "x", "y", regions, "region", "ring")) == [(far, "square"), (far, "star")]
    assert locate_in_regions(df, "id", "x", "y", regions.limit(0), "region", "ring").count() == 0


def test_decomposition_covers_the_polygon():
    u = [(0, 0), (5, 0), (5, 3), (4, 3), (4, 1), (1, 1), (1, 3), (0, 3)]  # a polygon with two arms
    rows_ = decompose(np.array([x for x, _ in u], float), np.array([y for _, y in u], float))
    assert len(rows_) == 3 and sum((r[1] - r[0]) * ((r[4] - r[2]) + (r[5] - r[3])) / 2 for r in rows_) == 9.0
