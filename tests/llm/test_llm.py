import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terralume.functions.usable import usable_text
from terralume.llm import address_match, byte_bpe, canonical_values, entity_match, entity_vectors, mixing, shared_spans, survivorship
from terralume.llm.addresses import parse


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- survivorship ---------------------------------------------------------------------
def test_survivors_field_by_field(spark):
    df = spark.createDataFrame([("k", 1, 5, "n/d", 3), ("k", 2, 4, "casa", None), ("k", 3, 4, "loft", None), ("k", 4, None, "vila", 9), (None, 5, 9, "x", 1), (None, 6, 9, "x", 1), ("solo", 7, 1, "y", 1), ("k", 1, 5, "n/d", 3)], "key string, id bigint, at int, kind string, spots int")
    fields = {"kind": usable_text(F.col("kind")), "spots": F.col("spots").isNotNull()}
    best = survivorship.survive(df, "key", "id", fields, [F.col("at")])
    assert rows(best) == [("k", 5, "casa", 2, 3, 1)]  # latest usable; equal rows go to the smaller id; null times last
    assert rows(survivorship.survivors_by_field(best, "key", ["kind", "spots"], "id")) == [("k", "kind", 2), ("k", "spots", 1)]
    assert survivorship.survive(df.limit(0), "key", "id", fields, [F.col("at")]).count() == 0


# -- addresses --------------------------------------------------------------------------
SAME = [
    ("Rua Professor Cometa Manso da Nascente, 196", None, "Jardim Turmalina", "Santo Antônio do Josotniga"),
    (None, "R Prof Cometa Manso da Nascente, 196, AP14 - Jardim Turmalina - Santo Antônio do Josotniga - BA", "Jardim Turmalina", "Santo Antônio do Josotniga/BA"),
    (" ", "unidade 13, 196 RUA PROF. COMETA MANSSO DA NASCENTE, Jardim Turmalina, santo antonio do josotniga", "Jardim Turmalina", "santo antonio do josotniga"),
    ("cometa manso da nascente - n° 196 - Jd. Turmalina", "", "Jd. Turmalina", None),
]
OTHER = [("Avenida Professor Cometa Manso da Nascente, 196", None, None, "Santo Antônio do Josotniga"), ("Rua Professor Cometa Manso da Nascente, 197", None, None, "Santo Antônio do Josotniga"), ("Rua Professor Cometa Largo da Nascente, 196", None, None, "Santo Antônio do Josotniga"), ("Rua Professor Cometa Manso da Nascente, 196", None, None, "Ratuzinho"), (None, None, None, None), ("Rua sem número", None, None, "Ratuzinho")]


def test_parse_parts():
    a = parse("RUA Garça Sábio do Relógio 2.290", "RUA Garça Sábio do Relógio 2.290 unidade 14", "Alto Riacho", "São Fubamalândia/SP")
    assert (a.kind, a.name, a.number, a.unit, a.town) == ("rua", ("garca", "sabio", "relogio"), "2290", "14", "sao fubamalandia")
    assert parse(None, "", None, None).name == ()


def test_same_addresses(spark):
    data = [(i, *r) for i, r in enumerate(SAME + OTHER)] + [(100, *SAME[0]), (100, *SAME[0])]
    df = spark.createDataFrame(data, "id bigint, street string, address string, neighbourhood string, city string").withColumn("number", F.lit(1))
    got = {(a, b) for a, b in rows(address_match.same_addresses(df, "id", "street", "address", "neighbourhood", "city"))}
    assert {(0, 1), (0, 2), (1, 2), (0, 3), (1, 3), (1, 100), (2, 100)} <= got
    assert (0, 100) not in got  # written alike
    # row 3 names neither kind nor town, so it doesn't contradict a row of another kind or town
    assert not [p for p in got if set(p) & {4, 5, 6, 7, 8, 9} and 3 not in p] and not [p for p in got if set(p) & {5, 6, 8, 9}]
    assert address_match.same_addresses(df.limit(0), "id", "street", "address", "neighbourhood", "city").count() == 0


def test_bands_against_all_pairs():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgilmnoprstuv") for _ in range(8)) for _ in range(60)]
    names = [tuple(rng.sample(words, 3)) for _ in range(60)]
    typos = [tuple(w[:3] + w[4:] if i == 1 else w for i, w in enumerate(n)) for n in names]
    found = sum(bool(set(address_match.band_keys(a, "7", "ratuzinho")) & set(address_match.band_keys(b, "7", "ratuzino"))) for a, b in zip(names, typos, strict=True))
    assert found >= 0.9 * len(names)
    lost = sum(bool(set(address_match.open_keys(a, "7")) & set(address_match.open_keys(b, "7"))) for a, b in zip(names, typos, strict=True))
    assert lost >= 0.85 * len(names)
    one = set(address_match.band_keys(names[0], "7", "ratuzinho"))
    assert not one & set(address_match.band_keys(names[0], "8", "ratuzinho")) and not one & set(address_match.band_keys(names[0], "7", "fevonema"))


def test_alignment_costs():
    assert address_match.align(("prof", "cometa"), ("professor", "cometa")) < 0.2
    assert address_match.align(("cometa", "manso"), ("cometa", "largo")) > address_match.MOST_COST
    assert address_match.edits("teatro", "teaero") == 1 and address_match.edits("ab", "ba") == 1


# -- entities across sources ------------------------------------------------------------------
def test_entities(spark):
    address = ("Rua Garça Sábio do Relógio, 22", None, "Alto Riacho", "São Fubamalândia")
    typed = (None, "R. Garca Sabbio do Relogio, 22, apto 14 - Alto Riacho - São Fubamalândia - SP", "Alto Riacho", "São Fubamalândia")
    data = [(1, "olx", "a", *address, 70.0, 2, 1, 1, 3), (2, "Quinto ", "b", *typed, 71.0, 2, 1, 1, 3), (3, "quinto", "c", *address, 120.0, 4, 3, 2, 9), (4, "olx", "d", *address, 70.0, 2, 1, 1, 3), (5, None, "e", *address, 70.0, 2, 1, 1, 3), (6, "lopes", "f", None, None, None, None, None, None, None, None, None), (7, "quinto", "b", None, None, "Alto Riacho", None, None, None, None, None, None)]
    schema = "listing_id bigint, source string, property_id string, street string, address string, neighbourhood string, city string, area_m2 double, bedrooms bigint, bathrooms bigint, suites bigint, floor bigint"
    df = spark.createDataFrame(data, schema).withColumns({"condominium_name": F.lit(None).cast("string"), "property_type": F.lit("Casa"), "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    usable = {c: F.col(c).isNotNull() for c in ("area_m2", "bedrooms", "bathrooms", "suites", "floor", "condominium_name", "property_type", "lat", "lon")}
    got = entity_match.match_entities(df, usable)
    assert rows(got.select("listing_id_a", "listing_id_b")) == [(1, 2), (1, 7), (2, 4), (4, 7)]
    assert all(0.5 <= r.confidence <= 1 for r in got.collect())
    assert entity_match.match_entities(df.limit(0), usable).count() == 0


def test_entities_without_house_number(spark):
    numbered, bare = "Rua Igarapé Gentil do Bosque, 22", "R. Igarape Gentil do Bosqe"
    data = [(1, "olx", "a", numbered, "Ratuzinho", 70.0, 2, 1, None, None), (2, "quinto", "b", bare, "Ratuzinho", 71.0, 2, 1, None, None), (3, "lopes", "c", bare, "Ratuzinho", 69.0, 2, 1, -23.5, -46.6), (4, "quinto", "d", bare, "Ratuzinho", 120.0, 2, 1, None, None), (5, "lopes", "e", bare, "Fevonema", 70.0, 2, 1, None, None), (6, "quinto", "f", "Rua Igarapé Gentil do Bosque, 24", "Ratuzinho", 70.0, 2, 1, None, None), (7, "olx", "g", "Rua Garça Sábio do Relógio", "Ratuzinho", 70.0, 2, 1, None, None)]
    schema = "listing_id bigint, source string, property_id string, street string, city string, area_m2 double, bedrooms bigint, bathrooms bigint, lat double, lon double"
    df = spark.createDataFrame(data, schema).withColumns({**{c: F.lit(None).cast("string") for c in ("address", "neighbourhood", "condominium_name", "property_type")}, **{c: F.lit(None).cast("bigint") for c in ("suites", "floor")}})
    usable = {c: F.col(c).isNotNull() for c in ("area_m2", "bedrooms", "bathrooms", "suites", "floor", "condominium_name", "property_type", "lat", "lon")}
    got = entity_match.match_entities(df, usable).select("listing_id_a", "listing_id_b")
    assert rows(got) == [(1, 2), (1, 3), (2, 3), (3, 6)]  # numbers, areas and towns that differ still part, once each


def test_vectors_of_spelling_and_context():
    records = [{"kind": "rua", "name": f"{w} do vale", "number": "1", "town": "ratuzinho", "quarter": "", "area": 70.0, "bedrooms": 2.0, "bathrooms": 1.0, "suites": None, "floor": None, "property_type": "casa"} for w in ("mercado", "bosque", "igarape", "serra") * 20]
    u, trained, seen = entity_vectors.start().copy(), *(np.zeros(entity_vectors.BUCKETS + 1) for _ in range(2))
    frame = pd.DataFrame(records).astype({c: float for c in ("suites", "floor")})
    assert entity_vectors.descend(u, trained, seen, {}, frame, np.random.default_rng(1)) == len(records)
    assert trained.sum() > 0 and not u[-1].any() and np.isfinite(u).all()
    used = np.flatnonzero(seen)
    summed = pd.DataFrame(u[used] * trained[used, None], columns=entity_vectors._COLUMNS).assign(bucket=used, weight=trained[used], seen=seen[used])
    model = entity_vectors.assemble(pd.concat([summed, pd.DataFrame([{"bucket": -1, "weight": float(len(records)), "seen": 0.0}])]).fillna(0.0))
    assert model.likeness("word:mercado", "word:mercdo") > model.likeness("word:mercado", "word:igarape")
    assert model.rarity("word:vale") < model.rarity("word:serra")
    one, other = model.records(pd.concat([frame[:1], frame[:1].assign(area=71.0)], ignore_index=True))
    assert one @ other > 0.9
    nothing = entity_vectors.assemble(pd.DataFrame([], columns=["bucket", "weight", "seen", *entity_vectors._COLUMNS]))
    assert not nothing.records(frame).any()


def test_hyperplane_codes_against_all_pairs():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, entity_vectors.DIM))
    y = x + rng.standard_normal(x.shape) * 0.45  # cosines of about 0.9
    (a, a2), (b, b2) = (entity_match._codes(v, entity_match._PLANES, entity_match.BITS) for v in (x, y))
    met = ((a == b) | (a == b2) | (a2 == b)).any(axis=1)
    assert met.mean() > 0.95
    assert (a[:200] == b[200:]).any(axis=1).mean() < 0.1


def test_calibration_moves_with_its_labels():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, len(entity_match.FEATURES)))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    w = entity_match.calibrate(x, y, np.ones(3000))
    assert abs(w[1] - 2) < 0.3 and abs(w[2]) < 0.3
    assert np.allclose(entity_match.calibrate(x[:0], y[:0], np.ones(0)), list(entity_match.PRIOR.values()))


# -- typed values --------------------------------------------------------------------------------
def test_towns(spark):
    ref = spark.createDataFrame([("Nova Biibicaba", "1", "MG"), ("Biibicaba", "2", "MG"), ("Fevonema", "3", "RJ"), ("Fevonema", "4", "PB"), ("Santo Antônio do Josotinga", "5", "BA"), ("Ratuzinho", "6", "SP"), ("Ratuzinho", "", "SP"), (None, "9", "SP"), ("Ratuzinho", "6", "SP")], "name string, id string, uf string")
    typed = {("N. Biibicaba", None): "1", ("NOVA-BIIBICABA/MG", "MG"): "1", ("biibicaba", ""): "2", ("Fevonema", "Paraíba"): "4", ("RJ - fevonema", None): "3", ("Sto. AntÃ´nio do Josotinga", "BA"): "5", ("Município de Ratuzinho", None): "6", ("Rtauzinho", None): "6", ("Zona Rural", "SP"): "", ("Apibecerana", "SP"): "", ("Nova Biibic", None): "1", ("???", None): ""}
    df = spark.createDataFrame([*typed, ("  ", None), (None, "SP")], "city string, state string").withColumn("id", F.lit("clash"))
    got = {(r.city, r.state): r.id for r in canonical_values.map_to_reference(df, "city", "state", ref, "name", "id", "uf").collect()}
    assert got == typed
    two = canonical_values.map_to_reference(df, "city", "state", ref, "name", "id", "uf").where("namesakes is not null").collect()
    assert not two  # the state tells the two of that name apart
    empty = canonical_values.map_to_reference(df, "city", "state", ref.limit(0), "name", "id", "uf")
    assert {r.id for r in empty.collect()} == {""} and empty.count() == len(typed)


def test_long_words_are_repaired_too(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (38, 40, 41, 44, 60, 90)]

    def edited(w, n):
        for _ in range(n):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :]])
        return w

    tokens = {edited(w, n): w for w in words for n in (0, 1, 2) for _ in range(4)}
    got = canonical_values.repair_tokens(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(w,) for w in words], "word string"))
    assert tokens.items() <= {(r.token, r.word) for r in got.collect()}


def test_namesakes_by_evidence(spark):
    evidence = spark.createDataFrame([("1", "01000-000", "Vila Acaí", -23.0, -46.0), ("2", "89000000", None, -5.0, -40.0), ("2", None, "Centro", None, None)], "id string, zip string, quarter string, lat double, lon double")
    data = [(1, "890-11 000", None, None, None), (2, None, "vila acai", None, None), (3, None, None, -5.5, -40.1), (4, None, None, None, None), (5, "01000111", "Centro", None, None)]
    rows_ = spark.createDataFrame(data, "n bigint, zip string, quarter string, lat double, lon double").withColumn("namesakes", F.array(F.lit("2"), F.lit("1")))
    assert rows(canonical_values.settle_namesakes(rows_, "n", evidence)) == [(1, "2", True), (2, "1", True), (3, "2", True), (4, "1", False), (5, "1", True)]



# -- encoding --------------------------------------------------------------------------------------
PIECES = ["a", "b", "aa", "é", "the", "ing", " ", "\n", "​", "中", "🏠", "0", "12", "_", "<|endoftext|>", "'s", "\xa0", "\t", "ção", "…"]


@pytest.mark.skipif(not byte_bpe.available(), reason="no vocabulary here")
def test_encoding_equals_the_public_library(spark):
    from tokenizers import Tokenizer

    public = Tokenizer.from_file(byte_bpe.DEFAULT_VOCABULARY)
    public.encode_special_tokens = True
    rng = random.Random(2)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["a" * 3000, " " * 999, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit(3))
    got = {r.doc_id: r.ids for r in byte_bpe.encode_column(df, "doc_id", "text").collect()}
    for i, t in enumerate(texts):
        assert got[i] == (public.encode(t, add_special_tokens=False).ids if t else []), repr(t)
    assert public.decode(got[3], skip_special_tokens=False) == texts[3]
    counts = {r.doc_id: r.n_tokens for r in byte_bpe.count_tokens(df.drop("ids"), "text").collect()}
    assert counts == {i: len(x) for i, x in got.items()}


# -- mixing ----------------------------------------------------------------------------------------
def test_water_fill():
    given = mixing.water_fill({"a": 100, "b": 10, "c": 50}, {"a": 1, "b": 1, "c": 1, "d": 2}, {"a": 1, "b": 2, "c": 9, "d": 4}, 150)
    assert given == {"a": 65.0, "b": 20, "c": 65.0, "d": 0.0}
    assert mixing.water_fill({}, {"a": 1}, {"a": 1}) == {"a": 0.0}
    assert mixing.water_fill({"a": 5}, {"a": 1}, {"a": 2}, 99) == {"a": 10}


def test_mix_keeps_caps_and_shares(spark):
    docs = spark.createDataFrame([(i, ["A ", "b", "c", None, "zz"][i % 5], 10 + i % 7) for i in range(2000)] + [(5000, "a", 0), (5001, "a", None), (None, "a", 5)], "id bigint, source string, n bigint")
    targets = spark.createDataFrame([("a", 1.0, 1), ("B", 3.0, 2), ("c", 0.5, 4), ("none", 1.0, 3)], "source string, target_weight double, max_repeats bigint")
    plan, shares = mixing.mix(docs, targets, "id", "source", "n")
    caps = {"a": 1, "b": 2, "c": 4}
    used = plan.collect()
    assert used and all(r.repeats <= caps[r.source] for r in used) and len({r.id for r in used}) == len(used)
    assert abs(sum(r.n_tokens * r.repeats for r in used) - docs.where("source in ('A ', 'b', 'c')").agg(F.sum("n")).collect()[0][0]) < 3 * 20
    by = {r.source: r for r in shares.collect()}
    assert abs(by["a"].actual_share - by["a"].feasible_share) < 0.01 and by["none"].actual_share == 0
    again, _ = mixing.mix(docs.repartition(7), targets, "id", "source", "n")
    assert rows(again) == rows(plan)
    assert mixing.mix(docs.limit(0), targets, "id", "source", "n")[0].count() == 0


# -- shared spans --------------------------------------------------------------------------------------
def brute_spans(docs, n):
    owner = {}
    for i, t in docs:
        for p in range(len(t or "") - n + 1):
            owner.setdefault(t[p : p + n], set()).add(i)
    out = set()
    for i, t in docs:
        start = end = None
        for p in range(len(t or "") - n + 1):
            if len(owner[t[p : p + n]]) > 1:
                if end is not None and p <= end:
                    end = p + n
                else:
                    if end is not None:
                        out.add((i, start, end))
                    start, end = p, p + n
        if end is not None:
            out.add((i, start, end))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_spans_against_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdeé🏠 ") for _ in range(n))
    shared = [word(rng.randint(30, 130)) for _ in range(8)] + ["x" * 90, "ab" * 50]
    docs = [(i, "".join(rng.choice(shared)[rng.randint(0, 20) : rng.randint(25, 130)] if rng.random() < 0.5 else word(rng.randint(0, 40)) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "kurz"), (103, docs[3][1] + docs[4][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("place", F.lit("clash"))
    want = brute_spans(docs, 40)
    for most_blocks in (2048, 5, 1):  # crowded anchors are made longer, which finds the same
        assert rows(shared_spans.shared_spans(df, "doc_id", "text", min_chars=40, anchor_chars=16, most_blocks=most_blocks)) == want


def test_spans_of_nothing(spark):
    df = spark.createDataFrame([(1, "a" * 500), (1, "a" * 500), (2, None)], "doc_id bigint, text string")
    assert shared_spans.shared_spans(df, "doc_id", "text").count() == 0  # only under its own id
    assert shared_spans.shared_spans(df.limit(0), "doc_id", "text").count() == 0
    portions = shared_spans.shared_portion(df, shared_spans.shared_spans(df, "doc_id", "text"), "doc_id", "text")
    assert {r.shared_share for r in portions.collect()} == {0.0}
