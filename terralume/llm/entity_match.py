"""Matching entities across sources without keys: skip-gram vectors of a record graph, hyperplane hashing, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.functions.lineage import cut
from terralume.functions.usable import source_name
from terralume.llm import entity_vectors
from terralume.llm.address_match import _mix, stable_hash
from terralume.llm.addresses import parse
from terralume.llm.entity_vectors import Vectors

#: Tables of hyperplanes and bits of each; the bit nearest its plane is also turned over, as a second key of the table.
TABLES, BITS = 6, 8
#: For records without a house number, which have no other part in their keys: fewer tables of more bits.
BARE_TABLES, BARE_BITS = 4, 12
#: Of the bits of all tables, those in which two records of one key may differ (a cosine of 0.5 differs in 16 of 48).
MOST_UNLIKE = 16
#: Cells of coordinates in degrees, on two grids.
CELL = 0.004
#: Areas of one dwelling differ by less than this share.
AREA_TOLERANCE = 0.05
LEAST_CONFIDENCE = 0.6
#: Labelled pairs on which the curve is fitted, in the order of a hash: the same unit, or another one or coordinates far apart.
CALIBRATION_PAIRS = 5000
#: What the curve holds before it has seen labels, and how strongly; it is centred there.
PRIOR = {"bias": -11.0, "record": 2.5, "word": 3.0, "name": 1.5, "town": 4.0, "quarter": 0.7, "area": 1.5, "bedrooms": 1.6, "bathrooms": 1.4, "suites": 1.1, "floor": 2.5, "condominium": 1.0, "property_type": 1.2, "number": 0.5, "kind": 3.0}
PRIOR_WEIGHT = 10.0
#: Log-odds of what the curve doesn't see: a unit that both name (units of one building are dwellings of their own), and coordinates
#: as near as those of one building, or so far apart (degrees) that they are of two.
SAME_UNIT, OTHER_UNIT, NEAR, FAR = 3.0, -12.0, 1.0, -12.0
NEAR_DEGREES, FAR_DEGREES = 0.002, 0.006
#: Pairs far apart are none; one in so many, by hash, goes on as a label.
FAR_SHARE = 16
#: Cosines of names and of towns below which nothing else can make up for the place.
LEAST_NAME, LEAST_TOWN = 0.5, 0.3
NUMBERS = ["bedrooms", "bathrooms", "suites", "floor"]
FEATURES = [f for f in PRIOR if f != "bias"]
ATTRIBUTES = "kind string, name string, number string, unit string, town string, quarter string, area double, bedrooms double, bathrooms double, suites double, floor double, condominium string, property_type string, lat double, lon double"
_NAMES = [a.split()[0] for a in ATTRIBUTES.split(", ")]
_cached_hash = lru_cache(100_000)(stable_hash)
_PLANES = np.random.default_rng(5).standard_normal((TABLES * BITS, entity_vectors.DIM)).astype(np.float32)
_BARE_PLANES = np.random.default_rng(6).standard_normal((BARE_TABLES * BARE_BITS, entity_vectors.DIM)).astype(np.float32)


# -- blocking -----------------------------------------------------------------------
def _codes(vectors: np.ndarray, planes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each table the code of each vector, and the code with the least certain bit turned over."""
    side = (vectors @ planes.T).reshape(len(vectors), -1, bits)
    code = ((side > 0) @ (1 << np.arange(bits))).astype(np.uint64)
    return code, code ^ (np.uint64(1) << np.abs(side).argmin(axis=2).astype(np.uint64))


def _cells(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    lat, lon = frame["lat"].to_numpy(np.float64), frame["lon"].to_numpy(np.float64)
    placed = np.isfinite(lat) & np.isfinite(lon)
    out = []
    for shift in (0.0, 0.5):
        y, x = (np.floor(np.where(placed, v, 0) / CELL + shift).astype(np.int64).astype(np.uint64) for v in (lat, lon))
        out.append((placed, _mix(_mix(y + np.uint64(77 if shift else 78)) ^ x)))
    return out


#: ``sketch`` of a block row: bits 0 to 47 the codes, 48 to 57 the area on a scale of 1 %, 58 a probe, 59 a cell.
_PROBE, _CELL_BIT = np.uint64(1 << 58), np.uint64(1 << 59)


def block_rows(frame: pd.DataFrame, vectors: Vectors, numbered: bool) -> pd.DataFrame:
    """``key, ad, sketch, src`` of each record's buckets.

    A key holds the table and the record's hyperplane code with, for ``numbered`` ones, the house number; or a cell of the
    coordinates with it. Keys of other records, and of all records when they are to meet those, hold no number.
    """
    if not len(frame):
        return pd.DataFrame({"key": np.zeros(0, np.int64), "ad": np.zeros(0, np.int64), "sketch": np.zeros(0, np.int64), "src": np.zeros(0, np.int32)})
    v = vectors.records(frame)
    code, probe = _codes(v, _PLANES, BITS)
    area = frame["area"].to_numpy(np.float64)
    scale = np.where(area > 0, np.clip(np.round(np.log(np.where(area > 0, area, 1)) * 100), 1, 1023), 0).astype(np.uint64)
    sketch = (code << (np.arange(TABLES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64) | (scale << np.uint64(48))
    ad, src = frame["_id"].to_numpy(), np.array([_cached_hash(x) & 0x7FFFFFFF for x in frame["_src"]], np.int32)
    number = np.array([_cached_hash(x) for x in frame["number"]], np.uint64) if numbered else np.zeros(len(frame), np.uint64)
    everyone = np.ones(len(frame), bool)
    rows: list[tuple[np.ndarray, np.ndarray, np.uint64]] = []
    if numbered:
        for t in range(TABLES):
            for codes, mark in ((code, np.uint64(0)), (probe, _PROBE)):
                rows.append((everyone, _mix(number ^ _mix(codes[:, t] + np.uint64(1 + (t << 16)))), mark))
    else:
        bare, _ = _codes(v, _BARE_PLANES, BARE_BITS)
        rows += [(everyone, _mix(bare[:, t] + np.uint64((t + 64) << 16)), np.uint64(0)) for t in range(BARE_TABLES)]
    rows += [(placed, _mix(key ^ number), _CELL_BIT) for placed, key in _cells(frame)]
    return pd.DataFrame({"key": np.concatenate([k[w] for w, k, _ in rows]).view(np.int64), "ad": np.concatenate([ad[w] for w, _, _ in rows]), "sketch": np.concatenate([(sketch | m)[w] for w, _, m in rows]).view(np.int64), "src": np.concatenate([src[w] for w, _, _ in rows])})


def _meet(a: DataFrame, b: DataFrame, once: bool) -> DataFrame:
    """``ad, other`` of two sources that share a key and whose sketches don't rule each other out."""
    a, b = a.alias("a"), b.alias("b")
    bit = lambda n: F.shiftright(F.col("a.sketch").bitwiseAND(F.col("b.sketch")), n).bitwiseAND(F.lit(1)) == 1
    unlike = F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch")).bitwiseAND(F.lit((1 << (TABLES * BITS)) - 1)))
    x, y = (F.shiftright(f"{s}.sketch", 48).bitwiseAND(F.lit(1023)) for s in "ab")
    # a unit that both name may overrule areas, so those are only roughly compared here
    sized = (x == 0) | (y == 0) | (F.abs(x - y) <= 15)
    sources = F.col("a.src") < F.col("b.src") if once else F.col("a.src") != F.col("b.src")
    first = F.col("a.src") < F.col("b.src")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & sources & ~bit(58) & (bit(59) | (unlike <= MOST_UNLIKE)) & sized)
    return pairs.select(F.when(first, F.col("a.ad")).otherwise(F.col("b.ad")).alias("ad"), F.when(first, F.col("b.ad")).otherwise(F.col("a.ad")).alias("other"))


def candidate_pairs(ads: DataFrame, vectors: object) -> DataFrame:
    """``ad, other``, each pair once: records of two sources that share a bucket. ``vectors`` is a broadcast model."""
    columns = ["_id", "_src", "name", "number", "town", "quarter", "area", "bedrooms", "bathrooms", "lat", "lon"]
    schema = "key bigint, ad bigint, sketch bigint, src int"

    def blocks(rows: DataFrame, numbered: bool) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield block_rows(frame, vectors.value, numbered)

        return rows.select(*columns).mapInPandas(run, schema)

    whole, bare = ads.where("number <> ''"), ads.where("number = ''")
    numbered = blocks(whole, True)
    found = _meet(numbered, numbered, True)
    lost = cut(blocks(bare, False))
    if not lost.isEmpty():
        # of the others only rows in a bucket of such a record go on
        sought = lost.select("key").dropDuplicates()
        near = blocks(whole, False).join(sought, "key", "left_semi")
        found = found.unionByName(_meet(lost, lost, True)).unionByName(_meet(lost, near, False))
    return found.dropDuplicates()


# -- comparing -----------------------------------------------------------------------
def name_likeness(a: str, b: str, vectors: Vectors) -> tuple[float, float]:
    """(least, mean) cosine of the words of two names, each with the best of the other's, weighted by rarity.

    The words of the longer name count too: one that the other doesn't have pulls both down, the less the more common it is.
    """
    x, y = a.split(), b.split()
    if not x or not y:
        return 0.5, 0.5
    if a == b and all(vectors.token(f"word:{w}").any() for w in x):
        return 1.0, 1.0
    least, total, weight = 1.0, 0.0, 0.0
    top = max(vectors.rarity(f"word:{w}") for w in x + y) or 1.0
    for own, others in ((x, y), (y, x)):
        for w in own:
            rare = vectors.rarity(f"word:{w}") / top
            like = max(vectors.likeness(f"word:{w}", f"word:{o}") for o in others)
            least = min(least, 1 - rare * (1 - like))
            total, weight = total + rare * like, weight + rare
    return least, total / (weight or 1.0)


def _phrase_likeness(kind: str, a: pd.Series, b: pd.Series, vectors: Vectors) -> np.ndarray:
    """Cosines of phrases; 0.5 where one of them isn't known."""
    x, y = (vectors._sums(kind, s) for s in (a, b))
    norm = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
    cosine = np.einsum("nd,nd->n", x, y) / np.where(norm > 0, norm, 1)
    return np.where(((a != "") & (b != "")).to_numpy(bool), cosine, 0.5)


def features(frame: pd.DataFrame, vectors: Vectors) -> pd.DataFrame:
    """What the curve reads of each pair ``x_*``, ``y_*``: cosines of the vectors, and whether fields agree (1), differ (-1) or aren't known (0)."""
    out: dict[str, np.ndarray] = {}
    x, y = (frame[[f"{s}_{c}" for c in _NAMES]].set_axis(_NAMES, axis=1) for s in "xy")
    out["record"] = np.einsum("nd,nd->n", vectors.records(x), vectors.records(y))
    known: dict[tuple[str, str], tuple[float, float]] = {}
    names = np.empty((len(frame), 2))
    for i, pair in enumerate(zip(x["name"], y["name"], strict=True)):
        got = known.get(pair)
        if got is None:
            got = known[pair] = name_likeness(*pair, vectors)
        names[i] = got
    out["word"], out["name"] = names[:, 0], names[:, 1]
    for kind in ("town", "quarter"):
        out[kind] = _phrase_likeness(kind, x[kind], y[kind], vectors)
    a, b = (s["area"].to_numpy(float) for s in (x, y))
    apart = np.abs(a - b) / np.maximum(np.maximum(a, b), 1e-9)
    out["area"] = np.where((a > 0) & (b > 0), np.where(apart <= AREA_TOLERANCE, 1 - 0.5 * apart / AREA_TOLERANCE, -np.minimum(3.0, apart / AREA_TOLERANCE)), 0.0)
    for c in (*NUMBERS, "condominium", "property_type", "number", "kind", "unit"):
        p, q = x[c], y[c]
        both = (p.notna() & q.notna() & (p != "") & (q != "")).to_numpy(bool)
        out[c] = np.where(both, np.where((p == q).to_numpy(bool), 1.0, -1.0), 0.0)
    far = np.maximum(np.abs(x["lat"].to_numpy(float) - y["lat"].to_numpy(float)), np.abs(x["lon"].to_numpy(float) - y["lon"].to_numpy(float)))
    out["apart"] = np.where(np.isfinite(far), far, -1.0)
    return pd.DataFrame(out)[[*FEATURES, "unit", "apart"]]


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve (the first is the bias) from features and weighted labels, centred on ``PRIOR``: few labels move it little."""
    centre = np.array(list(PRIOR.values()))
    w = centre.copy()
    design = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, len(w)))

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float((weight * np.logaddexp(0, np.where(y > 0, -z, z))).sum() + PRIOR_WEIGHT / 2 * ((w - centre) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + PRIOR_WEIGHT * np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (weight * (y - p)) - PRIOR_WEIGHT * (w - centre))
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-6:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


# -- records ---------------------------------------------------------------------------
def advertisements(df: DataFrame, usable: dict[str, F.Column]) -> DataFrame:
    """One row for each (source, property_id): what its scrapes say together; rows without property_id stand alone.

    Rows without a known source, or with neither place nor shape, are left out.
    """
    source = source_name(F.col("source"))
    place = F.coalesce(F.col("street").rlike(r"\w"), F.lit(False)) | F.coalesce(F.col("address").rlike(r"\w"), F.lit(False)) | F.coalesce(F.col("neighbourhood").rlike(r"\w"), F.lit(False)) | F.coalesce(F.col("city").rlike(r"\w"), F.lit(False))
    shape = F.coalesce(F.col("area_m2") > 0, F.lit(False)) | F.coalesce(F.col("bedrooms") > 0, F.lit(False)) | F.coalesce(F.col("bathrooms") > 0, F.lit(False))
    kept = df.where(source.isNotNull() & (place | shape) & F.col("listing_id").isNotNull())
    own = F.when(F.col("property_id").rlike(r"\S"), F.trim("property_id")).otherwise(F.concat(F.lit("\0"), F.col("listing_id").cast("string")))
    return kept.withColumns({"_src": source, "_ad": F.xxhash64(source, own), **{f"_{k}": F.when(ok, F.col(k)) for k, ok in usable.items()}})


def match_entities(df: DataFrame, usable: dict[str, F.Column], least: float = LEAST_CONFIDENCE) -> DataFrame:
    """``(listing_id_a, listing_id_b, confidence)``, ``a < b``: rows of two known sources that describe one dwelling.

    Scrapes of one (source, property_id) are put together, and advertisements of different sources are matched:

    1. a graph of records, attributes and words; random walks from every record train skip-gram vectors, spelled by q-grams;
    2. blocking by ``TABLES`` tables of hyperplane codes of the record's vector, with the house number in the key, so a bucket is about
       as large as a dwelling has advertisements; cells of the coordinates with the number; longer codes and cells alone for
       advertisements without a number;
    3. exact reranking of each candidate pair: cosines of the records, of their names word by word, of towns and neighbourhoods,
       beside which fields agree;
    4. a logistic curve turns them into a confidence. Its labels are held out from it: pairs that name the same unit of a building,
       against pairs that name another or lie far apart. It is fitted on at most ``CALIBRATION_PAIRS`` of them; units and
       coordinates are then counted as evidence of their own.

    Missing values are no evidence; repeated ids count once; ties don't matter, as each pair is judged alone. An empty
    table gives an empty table.
    """
    return _match(advertisements(df, usable), least)


def _parse_ads(rows: DataFrame) -> DataFrame:
    """Parts of the address and fields of each row, put together by advertisement."""
    texts = ["street", "address", "neighbourhood", "city"]
    narrow = rows.select("_ad", "_src", *[F.col(t).cast("string").alias(t) for t in texts], F.col("_area_m2").alias("area"), *[F.col(f"_{c}").cast("double").alias(c) for c in NUMBERS], F.col("_condominium_name").alias("condominium"), F.lower("_property_type").alias("property_type"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cached = lru_cache(100_000)(parse)
        for frame in frames:
            parts = [cached(*(x if isinstance(x, str) else None for x in t)) for t in zip(*(frame[t] for t in texts), strict=True)]
            out = pd.DataFrame({"_ad": frame["_ad"], "_src": frame["_src"]})
            out["kind"], out["name"], out["number"] = [p.kind for p in parts], [" ".join(p.name) for p in parts], [p.number for p in parts]
            out["unit"], out["town"], out["quarter"] = [p.unit for p in parts], [p.town for p in parts], [p.quarter for p in parts]
            for c in ["area", *NUMBERS, "condominium", "property_type", "lat", "lon"]:
                out[c] = frame[c]
            yield out

    each = narrow.mapInPandas(run, f"_ad bigint, _src string, {ATTRIBUTES}")
    street = F.max(F.struct(F.length("number") > 0, F.length("kind") > 0, F.length("town") > 0, "name", "kind", "number", "town")).alias("s")
    point = F.max(F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon"))).alias("p")
    ads = each.groupBy("_ad", "_src").agg(street, point, *[F.max(c).alias(c) for c in ("unit", "quarter", "area", *NUMBERS, "condominium", "property_type")])
    return ads.select("_ad", "_src", "s.kind", "s.name", "s.number", "unit", "s.town", "quarter", "area", *NUMBERS, "condominium", "property_type", "p.lat", "p.lon")


def _bounded_sample(df: DataFrame, order: F.Column, n: int) -> pd.DataFrame:
    """``n`` rows in the order of a hash, the same at every size. All but about ``4 n`` rows are left out before they are ordered."""
    share = min(1.0, 4 * n / max(1, df.count()))
    thin = df.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    return cut(thin.orderBy(F.pmod(order, F.lit(1 << 30)), *df.columns[:2]).limit(n)).toPandas()


def _possible() -> F.Column:
    """Pairs ``x``, ``y`` that may be one dwelling, and a share of those too far apart for it, as labels."""
    apart = F.greatest(F.abs(F.col("x.lat") - F.col("y.lat")), F.abs(F.col("x.lon") - F.col("y.lon")))
    sized = F.coalesce(F.abs(F.col("x.area") - F.col("y.area")) <= AREA_TOLERANCE * F.greatest("x.area", "y.area"), F.lit(True)) | ((F.col("x.unit") != "") & (F.col("x.unit") == F.col("y.unit")))
    label = F.pmod(F.xxhash64("ad", "other"), F.lit(FAR_SHARE)) == 0
    return sized & (F.coalesce(apart <= FAR_DEGREES, F.lit(True)) | label)


def judged_pairs(ads: DataFrame, vectors: object) -> DataFrame:
    """``ad, other``, the features of each candidate pair, and ``unit``: 1 the same, -1 another, 0 not known."""
    sides = [ads.select(F.col("_id").alias(k), F.struct(*_NAMES).alias(s)) for k, s in (("ad", "x"), ("other", "y"))]
    both = candidate_pairs(ads, vectors).join(sides[0], "ad").join(sides[1], "other").where(_possible())
    flat = both.select("ad", "other", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in _NAMES])

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.concat([frame[["ad", "other"]].reset_index(drop=True), features(frame, vectors.value)], axis=1)

    return flat.mapInPandas(judge, "ad bigint, other bigint, " + ", ".join(f"`{f}` float" for f in [*FEATURES, "unit", "apart"]))


def _match(rows: DataFrame, least: float) -> DataFrame:
    ads = cut(_parse_ads(rows).withColumn("_id", F.monotonically_increasing_id()))
    model = entity_vectors.train(ads, ["kind", "name", "number", "town", "quarter", "property_type", "area", *NUMBERS])
    judged = cut(judged_pairs(ads, ads.sparkSession.sparkContext.broadcast(model)))
    far = F.col("apart") > FAR_DEGREES
    known = judged.agg(F.avg((F.col("unit") != 0).cast("double")).alias("share")).collect()[0]["share"] or 0.0
    labelled = _bounded_sample(judged.where((F.col("unit") != 0) | far), F.xxhash64("ad", "other"), CALIBRATION_PAIRS)
    # pairs labelled by their coordinates alone count as often as pairs that name units are among all
    same = ((labelled["unit"] > 0) & (labelled["apart"] <= FAR_DEGREES)).to_numpy(float)
    weights = calibrate(labelled[FEATURES].to_numpy(float), same, np.where(labelled["unit"] != 0, 1.0, known) * np.where(labelled["apart"] > FAR_DEGREES, FAR_SHARE, 1.0))
    odds = F.lit(float(weights[0]))
    for f, w in zip(FEATURES, weights[1:], strict=True):
        odds = odds + float(w) * F.col(f)
    odds = odds + F.when(F.col("unit") > 0, SAME_UNIT).when(F.col("unit") < 0, OTHER_UNIT).otherwise(0.0)
    odds = odds + F.when(F.col("apart") < 0, 0.0).when(F.col("apart") <= NEAR_DEGREES, NEAR).when(far, FAR).otherwise(0.0)
    # one place: a name and town that may be one, no other kind of street, and areas of one size unless the unit is the same
    one_place = (F.col("name") >= LEAST_NAME) & (F.col("town") >= LEAST_TOWN) & (F.col("kind") >= 0) & ((F.col("area") >= 0) | (F.col("unit") > 0))
    sure = judged.where(one_place).withColumn("confidence", F.round(1 / (1 + F.exp(-odds)), 4)).where(F.col("confidence") >= least).select("ad", "other", "confidence")
    names = ads.select("_id", "_ad")
    sure = sure.join(names.select(F.col("_id").alias("ad"), F.col("_ad").alias("x")), "ad").join(names.select(F.col("_id").alias("other"), F.col("_ad").alias("y")), "other").select("x", "y", "confidence")
    members = rows.select("listing_id", "_ad").dropDuplicates()
    left, right = members.select(F.col("listing_id").alias("p"), F.col("_ad").alias("x")), members.select(F.col("listing_id").alias("q"), F.col("_ad").alias("y"))
    found = sure.join(left, "x").join(right, "y")
    return found.select(F.least("p", "q").alias("listing_id_a"), F.greatest("p", "q").alias("listing_id_b"), "confidence")
