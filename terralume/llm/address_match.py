"""Same postal address written differently: MinHash banding, then affine-gap token alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.functions.lineage import cut
from terralume.llm.addresses import _TITLE_OF, TITLES, parse

#: Bands of two rows of the street's name and one of the town's: spellings that share two thirds of either are missed once in a hundred.
BANDS, ROWS = 16, 2
#: Bands by which addresses that name no town meet the others.
OPEN_BANDS, OPEN_ROWS = 10, 2
Q = 3
#: Costs of the alignment, and the most that one building's spellings may cost.
GAP_OPEN, GAP_MORE, TITLE_GAP, MOST_COST = 1.0, 0.6, 0.2, 0.8
_WORDS_64 = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, BANDS * (ROWS + 1) + OPEN_BANDS * OPEN_ROWS + 1, dtype=np.uint64) * _WORDS_64)


def stable_hash(text: str) -> int:
    """FNV-1a: the same on every machine."""
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


@lru_cache(100_000)
def _token_minima(token: str, q: int = Q) -> np.ndarray:
    """MinHash values of a token's shingles: itself and its q-grams."""
    padded = f"^{token}$"
    grams = {token, *(padded[i : i + q] for i in range(max(1, len(padded) - q + 1)))}
    hashes = np.array([stable_hash(g) for g in grams], np.uint64)
    return _mix(hashes[:, None] ^ _SEEDS[None, :]).min(axis=0)


@lru_cache(100_000)
def _minima(text: str, q: int = Q) -> np.ndarray:
    return np.minimum.reduce([_token_minima(t, q) for t in text.split()])


def _fold(base: np.ndarray, low: np.ndarray) -> np.ndarray:
    key = _mix(base * _WORDS_64)
    for r in range(low.shape[1]):
        key = _mix(key ^ low[:, r])
    return key.view(np.int64)


def band_keys(name: tuple[str, ...], number: str, town: str) -> np.ndarray:
    """One key for each band: minima of the name and of the town, and the house number, which must agree."""
    low, of_town = _minima(" ".join(name)), _minima(town, 2)  # towns of one word have few shingles: shorter ones bear more typos
    n = BANDS * ROWS
    both = np.concatenate([low[:n].reshape(BANDS, ROWS), of_town[n : n + BANDS, None]], axis=1)
    return _fold(np.uint64(stable_hash(number)) + np.arange(BANDS, dtype=np.uint64), both)


def open_keys(name: tuple[str, ...], number: str) -> np.ndarray:
    """Keys that hold no town."""
    low = _minima(" ".join(name))[BANDS * (ROWS + 1) :].reshape(OPEN_BANDS, OPEN_ROWS)
    return _fold(np.uint64(stable_hash(number)) + np.arange(1000, 1000 + OPEN_BANDS, dtype=np.uint64), low)


@lru_cache(400_000)
def edits(a: str, b: str, most: int = 4) -> int:
    """Edit distance in which two neighbouring letters that change places count once; ``most`` + 1 if above."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def substitution(a: str, b: str) -> float:
    """0 for equal tokens, little for an abbreviation and its word, the share of edited letters otherwise; 1 is another word."""
    if a == b:
        return 0.0
    if _TITLE_OF.get(a, a) == _TITLE_OF.get(b, b) or a in TITLES.get(b, ()) or b in TITLES.get(a, ()):
        return 0.05
    if a in TITLES and b in TITLES:
        return 1.0 if edits(a, b) > 2 else 0.2
    short, long = sorted((a, b), key=len)
    if len(short) == 1 and long.startswith(short):
        return 0.3
    d = edits(a, b)
    return 1.0 if d > max(1, len(long) // 3) else 0.9 * d / len(long) + 0.05


def align(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Cost of the best alignment of two lists of tokens with affine gaps; a gap of one title is cheap."""
    if a == b:
        return 0.0
    inf, n, m = 1e9, len(a), len(b)
    M = [[inf] * (m + 1) for _ in range(n + 1)]
    X = [[inf] * (m + 1) for _ in range(n + 1)]
    Y = [[inf] * (m + 1) for _ in range(n + 1)]
    M[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                M[i][j] = min(M[i - 1][j - 1], X[i - 1][j - 1], Y[i - 1][j - 1]) + substitution(a[i - 1], b[j - 1])
            if i:
                X[i][j] = min(min(M[i - 1][j], Y[i - 1][j]) + (TITLE_GAP if a[i - 1] in TITLES else GAP_OPEN), X[i - 1][j] + GAP_MORE)
            if j:
                Y[i][j] = min(min(M[i][j - 1], X[i][j - 1]) + (TITLE_GAP if b[j - 1] in TITLES else GAP_OPEN), Y[i][j - 1] + GAP_MORE)
    return min(M[n][m], X[n][m], Y[n][m])


@lru_cache(200_000)
def same_town(a: str, b: str) -> float:
    """1: the same town, 0: another one, between: one of them isn't known."""
    if not a or not b:
        return 0.5
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 6 and long.startswith(short) and len(long) - len(short) <= 5 and " " not in long[len(short) :].strip():
        return 1.0
    x, y = a.split(), b.split()
    if len(x) == len(y):
        cost = [0 if p == q or (p[0] == q[0] and min(len(p), len(q)) <= 3 and (p.startswith(q) or q.startswith(p))) else edits(p, q, 3) for p, q in zip(x, y, strict=True)]
        return 1.0 if all(c <= max(1, min(3, max(len(p), len(q)) // 3)) for c, p, q in zip(cost, x, y, strict=True)) else 0.0
    if len(x) != len(y):
        few, many = sorted((x, y), key=len)
        last, its = few[-1], many[len(few) - 1]
        cut_off = last in ("do", "da", "dos", "de") or (last != its and its.startswith(last))
        if cut_off and all(edits(p, q, 3) <= max(1, len(q) // 4) for p, q in zip(few[:-1], many, strict=False)):
            return 1.0
    return 1.0 if edits(a.replace(" ", ""), b.replace(" ", ""), 3) <= 2 else 0.0


@lru_cache(200_000)
def same_quarter(a: str, b: str) -> bool | None:
    """Whether two neighbourhoods are one; None if one of them isn't known."""
    if not a or not b:
        return None
    if a == b or a.split()[-1] == b.split()[-1]:
        return True
    return edits(a, b, 3) <= max(1, min(3, min(len(a), len(b)) // 4)) or edits(a.split()[-1], b.split()[-1], 2) <= 2


def same_building(a: dict, b: dict) -> bool:
    """Kind, name, number and town agree as far as both say them; without a town on one side the neighbourhood must not contradict."""
    if a["number"] != b["number"] or (a["kind"] and b["kind"] and a["kind"] != b["kind"]):
        return False
    town = same_town(a["town"], b["town"])
    if town == 0:
        return False
    if town < 1 and same_quarter(a["quarter"], b["quarter"]) is False:
        return False
    return align(tuple(a["name"].split()), tuple(b["name"].split())) <= MOST_COST


PARSED = "row bigint, text bigint, form bigint, kind string, name string, number string, unit string, town string, quarter string"


def parse_rows(df: DataFrame, row_id: str, street: str, address: str, neighbourhood: str, city: str) -> DataFrame:
    """Each row's parts, the hash of its four texts as written, and the hash of its parts without the unit."""
    texts = [F.col(c).cast("string").alias(n) for c, n in ((street, "street"), (address, "address"), (neighbourhood, "neighbourhood"), (city, "city"))]
    narrow = df.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("bigint").alias("row"), F.xxhash64(*[F.coalesce(t, F.lit("\0")) for t in texts]).alias("text"), *texts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, tuple] = {}
        for frame in frames:
            out = []
            if len(known) > 200_000:
                known.clear()
            for text, *parts in zip(frame["text"], frame["street"], frame["address"], frame["neighbourhood"], frame["city"], strict=True):
                got = known.get(text)
                if got is None:
                    p = parse(*(x if isinstance(x, str) else None for x in parts))
                    name, quarter = " ".join(p.name), p.quarter
                    form = stable_hash(f"{p.kind}|{name}|{p.number}|{p.town}|{'' if p.town else quarter}") & 0x7FFFFFFFFFFFFFFF
                    got = known[text] = (form, p.kind, name, p.number, p.unit, p.town, quarter)
                out.append(got)
            parts = pd.DataFrame(out, columns=["form", "kind", "name", "number", "unit", "town", "quarter"])
            yield pd.concat([frame[["row", "text"]].reset_index(drop=True), parts], axis=1)

    return narrow.mapInPandas(run, PARSED)


def candidate_pairs(forms: DataFrame) -> DataFrame:
    """``(a, b)``, each once: forms that share a band. ``forms`` has ``form``, ``name``, ``number``, ``town``.

    Rows are not in here: a bucket holds the distinct spellings of like street names with one house number in like towns, and copies of
    a building, however many, are one form. A form without a town meets all forms of like names and its number. Buckets are
    joined, not gathered, so a crowded one can be split.
    """

    def banded(rows: DataFrame, keys: Callable[[str, str, str], np.ndarray], each: int) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    found = np.stack([keys(*x) for x in zip(frame["name"], frame["number"], frame["town"], strict=True)])
                    yield pd.DataFrame({"key": found.ravel(), "form": np.repeat(frame["form"].to_numpy(), each)})

        return rows.select("form", "name", "number", "town").mapInPandas(run, "key bigint, form bigint")

    def pairs(left: DataFrame, right: DataFrame, once: bool) -> DataFrame:
        a, b = left.alias("a"), right.alias("b")
        other = F.col("a.form") < F.col("b.form") if once else F.col("a.form") != F.col("b.form")
        return a.join(b, (F.col("a.key") == F.col("b.key")) & other).select(F.least("a.form", "b.form").alias("a"), F.greatest("a.form", "b.form").alias("b"))

    placed, lost = forms.where("town <> ''"), forms.where("town = ''")
    known = banded(placed, lambda n, h, t: band_keys(tuple(n.split()), h, t), BANDS)
    without = lambda n, h, t: open_keys(tuple(n.split()), h)
    found = pairs(known, known, True)
    if not lost.isEmpty():
        # of the others only keys that such a form has go on
        asking = cut(banded(lost, without, OPEN_BANDS))
        asked = banded(placed, without, OPEN_BANDS).join(asking.select("key").dropDuplicates(), "key", "left_semi")
        found = found.unionByName(pairs(asking, asking, True)).unionByName(pairs(asking, asked, False))
    return found.dropDuplicates()


def verify(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    columns = ["kind", "name", "number", "town", "quarter"]
    sides = [forms.select(F.col("form").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns]) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            halves = [frame[[f"{s}_{c}" for c in columns]].set_axis(columns, axis=1).to_dict("records") for s in "ab"]
            good = [same_building(x, y) for x, y in zip(*halves, strict=True)]
            yield frame.loc[good, ["a", "b"]]

    return both.mapInPandas(run, "a bigint, b bigint")


def same_addresses(df: DataFrame, row_id: str, street: str, address: str, neighbourhood: str, city: str) -> DataFrame:
    """``(<row_id>_a, <row_id>_b)``, ``a < b``: rows that both name a house number and denote one building, and differ as written.

    Rows are taken apart into kind and name of the street, number, unit and town; equal parts make one form. Forms are
    paired by MinHash bands over the tokens and q-grams of the name and of the town, salted with the number, and verified by affine-gap
    token alignment with abbreviation dictionaries in its costs. Pairs of rows are written out only at the end, from pairs
    of forms; copies written alike are none. Rows without number or name of a street, or without id, take no part; a
    repeated id counts once; nulls and blanks are parts not given. An empty table gives an empty table.
    """
    parsed = cut(parse_rows(df, row_id, street, address, neighbourhood, city).where("number <> '' and name <> ''"))
    forms = parsed.groupBy("form").agg(*[F.max(c).alias(c) for c in ("kind", "name", "number", "town", "quarter")])
    forms = cut(forms)
    links = verify(candidate_pairs(forms), forms)
    all_links = links.unionByName(forms.select(F.col("form").alias("a"), F.col("form").alias("b")))
    rows = parsed.select("row", "text", "form").dropDuplicates(["row"])
    left = rows.select(F.col("row").alias("x"), F.col("text").alias("x_text"), F.col("form").alias("a"))
    right = rows.select(F.col("row").alias("y"), F.col("text").alias("y_text"), F.col("form").alias("b"))
    pairs = all_links.join(left, "a").join(right, "b").where("x_text <> y_text and (a <> b or x < y)")
    return pairs.select(F.least("x", "y").alias(f"{row_id}_a"), F.greatest("x", "y").alias(f"{row_id}_b"))
