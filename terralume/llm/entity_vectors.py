"""Skip-gram vectors of the graph of records, attributes and words, trained on all records and spelled by q-grams.

A token's vector is the sum of the vectors of its parts: of a word its q-grams, of an attribute its value. Parts are hashed into
a fixed number of buckets, so the model has one size however many words there are, and a word never seen has a vector too.

Each partition walks over the graph of its own records and trains from one common start; the partitions' models are put together
bucket by bucket, weighted by how often each was trained. No sample is drawn, and what comes to the driver is the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralume.llm.address_match import stable_hash

DIM = 48
#: Buckets of each kind of part; each kind is centred by itself.
KINDS = {"word": 4096, "town": 4096, "quarter": 2048, "": 2048}
#: Kinds of which words are spelled, and the columns that hold them.
SPELLED = {"word": "name", "town": "town", "quarter": "quarter"}
_OFFSET = dict(zip(KINDS, np.cumsum([0, *KINDS.values()])[:-1].tolist(), strict=True))
BUCKETS = sum(KINDS.values())
#: Steps of a record's walk, how far apart tokens of a walk are paired, noise tokens for each pair, step of the descent.
STEPS, WINDOW, NEGATIVES, RATE, MOST_STEPS = 3, 2, 2, 0.2, 32
#: How far training may move a bucket's vector (it starts about 0.5 long), and the longest vector of a context.
FARTHEST, LONGEST_CONTEXT = 0.2, 1.0
#: Records walked over, and pairs trained, at a time.
RECORDS_AT_ONCE, PAIRS_AT_ONCE = 20_000, 8192
#: What a token weighs in a record's vector, beside its rarity for words.
WEIGHTS = {"word": 1.0, "town": 0.5, "quarter": 0.35, "area": 5.0, "bedrooms": 3.0, "bathrooms": 3.0}
#: Directions that most of a kind's tokens lie along; they are taken out, as they tell little of any one.
DIRECTIONS = 4
#: With so many parts seen of a kind most of its common part is taken out, with many more all of it.
SEEN_MUCH = 5000
_COLUMNS = [f"v{i}" for i in range(DIM)]


@lru_cache(400_000)
def parts(token: str) -> tuple[int, ...]:
    """The buckets of a token: of the q-grams of a spelled one, of any other its own."""
    kind, _, value = token.partition(":")
    if kind not in SPELLED:
        return (_OFFSET[""] + stable_hash(token) % KINDS[""],)
    padded = f"^{value}$"
    return tuple(_OFFSET[kind] + stable_hash(padded[i : i + 3]) % KINDS[kind] for i in range(max(1, len(padded) - 2)))


def _scale(area: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each area on a logarithmic scale: the mark below, and how far it is from there to the next."""
    at = np.log(np.where(area > 0, area, 1.0)) / 0.1
    low = np.floor(at)
    return low.astype(np.int64), at - low


def links(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(record, token, vocabulary): the edges of the graph, in order of the records, each once."""
    records, numbers, vocabulary, n = [], [], [], 0

    def add(record: np.ndarray, code: np.ndarray, names: list[str]) -> None:
        nonlocal n
        records.append(record)
        numbers.append(code + n)
        vocabulary.extend(names)
        n += len(names)

    for kind, column in SPELLED.items():
        which, texts = pd.factorize(frame[column])
        words = [t.split() for t in texts]
        size = np.array([len(w) for w in words], np.int64)
        code, names = pd.factorize(np.array([w for ws in words for w in ws], object))
        first = np.cumsum(size) - size
        count = size[which]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        add(np.repeat(np.arange(len(frame)), count), code[np.repeat(first[which], count) + inside], [f"{kind}:{w}" for w in names])
    for column in ("kind", "number", "property_type"):
        text = frame[column].fillna("")
        there = np.flatnonzero(text.to_numpy() != "")
        code, names = pd.factorize(text.iloc[there])
        add(there, code, [f"{column}:{x}" for x in names])
    for column in ("bedrooms", "bathrooms", "suites", "floor"):
        value = frame[column].to_numpy(np.float64)
        there = np.flatnonzero(np.isfinite(value))
        code, names = pd.factorize(value[there])
        add(there, code, [f"{column}:{x:g}" for x in names])
    area = frame["area"].to_numpy(np.float64)
    there = np.flatnonzero(area > 0)
    low, beyond = _scale(area[there])
    code, names = pd.factorize(low + (beyond >= 0.5))
    add(there, code, [f"area:{x}" for x in names])
    edges = np.unique(np.concatenate(records) * max(1, n) + np.concatenate(numbers))
    return edges // max(1, n), edges % max(1, n), vocabulary


@lru_cache(1)
def start() -> np.ndarray:
    """The vectors before training, the same everywhere; the last row, of no bucket, is zero."""
    u = np.random.default_rng(11).standard_normal((BUCKETS + 1, DIM)) * (0.5 / math.sqrt(DIM))
    u[-1] = 0
    return u


def _scatter(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, d], minlength=n) for d in range(values.shape[1])], axis=1)


def _bound(rows: np.ndarray, most: float) -> None:
    """No row longer than ``most``: training goes on at one scale, however long."""
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    np.multiply(rows, np.minimum(1.0, most / np.maximum(norm, 1e-12)), out=rows)


def walks(record: np.ndarray, token: np.ndarray, n_records: int, n_tokens: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens near one another on random walks record, token, record, token, ..., one from each record."""
    size = np.bincount(record, minlength=n_records)
    first = np.cumsum(size) - size
    members = record[np.argsort(token, kind="stable")]
    degree = np.bincount(token, minlength=n_tokens)
    token_first = np.cumsum(degree) - degree
    at = np.flatnonzero(size)
    path = np.empty((STEPS, len(at)), np.int64)
    for s in range(STEPS):
        path[s] = token[first[at] + (rng.random(len(at)) * size[at]).astype(np.int64)]
        at = members[token_first[path[s]] + (rng.random(len(at)) * degree[path[s]]).astype(np.int64)]
    near = [(i, j) for i in range(STEPS) for j in range(STEPS) if 0 < abs(i - j) <= WINDOW]
    return np.concatenate([path[i] for i, _ in near]), np.concatenate([path[j] for _, j in near])


def descend(u: np.ndarray, trained: np.ndarray, seen: np.ndarray, context: dict[str, np.ndarray], frame: pd.DataFrame, rng: np.random.Generator) -> int:
    """One pass of skip-gram with negative sampling over the walks of the records of ``frame``, which are counted; all but the
    records are changed."""
    record, token, vocabulary = links(frame)
    if not vocabulary:
        return len(frame)
    center, other = walks(record, token, len(frame), len(vocabulary), rng)
    n = len(vocabulary)
    of_token = [parts(t) for t in vocabulary]
    width = max(map(len, of_token))
    table = np.full((n, width), BUCKETS, np.int64)
    for i, x in enumerate(of_token):
        table[i, : len(x)] = x
    size = np.array([len(x) for x in of_token], float)[:, None]
    of_record = np.bincount(token, minlength=n)
    once = [sorted(set(x)) for x in of_token]
    np.add.at(seen, np.array([b for x in once for b in x], np.int64), np.repeat(of_record, [len(x) for x in once]))
    v = np.stack([context.get(t, np.zeros(DIM)) for t in vocabulary])
    noise = np.cumsum(np.bincount(other, minlength=n) ** 0.75)
    order = rng.permutation(len(center))
    for at in range(0, len(order), PAIRS_AT_ONCE):
        pick = order[at : at + PAIRS_AT_ONCE]
        seen, c = np.unique(center[pick], return_inverse=True)
        own = u[table[seen]].sum(axis=1) / size[seen]
        target = np.concatenate([other[pick][:, None], np.searchsorted(noise, rng.random((len(pick), NEGATIVES)) * noise[-1]).clip(max=n - 1)], axis=1)
        x, y = own[c], v[target]
        error = 1 / (1 + np.exp(-np.clip(np.einsum("bd,bkd->bk", x, y), -8, 8)))
        error[:, 0] -= 1
        # many pairs at once: a token's steps are bounded by a norm rather than added up without end
        to_u = _scatter(c, np.einsum("bk,bkd->bd", error, y), len(seen))
        to_v = _scatter(target.ravel(), (error[:, :, None] * x[:, None, :]).reshape(-1, DIM), n)
        times = np.bincount(target.ravel(), minlength=n)[:, None]
        v -= RATE * to_v * (np.minimum(times, MOST_STEPS) / np.maximum(times, 1))
        _bound(v, LONGEST_CONTEXT)
        often = np.bincount(c, minlength=len(seen))[:, None]
        step = RATE * to_u * (np.minimum(often, MOST_STEPS) / often) / size[seen]
        rows = table[seen].ravel()
        u -= _scatter(rows, np.repeat(step, width, axis=0), BUCKETS + 1)
        moved = u - start()
        _bound(moved, FARTHEST)
        u[:] = start() + moved
        trained += np.bincount(rows, np.repeat(often[:, 0], width), minlength=BUCKETS + 1)
    context.update(zip(vocabulary, v, strict=True))
    return len(frame)


class Vectors:
    """The trained model: vectors of tokens, and how rare they are."""

    def __init__(self, table: np.ndarray, seen: np.ndarray, records: int):
        self.table, self.seen, self.count = table, seen, records
        self._known: dict[str, np.ndarray] = {}
        self._rarity: dict[str, float] = {}
        self._likeness: dict[tuple[str, str], float] = {}

    def token(self, token: str) -> np.ndarray:
        """A unit vector, or zero if nothing is known of any part."""
        v = self._known.get(token)
        if v is None:
            if len(self._known) > 300_000:
                self._known.clear()
            v = self.table[list(parts(token))].sum(axis=0)
            v = self._known[token] = (v / (np.linalg.norm(v) or 1)).astype(np.float32)
        return v

    def rarity(self, token: str) -> float:
        """By the most common count that the token's parts allow it to have."""
        x = self._rarity.get(token)
        if x is None:
            if len(self._rarity) > 300_000:
                self._rarity.clear()
            x = self._rarity[token] = math.log(1 + self.count / (1 + min(self.seen[b] for b in parts(token))))
        return x

    def likeness(self, a: str, b: str) -> float:
        """Cosine of two tokens."""
        key = (a, b) if a <= b else (b, a)
        x = self._likeness.get(key)
        if x is None:
            if len(self._likeness) > 500_000:
                self._likeness.clear()
            x = self._likeness[key] = 1.0 if a == b and self.token(a).any() else float(self.token(a) @ self.token(b))
        return x

    def _sums(self, kind: str, texts: pd.Series) -> np.ndarray:
        """Of each text the sum of its words by rarity."""
        which, names = pd.factorize(texts)
        words = [t.split() for t in names]
        size = np.array([len(w) for w in words], np.int64)
        code, distinct = pd.factorize(np.array([w for ws in words for w in ws], object))
        vectors = np.array([self.rarity(f"{kind}:{w}") * self.token(f"{kind}:{w}") for w in distinct], np.float32).reshape(-1, DIM)
        total = np.zeros((len(names) + 1, DIM), np.float32)
        np.add.at(total, np.repeat(np.arange(len(names)), size), vectors[code])
        return total[which]

    def records(self, frame: pd.DataFrame) -> np.ndarray:
        """Unit vectors of records: their tokens by weight, words by rarity too. An area lies between the two nearest marks."""
        total = np.zeros((len(frame), DIM), np.float32)
        for kind, column in SPELLED.items():
            total += WEIGHTS[kind] * self._sums(kind, frame[column])
        area = frame["area"].to_numpy(np.float64)
        there = np.flatnonzero(area > 0)
        low, beyond = _scale(area[there])
        for mark, share in ((low, 1 - beyond), (low + 1, beyond)):
            code, marks = pd.factorize(mark)
            if len(marks):
                total[there] += WEIGHTS["area"] * share[:, None].astype(np.float32) * np.stack([self.token(f"area:{m}") for m in marks])[code]
        for column in ("bedrooms", "bathrooms"):
            value = frame[column].to_numpy(np.float64)
            there = np.flatnonzero(np.isfinite(value))
            code, values = pd.factorize(value[there])
            if len(values):
                total[there] += WEIGHTS[column] * np.stack([self.token(f"{column}:{x:g}") for x in values])[code]
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        return total / np.where(norm > 0, norm, 1)


def train(ads: DataFrame, columns: list[str]) -> Vectors:
    """The model of all records of ``ads``. An empty table gives a model of zeros."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, trained, seen, n = start().copy(), np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), 0
        context: dict[str, np.ndarray] = {}
        rng = np.random.default_rng(13)
        held: list[pd.DataFrame] = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= RECORDS_AT_ONCE:
                n += descend(u, trained, seen, context, pd.concat(held, ignore_index=True), rng)
                held = []
            if len(context) > 200_000:
                context.clear()
        if held:
            n += descend(u, trained, seen, context, pd.concat(held, ignore_index=True), rng)
        used = np.flatnonzero(seen[:-1])
        out = pd.DataFrame(u[used] * trained[used, None], columns=_COLUMNS)
        out.insert(0, "seen", seen[used])
        out.insert(0, "weight", trained[used])
        out.insert(0, "bucket", used)
        yield pd.concat([out, pd.DataFrame([[-1, float(n), 0.0] + [0.0] * DIM], columns=out.columns)])

    schema = "bucket int, weight double, seen double, " + ", ".join(f"{c} double" for c in _COLUMNS)
    summed = ads.select(*columns).mapInPandas(run, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("weight", "seen", *_COLUMNS)]).toPandas()
    return assemble(summed)


def assemble(summed: pd.DataFrame) -> Vectors:
    """Averages of the buckets, centred kind by kind: what all tokens of a kind have in common tells nothing."""
    table, seen = start().copy(), np.zeros(BUCKETS + 1)
    counts = summed[summed["bucket"] < 0]
    records = int(counts["weight"].sum())
    rows = summed[summed["bucket"] >= 0]
    if not records:
        return Vectors(np.zeros_like(table), seen, 0)
    b, weight = rows["bucket"].to_numpy(), rows["weight"].to_numpy()
    seen[b] = rows["seen"].to_numpy()
    some = weight > 0
    table[b[some]] = rows[_COLUMNS].to_numpy()[some] / weight[some, None]
    for kind, size in KINDS.items():
        own = slice(_OFFSET[kind], _OFFSET[kind] + size)
        if seen[own].any():
            # how far a kind's common part is known grows with what was seen of it
            known = 1 - math.exp(-seen[own].sum() / SEEN_MUCH)
            table[own] -= known * np.average(table[own], axis=0, weights=seen[own])
            common = np.linalg.svd(table[own] * np.sqrt(seen[own])[:, None], full_matrices=False)[2][:DIRECTIONS]
            table[own] -= known * (table[own] @ common.T @ common)
    return Vectors(table.astype(np.float32), seen, records)
