"""Encoding with a public byte-level BPE vocabulary, by speculation and verification.

For each distinct word a greedy longest-match pass *proposes* tokens. A proposal
is the BPE result exactly if every adjacent pair of tokens is compatible, that is
if no merge across their boundary comes before the merges that build them. The
test is a few NumPy look-ups over all pairs of a batch at once. Only words with an
incompatible pair go through the merges one by one.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that splits a text into words before merging, as published with the vocabulary.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids between batches of a worker; only speed depends on it.
CACHE_WORDS = 400_000
#: Longer words are not kept.
CACHE_WORD_CHARS = 64


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file: printable bytes stand for themselves."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class SpeculativeBpe:
    """Encoder of one vocabulary file; ids of texts without special tokens."""

    def __init__(self, path: str = DEFAULT_VOCABULARY):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        symbol = _byte_of_symbol()
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max(vocabulary.values()) + 1
        self.byte_id = [0] * 256
        for char, byte in symbol.items():
            self.byte_id[byte] = vocabulary[char]
        #: Merge order of a token; -1: a single byte, there from the beginning.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.made: dict[tuple[int, int], tuple[int, int]] = {}
        for order, (a, b) in enumerate(merges):
            ia, ib, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.made.setdefault((ia, ib), (order, made))
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = order, ia, ib
        keys = np.array([a * size + b for a, b in self.made], np.int64)
        orders = np.array([order for order, _ in self.made.values()], np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_orders, self.size = keys[by], orders[by], size
        text_of = {i: bytes(symbol[c] for c in t) for t, i in vocabulary.items() if all(c in symbol for c in t)}
        keep = {i for i in text_of if self.rank[i] >= 0} | set(self.byte_id)
        self.by_bytes = {b: i for i, b in text_of.items() if i in keep}
        self.longest = max(map(len, self.by_bytes))
        self.words = regex.compile(WORD_PATTERN)
        self.cache: dict[str, tuple[int, ...]] = {}

    # -- proposal -------------------------------------------------------------
    def propose(self, word: bytes) -> list[int]:
        """Longest known prefix first."""
        known, out, at, n = self.by_bytes, [], 0, len(word)
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                token = known.get(word[at:end])
                if token is not None:
                    out.append(token)
                    at = end
                    break
        return out

    # -- verification ---------------------------------------------------------
    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays apart.

        On each side of the boundary stands, as merging goes on, a growing part of
        the token: a chain of last parts of the first token and of first parts of the
        second. A merge of order m joins two such parts if both are there before it and
        neither has been built into its parent by then; of equal orders the one further
        left comes first.
        """
        never = np.int64(1) << 60
        ok = np.ones(len(first), bool)
        a, a_until = first.copy(), np.full(len(first), never)
        while (a >= 0).any():
            b, b_until = second.copy(), np.full(len(second), never)
            live_a = a >= 0
            while True:
                live = live_a & (b >= 0)
                if not live.any():
                    break
                key = np.where(live, a * self.size + b, -1)
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                order = np.where(self.pair_keys[at] == key, self.pair_orders[at], never)
                ok &= ~(live & (order < a_until) & (order <= b_until) & (order < never))
                b_until = np.where(b >= 0, self.rank[b], b_until)
                b = np.where(b >= 0, self.left[b], -1)
            a_until = np.where(a >= 0, self.rank[a], a_until)
            a = np.where(a >= 0, self.right[a], -1)
        return ok

    # -- exact merging --------------------------------------------------------
    def merge(self, word: bytes) -> list[int]:
        """The merges in their order, by a heap over a linked list: n log n for a word of n bytes."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        after, before, made = [*range(1, n), -1], [*range(-1, n - 1)], self.made
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := made.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (m := made.get((ids[x], ids[after[x]]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[after[x]]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct words: proposals, one vectorised check of all their pairs, exact merges where it fails."""
        raw = [w.encode("utf-8") for w in words]
        proposals = [(t,) if (t := self.by_bytes.get(b)) is not None and len(b) == 1 else tuple(self.propose(b)) for b in raw]
        counts = np.array([max(0, len(p) - 1) for p in proposals], np.int64)
        if counts.sum():
            flat = np.fromiter((t for p in proposals for t in p), np.int64)
            owner = np.repeat(np.arange(len(proposals)), [len(p) for p in proposals])
            inside = owner[1:] == owner[:-1]
            first, second, of = flat[:-1][inside], flat[1:][inside], owner[1:][inside]
            pairs, where = np.unique(first * self.size + second, return_inverse=True)
            ok = self.compatible(pairs // self.size, pairs % self.size)[where]
            for i in np.unique(of[~ok]):
                proposals[i] = tuple(self.merge(raw[i]))
        return proposals

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offsets of the texts in them. A null or empty text has none."""
        split = [self.words.findall(t) if t else () for t in texts]
        cache = self.cache
        missing = list({w for words in split for w in words if w not in cache})
        if len(cache) + len(missing) > CACHE_WORDS:
            cache.clear()
            missing = list({w for words in split for w in words})
        fresh = dict(zip(missing, self.encode_words(missing), strict=True))
        cache.update(fresh)
        flat: list[int] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, words in enumerate(split):
            for w in words:
                flat += cache[w]
            ends[i + 1] = len(flat)
        for w in missing:
            if len(w) > CACHE_WORD_CHARS:
                del cache[w]
        return np.array(flat, np.int32), ends


_encoders: dict[str, SpeculativeBpe] = {}


def encoder(path: str) -> SpeculativeBpe:
    """One encoder for each file and worker process."""
    if path not in _encoders:
        _encoders[path] = SpeculativeBpe(path)
    return _encoders[path]


def _pieces(batch: pa.RecordBatch, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about so many characters: the word lists of one slice are in memory at a time."""
    sizes = np.cumsum([len(t or b"") for t in batch.column(1).to_pylist()])
    start = 0
    while start < batch.num_rows:
        floor = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, floor + chars, side="right")))
        yield batch.slice(start, end - start)
        start = end


def encode_column(df: DataFrame, id_col: str, text_col: str, ids_col: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row ``(id_col, ids_col)`` for each row of ``df``, ids as ``array<int>``.

    No shuffle: each partition is encoded where it is read. Null and empty texts give an
    empty list; strings that look like special tokens are ordinary text; repeated and null
    ids, and columns beside the two, are passed over. An empty table gives an empty table.
    """
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for whole in batches:
            for batch in _pieces(whole):
                flat, ends = bpe.encode_batch(batch.column(1).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    return narrow.mapInArrow(run, f"id {kind}, ids array<int>").toDF(id_col, ids_col)


def count_tokens(df: DataFrame, text_col: str, count_col: str = "n_tokens", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``df`` without its text, with the number of tokens of the text (0 for null and empty ones) as ``count_col``.

    A column of ``df`` already called ``count_col`` is replaced.
    """
    others = [c for c in df.columns if c not in (text_col, count_col)]
    narrow = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), F.col(text_col).cast("string").alias("text"))
    rest = narrow.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for whole in batches:
            for batch in _pieces(whole):
                ends = bpe.encode_batch(batch.column(1).to_pylist())[1]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends))], ["rest", "n"])

    counted = narrow.mapInArrow(run, f"rest {rest}, n bigint")
    return counted.select(*[F.col(f"rest.`{c}`").alias(c) for c in others], F.col("n").alias(count_col))


def available(path: str = DEFAULT_VOCABULARY) -> bool:
    return os.path.exists(path)
