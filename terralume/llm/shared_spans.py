"""Long exact spans shared between documents, by relative Lempel-Ziv parsing.

Every document is a reference for every other. Reference blocks are indexed by anchors: k-grams picked by their own
hash (winnowing), so that each stretch of ``min_chars`` characters holds at least one, the same wherever it stands.
The block of an anchor is the text that all stretches around it can reach.

* The index tells which anchors stand in more than one document; all other text is left behind there.
* At each such anchor a document is factored greedily against all indexed blocks: the longest match to the right and to
  the left, found between neighbours in the order of the blocks' texts, as in a suffix array.
* A factor long enough is a shared span. Where the longest matches belong to two references, the factor's boundary is
  checked: the stretches across it count if one reference holds them.
* A factor that ends with its block goes on in the next one; spans are the unions of factors.

Rows written are anchors and factors, not positions, and everything that is found is compared character by character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terralume.functions.lineage import cut

MIN_CHARS = 200
ANCHOR_CHARS = 80
#: Blocks of one anchor that a task factors at a time; anchors with more are made longer until they have fewer.
MOST_BLOCKS = 2048
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE_CHARS = 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words without visible pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, _PIECE_CHARS + 1)
        step = np.full(size, base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


class RollingText:
    """Texts laid end to end with a polynomial hash of any stretch in constant time; positions are code points."""

    def __init__(self, texts: list[str]):
        self.length = np.array([len(t) for t in texts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        chars = _mix(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
        self.total = len(chars)
        self.prefix = np.zeros(self.total + 1, np.uint64)
        chars *= _power(_BASE, self.total)
        np.cumsum(chars, out=self.prefix[1:])
        self.inverse = _power(_INVERSE, self.total + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])


def find_anchors(text: RollingText, min_chars: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in the whole, k-gram hash) of the anchors of all texts of at least ``min_chars``."""
    window = min_chars - k + 1
    grams = text.total - k + 1
    none = np.zeros(0, np.int64)
    if grams < window or not (text.length >= min_chars).any():
        return none, none, none.astype(np.uint64)
    value = (text.prefix[k:] - text.prefix[:grams]) * text.inverse[:grams]  # as text.hash, of every place
    value = _mix(value)
    places = np.arange(grams, dtype=np.uint64)
    # of equal grams of one window the first; least values by blocks of the window's size, from both sides
    packed = np.full(-(-grams // window) * window, np.iinfo(np.uint64).max, np.uint64)
    np.bitwise_or(value & np.uint64(0xFFFFFFFF00000000), places, out=packed[:grams])
    blocks = packed.reshape(-1, window)
    across = np.ascontiguousarray(blocks.T)  # rows of neighbouring blocks: each step is one vector operation
    ahead, behind = across.copy(), across
    for i in range(1, window):
        np.minimum(ahead[i], ahead[i - 1], out=ahead[i])
        np.minimum(behind[window - 1 - i], behind[window - i], out=behind[window - 1 - i])
    ahead, behind = ahead.T.ravel(), behind.T.ravel()
    windows = grams - window + 1
    least = np.minimum(behind[:windows], ahead[window - 1 : window - 1 + windows])
    spread = np.repeat(text.start + text.length, text.length)[:windows]  # where the text of each place ends
    chosen = (least[np.arange(windows) + min_chars <= spread] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(chosen):
        return none, none, none.astype(np.uint64)
    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]  # the places of least values never go back
    return np.searchsorted(text.start, chosen, side="right") - 1, chosen, value[chosen]


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        floor = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, floor + _PIECE_CHARS, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


# -- factors -------------------------------------------------------------------------
def _matrix(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts of at most ``width``, one row each, and their lengths."""
    length = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros((len(texts), width), np.uint32)
    out[np.arange(width)[None, :] < length[:, None]] = flat
    return out, length


def _common(matrix: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many characters the rows ``a`` and ``b`` have in common from their beginning."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 20_000):
        x, y = a[at : at + 20_000], b[at : at + 20_000]
        differs = matrix[x] != matrix[y]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), matrix.shape[1])
        out[at : at + 20_000] = np.minimum(first, np.minimum(length[x], length[y]))
    return out


def _longest(order: np.ndarray, key: np.ndarray, doc: np.ndarray, matrix: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the longest beginning that it shares with another document's row of its key, and that row; what neighbours share.

    ``order`` sorts rows by key and text, so the best partner is the nearest row of another document on one side.
    ``doc`` is -1 for rows that stand in several documents: they are another's to everyone.
    """
    n = len(order)
    best, partner = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    if n < 2:
        return best, partner, np.zeros(0, np.int64)
    left, right = order[:-1], order[1:]
    adjacent = np.where(key[left] == key[right], _common(matrix, length, left, right), 0)
    same = (doc[left] == doc[right]) & (doc[left] >= 0)
    for a, b in ((left, right), (right, left)):  # a is the neighbour of b; first in ascending, then in descending order
        walk = range(n - 1) if a is left else range(n - 2, -1, -1)
        reach, who = adjacent.copy(), a.copy()
        held = same & (adjacent > 0)
        if held.any():  # a neighbour of the same document hands on its own
            step = -1 if a is left else 1
            for i in walk:
                if held[i]:
                    before = i + step
                    ok = 0 <= before < n - 1
                    reach[i], who[i] = (min(adjacent[i], reach[before]), who[before]) if ok else (0, -1)
        reach[who < 0] = 0
        better = reach > best[b]
        best[b], partner[b] = np.where(better, reach, best[b]), np.where(better, who, partner[b])
    return best, partner, adjacent


def factors(key: np.ndarray, off: np.ndarray, text: list[str], doc: np.ndarray, min_chars: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)``: of each block the stretches of at least ``min_chars`` around its anchor that another document has.

    Blocks of one key hold the same anchor, ``k`` characters from ``off`` on. A block is factored against all others of its
    key: from the anchor the longest match to the right and to the left. If one reference holds both, that is the factor, and
    nothing longer is shared. Else the factor ends at a boundary between two references, and the stretches across it are
    checked against those references that reach far enough. All comparisons are of characters.
    """
    n = len(text)
    ahead, ahead_length = _matrix([t[o : o + min_chars] for t, o in zip(text, off, strict=True)], min_chars)
    back = [t[: o + k][::-1] for t, o in zip(text, off, strict=True)]
    behind, behind_length = _matrix(back, min_chars)
    to_right = np.array(sorted(range(n), key=lambda i: (key[i], text[i][off[i] :])), np.int64)
    to_left = np.array(sorted(range(n), key=lambda i: (key[i], back[i])), np.int64)
    r, r_with, adjacent = _longest(to_right, key, doc, ahead, ahead_length)
    s, s_with, _ = _longest(to_left, key, doc, behind, behind_length)
    whole = doc < 0
    r, s = np.where(whole, ahead_length, r), np.where(whole, behind_length, s)
    worth = (r >= k) & (s >= k) & (r + s - k >= min_chars)
    sure = whole & worth
    rest = np.flatnonzero(worth & ~whole)
    held = (_common(behind, behind_length, rest, r_with[rest]) >= s[rest]) | (_common(ahead, ahead_length, rest, s_with[rest]) >= r[rest])
    sure[rest[held]] = True
    rows, start, end = [np.flatnonzero(sure)], [(off + k - s)[sure]], [(off + r)[sure]]
    place = np.empty(n, np.int64)
    place[to_right] = np.arange(n)
    sorted_key = key[to_right]
    for i in rest[~held]:
        # references that can hold a stretch of i lie around it in order, as far as they share the least of its right side
        least, at = min_chars - (s[i] - k), int(place[i])
        first, last = np.searchsorted(sorted_key, key[i], "left"), np.searchsorted(sorted_key, key[i], "right") - 1
        before, after = np.flatnonzero(adjacent[first:at] < least), np.flatnonzero(adjacent[at:last] < least)
        low, high = first + before[-1] + 1 if len(before) else first, at + after[0] if len(after) else last
        others = to_right[low : high + 1]
        others = others[(doc[others] != doc[i]) | (doc[others] < 0)]
        me = np.full(len(others), i)
        a, b = _common(behind, behind_length, others, me) - k, _common(ahead, ahead_length, others, me)
        good = (a >= 0) & (a + b >= min_chars)
        spans = np.unique(np.stack([off[i] - a[good], off[i] + b[good]], axis=1), axis=0)
        rows.append(np.full(len(spans), i))
        start.append(spans[:, 0])
        end.append(spans[:, 1])
    return np.concatenate(rows), np.concatenate(start), np.concatenate(end)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of whole keys, from batches sorted by their first column."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        key = table.column(0).to_numpy()
        last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None:
        yield rest


def _factored(blocks: DataFrame, refs: list[str], min_chars: int, k: int) -> DataFrame:
    """``refs``, ``start``, ``stop`` of the factors of ``blocks`` (``key``, ``off``, ``text``, ``least``, ``most``), whose keys are bounded."""
    sorted_blocks = blocks.select("key", "off", "text", "least", "most", *refs).repartition("key").sortWithinPartitions("key")
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            docs = pa.compute.dictionary_encode(pa.chunked_array([*table.column("least").chunks, *table.column("most").chunks])).combine_chunks()
            code = docs.indices.to_numpy().astype(np.int64)
            least, most = code[: table.num_rows], code[table.num_rows :]
            row, start, end = factors(table.column("key").to_numpy(), table.column("off").to_numpy(), table.column("text").to_pylist(), np.where(least == most, least, -1), min_chars, k)
            taken = table.select(refs).take(pa.array(row)).combine_chunks()
            yield pa.RecordBatch.from_arrays([*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in taken.columns], _long(start), _long(end)], [*refs, "start", "stop"])

    return sorted_blocks.mapInArrow(run, ", ".join([*(f"`{r}` {kinds[r]}" for r in refs), "start bigint", "stop bigint"]))


def _crowded(occurrences: DataFrame, min_chars: int, k: int, most_blocks: int) -> DataFrame:
    """``id, start, stop`` for anchors that too many blocks hold for one task.

    Equal blocks are put together first. Where more than ``most_blocks`` are left, the anchor is made longer: a stretch that needs
    ``m`` more characters reaches half of them to the left or to the right, so a block goes on under two longer anchors, each of
    them rarer. Anchors of one document are dropped on the way. After the last halving the anchor is the stretch itself.
    """
    blocks = occurrences.withColumn("block", F.xxhash64("text"))
    distinct = blocks.groupBy(F.col("key").alias("gram"), "block", "off", "text").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    open_ = cut(distinct.withColumns({"key": F.col("gram"), "lo": F.col("off"), "hi": F.col("off") + k}))
    found, need = [], min_chars - k
    while True:
        if not need:
            stretch = open_.withColumn("stretch", F.substr("text", F.col("lo") + 1, F.col("hi") - F.col("lo")))
            shared = stretch.groupBy("stretch").agg(F.min("least").alias("a"), F.max("most").alias("b")).where("a < b").select("stretch")
            found.append(stretch.join(shared, "stretch", "left_semi").select("gram", "block", F.col("lo").alias("s"), F.col("hi").alias("e")))
            break
        sized = open_.groupBy("key").agg(F.count("*").alias("n"), F.min("least").alias("a"), F.max("most").alias("b")).where("a < b").select("key", "n")
        known = open_.join(sized, "key")
        # within a longer anchor the shorter one's place still counts: all that is needed is a common stretch
        small = known.where(F.col("n") <= most_blocks)
        found.append(_factored(small, ["gram", "block"], min_chars, k).withColumnsRenamed({"start": "s", "stop": "e"}))
        half = -(-need // 2)
        wide = known.where(F.col("n") > most_blocks)
        to_left = wide.where(F.col("lo") >= half).withColumns({"key": F.xxhash64("key", F.lit(0), F.substr("text", F.col("lo") - half + 1, F.lit(half))), "lo": F.col("lo") - half})
        to_right = wide.where(F.col("hi") + half <= F.length("text")).withColumns({"key": F.xxhash64("key", F.lit(1), F.substr("text", F.col("hi") + 1, F.lit(half))), "hi": F.col("hi") + half})
        open_ = cut(to_left.unionByName(to_right).drop("n"))
        need -= half
        if open_.isEmpty():
            break
    pieces = reduce(DataFrame.unionByName, found).dropDuplicates()
    return blocks.select(F.col("key").alias("gram"), "block", "id", "base").join(pieces, ["gram", "block"]).select("id", (F.col("base") + F.col("s")).alias("start"), (F.col("base") + F.col("e")).alias("stop"))


def shared_spans(df: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS, anchor_chars: int = ANCHOR_CHARS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``(id_col, span_start, span_end)``: each union of overlapping or touching stretches of at least
    ``min_chars`` code points that stand verbatim in a text of another id.

    Null, empty and shorter texts have no spans, and neither has a text that recurs only under its own
    id; rows with a null id take no part. Rows that repeat an id count as texts of one document: their
    spans are merged by position. Other columns are not read. An empty table gives an empty table.
    ``most_blocks`` bounds what one task factors at a time, not what is found.
    """
    if not 8 <= anchor_chars <= min_chars:
        raise ValueError("anchor_chars must lie between 8 and min_chars")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("id").isNotNull() & (F.length("text") >= min_chars))
    kind = docs.schema["id"].dataType.simpleString()
    reach = min_chars - anchor_chars

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole, 1):
                text = RollingText(batch.column(1).to_pylist())
                doc, place, gram = find_anchors(text, min_chars, anchor_chars)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), _long(place - text.start[doc]), _long(gram)], ["id", "place", "gram"])

    # found twice rather than kept: a written copy costs more disk than it saves time
    index = docs.mapInArrow(anchors, f"id {kind}, place bigint, gram bigint")
    counted = index.groupBy("gram").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n"))
    indexed = cut(counted.where("least < most").select("gram", (F.col("n") > most_blocks).alias("crowded")))
    marks = index.join(indexed, "gram").groupBy("id").agg(F.collect_list(F.struct("place", "gram", "crowded")).alias("marks"))

    def take_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole, 1):
                texts = batch.column(1).to_pylist()
                text = RollingText(texts)
                lists = batch.column(2)
                flat = lists.flatten()
                doc = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
                place, gram = flat.field("place").to_numpy(), flat.field("gram").to_numpy()
                fits = np.flatnonzero(place + anchor_chars <= text.length[doc])
                at = text.start[doc[fits]] + place[fits]
                fits = fits[text.hash(at, at + anchor_chars).view(np.int64) == gram[fits]]  # texts of one id have each their own
                doc, place = doc[fits], place[fits]
                start, end = np.maximum(0, place - reach), np.minimum(text.length[doc], place + min_chars)
                cuts = pa.array([texts[d][s:e] for d, s, e in zip(doc, start, end, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), _long(start), _long(gram[fits]), _long(place - start), cuts, flat.field("crowded").take(pa.array(fits))], ["id", "base", "key", "off", "text", "crowded"])

    blocks = docs.join(marks, "id").select("id", "text", "marks").mapInArrow(take_blocks, f"id {kind}, base bigint, key bigint, off bigint, text string, crowded boolean")
    blocks = blocks.withColumns({"least": F.col("id"), "most": F.col("id")})
    any_crowded = not indexed.where("crowded").isEmpty()
    if any_crowded:
        blocks = cut(blocks)
    alone = _factored(blocks.where("not crowded"), ["id", "base"], min_chars, anchor_chars)
    pieces = alone.select("id", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("stop")).alias("stop"))
    if any_crowded:
        pieces = pieces.unionByName(_crowded(blocks.where("crowded"), min_chars, anchor_chars, most_blocks))
    return merge_spans(pieces, "id", "start", "stop").toDF(id_col, "span_start", "span_end")


def merge_spans(df: DataFrame, id_col: str, start: str, end: str) -> DataFrame:
    """Unions of overlapping or touching spans of each id; a group is at most as large as its document is long."""
    by_start = Window.partitionBy(id_col).orderBy(start, end)
    before = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.dropDuplicates().withColumn("_new", F.when(before >= F.col(start), 0).otherwise(1))
    unions = opened.withColumn("_union", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    return unions.groupBy(id_col, "_union").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_union")


def shared_portion(df: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each row of ``df``: its length, how many of its characters are shared, and their share (0 for texts without characters)."""
    lengths = df.select(F.col(id_col), F.coalesce(F.length(F.col(text_col)), F.lit(0)).cast("bigint").alias("n_chars"))
    covered = spans.groupBy(id_col).agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"), F.count("*").alias("n_spans"))
    joined = lengths.join(covered, id_col, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("shared_chars", "n_spans")})
    return joined.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).otherwise(F.lit(0.0)))
