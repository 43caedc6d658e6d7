"""Mapping freely typed values to the closest entry of a reference list, by token-level repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terralume.functions.lineage import cut
from terralume.functions.places import STATE_PATTERN, plain, state_code
from terralume.functions.usable import usable_text

#: Abbreviations in names of towns and what they can stand for.
ABBREVIATIONS = {
    "n": ["nova", "novo", "nossa"], "nsa": ["nossa"], "ns": ["nossa"], "sra": ["senhora"], "sr": ["senhor"], "s": ["sao", "santa", "santo"], "sta": ["santa"], "sto": ["santo"],
    "mte": ["monte"], "pto": ["porto"], "pt": ["porto"], "rib": ["ribeirao"], "vl": ["vila"], "v": ["vila"], "cpo": ["campo"], "c": ["campo"], "b": ["barra"], "br": ["barra"], "faz": ["fazenda"], "ant": ["antonio"], "pres": ["presidente"], "gov": ["governador"], "cel": ["coronel"], "gal": ["general"],
}
#: Words that join others and tell nothing.
JOINING = ["da", "de", "do", "das", "dos", "e", "d"]
#: Least soft TF-IDF of a match.
LEAST_SCORE = 0.8


def clean_town(text: Column) -> Column:
    """A town as typed, without state, dots, hyphens and words like ``municipio de``."""
    s = F.trim(F.regexp_replace(plain(text), r"[\s ]+", " "))
    s = F.regexp_replace(s, r"^(municipio|cidade) d[eoa]s? ", "")
    s = F.regexp_replace(s, rf"\s*(/|,| - |\()\s*({STATE_PATTERN})\)?\.?$", "")
    s = F.regexp_replace(s, rf"^({STATE_PATTERN})\s*(/| - )\s*", "")
    return F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " "))


def state_in_town(text: Column) -> Column:
    s = F.trim(plain(text))
    return F.coalesce(state_code(F.nullif(F.regexp_extract(s, rf"(?:/|,| - |\()\s*({STATE_PATTERN})\)?\.?$", 1), F.lit(""))), state_code(F.nullif(F.regexp_extract(s, rf"^({STATE_PATTERN})\s*(?:/| - )", 1), F.lit(""))))


def _less_one(token: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.concat(F.left(token, i - 1), F.substr(token, i + 1)))


def shortened(token: Column, most: Column) -> Column:
    """A token and all it becomes by leaving out up to ``most`` (0 to 2) characters: tokens within that edit distance share one of these."""
    one = _less_one(token)
    two = F.flatten(F.transform(one, _less_one))
    return F.array_distinct(F.when(most >= 2, F.concat(F.array(token), one, two)).when(most >= 1, F.concat(F.array(token), one)).otherwise(F.array(token)))


#: Up to so many letters all shortenings of a word are written out; longer words are found by a piece that no edit touched.
SHORT = 40
#: Edits that any two words may be apart.
MOST_EDITS = 3


def _long_pairs(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``(token, word)`` of words of more than ``SHORT`` letters and tokens that may be within ``MOST_EDITS`` of them.

    Of ``MOST_EDITS`` + 1 pieces of a word one is untouched, and stands in the token at its place or at most ``MOST_EDITS`` beside it.
    """
    cut_at = lambda n, i: F.floor(n * i / (MOST_EDITS + 1))
    number, around = F.sequence(F.lit(0), F.lit(MOST_EDITS)), F.sequence(F.lit(-MOST_EDITS), F.lit(MOST_EDITS))
    n = F.length("word")
    pieces = words.where(n > SHORT).withColumn("i", F.explode(number)).select("word", n.alias("n"), "i", F.substr("word", cut_at(n, F.col("i")).cast("int") + 1, (cut_at(n, F.col("i") + 1) - cut_at(n, F.col("i"))).cast("int")).alias("piece"))
    sized = tokens.where(F.length("token") > SHORT - MOST_EDITS).withColumn("n", F.explode(F.transform(around, lambda d: F.length("token") + d))).withColumn("i", F.explode(number)).withColumn("shift", F.explode(around))
    begin = cut_at(F.col("n"), F.col("i")).cast("int") + 1 + F.col("shift")
    there = sized.withColumn("begin", begin).where("begin >= 1").select("token", "n", "i", F.substr("token", F.col("begin"), (cut_at(F.col("n"), F.col("i") + 1) - cut_at(F.col("n"), F.col("i"))).cast("int")).alias("piece")).dropDuplicates()
    return there.join(pieces, ["n", "i", "piece"]).select("token", "word").dropDuplicates()


def edits_allowed(token: Column) -> Column:
    return F.when(F.length(token) >= 6, 2).when(F.length(token) >= 4, 1).otherwise(0)


def repair_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(token, word, likeness)``: the reference words that each distinct token may stand for.

    By edit distance (two edits from six letters, one from four, and one more from eight, as two letters that change
    places count twice; joined on shortened forms, never crossed),
    by abbreviation, or as a cut-off beginning.
    """
    left, words = tokens.where(F.length("token") > 0), vocabulary.where(F.length("word") > 0)
    typed = left.where(F.length("token") <= SHORT + MOST_EDITS).withColumn("form", F.explode(shortened(F.col("token"), edits_allowed(F.col("token")))))
    known = words.where(F.length("word") <= SHORT).withColumn("form", F.explode(shortened(F.col("word"), edits_allowed(F.col("word")))))
    # estimates don't see how much longer exploded sides are, so neither may be broadcast on their word
    close = typed.hint("merge").join(known.hint("merge"), "form").select("token", "word").unionByName(_long_pairs(left, words)).dropDuplicates()
    distance = F.levenshtein("token", "word")
    longer = F.greatest(F.length("token"), F.length("word"))
    allowed = F.greatest(edits_allowed(F.col("token")), edits_allowed(F.col("word"))) + (longer >= 8).cast("int")
    letters = lambda c: F.array_sort(F.split(c, ""))
    # of the same letters in another order each two edits are one change of places
    moved = F.when(letters("token") == letters("word"), F.ceil(distance / 2)).otherwise(distance)
    edited = close.withColumn("edits", moved).where(F.col("edits") <= allowed).withColumn("likeness", 1 - F.col("edits") * 0.6 / longer).drop("edits")
    short = F.create_map(*[x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    spelled = left.withColumn("word", F.explode(F.try_element_at(short, F.col("token")))).join(words.select("word"), "word", "left_semi").select("token", "word", F.lit(0.97).alias("likeness"))
    begun = words.where(F.length("word") >= 3).withColumn("token", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.left(F.col("word"), n))))
    cut_off = left.join(begun, "token").select("token", "word", (0.85 + 0.1 * F.length("token") / F.length("word")).alias("likeness"))
    return edited.unionByName(spelled).unionByName(cut_off).groupBy("token", "word").agg(F.max("likeness").alias("likeness"))


def map_to_reference(values: DataFrame, value: str, state: str, reference: DataFrame, name: str, entry_id: str, entry_state: str, least_score: float = LEAST_SCORE) -> DataFrame:
    """For each distinct ``(value, state)`` of ``values``: ``entry_id`` (empty text: no such entry), ``score``, and ``namesakes``: the ids of all
    entries of that name where the state doesn't tell which of several it is, else null.

    Distinct tokens are repaired against the reference vocabulary; repaired tokens and whole entries are compared by
    soft TF-IDF: the cosine of weights by rarity in the reference, each shared word counted by its likeness. An entry
    is a candidate for a value only if its rarest word is among the value's repaired tokens. Of entries with one name
    the one in the value's state wins (state column, else the state written behind the town), else the smallest id stands for the
    ``namesakes``, which ``settle_namesakes`` tells apart by more of the row. Ties of
    scores go to more words in full, then to the smaller name.

    Blank values are left out, placeholders (``n/d``) stand for no entry. A null state is unknown. Reference rows without id are passed over, repeated rows count once. An
    empty reference leaves every value unmatched.
    """
    asked = values.select(F.col(value).alias("value"), F.col(state).alias("state")).where(F.col("value").rlike(r"\S")).dropDuplicates()
    asked = cut(asked.withColumn("uf", F.coalesce(state_code(F.col("state")), state_in_town(F.col("value")))))
    entries = reference.select(F.col(entry_id).alias("id"), F.col(name).alias("name"), state_code(F.col(entry_state)).alias("uf")).where(F.col("id").rlike(r"\S") & F.col("name").rlike(r"\S")).dropDuplicates()
    named = entries.select(clean_town(F.col("name")).alias("entry")).dropDuplicates()
    listed = named.withColumn("words", F.split("entry", " "))
    vocabulary = listed.select("entry", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    total = listed.agg(F.count("*").alias("n"))
    weight = F.when(F.col("word").isin(JOINING), 0.2).otherwise(F.log(1 + F.col("n") / F.col("df")))
    weighted = cut(vocabulary.join(F.broadcast(total)).select("word", weight.alias("w")))
    in_entry = listed.select("entry", F.explode(F.array_distinct("words")).alias("word")).join(weighted, "word")
    profile = in_entry.groupBy("entry").agg(F.collect_list(F.struct("word", "w")).alias("words"), F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"), F.max_by("word", F.struct("w", "word")).alias("rarest"))
    forms = cut(asked.select("value").dropDuplicates().where(usable_text(F.col("value"))).withColumn("form", clean_town(F.col("value"))).where("form <> ''"))
    distinct_forms = forms.select("form").dropDuplicates()
    parts = distinct_forms.select("form", F.explode(F.array_distinct(F.split("form", " "))).alias("token"))
    repairs = cut(repair_tokens(parts.select("token").dropDuplicates(), weighted.select("word")))
    highest = weighted.agg(F.max("w").alias("top"))
    own = parts.join(repairs, "token", "left").join(weighted, "word", "left").join(F.broadcast(highest))
    # a token weighs as the reference word it is most like; one that is like none weighs as much as the rarest
    tokens = own.groupBy("form", "token").agg(F.coalesce(F.max_by("w", F.struct("likeness", "w")), F.when(F.col("token").isin(JOINING), 0.2).otherwise(F.first("top"))).alias("w"), F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "likeness"))).alias("repairs"))
    typed = tokens.groupBy("form").agg(F.flatten(F.collect_list(F.transform("repairs", lambda r: F.struct(r.word.alias("word"), r.likeness.alias("likeness"), F.col("w").alias("w"))))).alias("repairs"), F.sqrt(F.sum(F.col("w") ** 2)).alias("typed_norm"))
    reached = typed.withColumn("rarest", F.explode(F.array_distinct(F.transform("repairs", lambda r: r.word))))
    pairs = reached.join(profile, "rarest")
    best = F.transform("words", lambda e: F.struct(e.w.alias("w"), F.array_max(F.transform(F.filter("repairs", lambda r: r.word == e.word), lambda r: F.struct((r.likeness * r.w).alias("gain"), r.likeness.alias("likeness")))).alias("hit")))
    dot = F.aggregate(best, F.lit(0.0), lambda a, b: a + b.w * F.coalesce(b.hit.gain, F.lit(0.0)))
    ranked = pairs.withColumn("score", dot / (F.col("norm") * F.col("typed_norm")))
    top = ranked.groupBy("form").agg(F.max(F.struct("score", F.negative(F.length("entry")).alias("shorter"), "entry")).alias("top")).where(F.col("top.score") >= least_score).select("form", F.col("top.entry").alias("entry"), F.col("top.score").alias("score"))
    by_form = forms.join(top, "form").select("value", "entry", "score")
    places = entries.withColumn("entry", clean_town(F.col("name"))).groupBy("entry").agg(F.sort_array(F.collect_set(F.struct("id", "uf"))).alias("places"))
    resolved = by_form.join(places, "entry")
    joined = asked.join(resolved, "value", "left")
    there = F.get(F.filter("places", lambda p: p.uf == F.col("uf")), F.lit(0)).id
    chosen = F.coalesce(there, F.get("places", F.lit(0)).id, F.lit(""))
    ids = F.array_distinct(F.transform("places", lambda p: p.id))
    undecided = F.when(there.isNull() & (F.size(ids) > 1), ids)
    return joined.select(F.col("value").alias(value), F.col("state").alias(state), chosen.alias(entry_id), F.coalesce("score", F.lit(0.0)).alias("score"), undecided.alias("namesakes"))


#: What tells namesakes apart beside the state, and what it counts: a point within so many degrees, the beginning of the zip code, the neighbourhood.
NEAR_DEGREES, NEAR_COUNTS, ZIP_DIGITS, ZIP_COUNTS, QUARTER_COUNTS = 3.0, 3, 3, 2, 1


def settle_namesakes(rows: DataFrame, row_id: str, evidence: DataFrame) -> DataFrame:
    """``row_id, id, settled``: of each row's ``namesakes`` (ids) the one that most evidence speaks for; not ``settled`` if none does.

    ``rows`` and ``evidence`` (rows of the reference by ``id``) have ``zip``, ``quarter``, ``lat``, ``lon``, each of which may be null. Ties go to the nearer
    entry, then to the smaller id. Rows are never put together: each meets the few entries of its name.
    """
    fold = lambda c: F.nullif(F.regexp_replace(plain(F.col(c)), r"[^a-z0-9]+", " "), F.lit(""))
    start = lambda c: F.when(F.length(F.regexp_replace(c, r"\D", "")) == 8, F.left(F.regexp_replace(c, r"\D", ""), F.lit(ZIP_DIGITS)))
    known = evidence.select("id", start("zip").alias("zips"), fold("quarter").alias("quarters"), "lat", "lon").groupBy("id").agg(F.collect_set("zips").alias("zips"), F.collect_set("quarters").alias("quarters"), F.avg("lat").alias("e_lat"), F.avg("lon").alias("e_lon"))
    asked = rows.select(F.col(row_id).alias("row"), start("zip").alias("zip"), fold("quarter").alias("quarter"), "lat", "lon", F.explode("namesakes").alias("id"))
    far = F.sqrt((F.col("lat") - F.col("e_lat")) ** 2 + (F.col("lon") - F.col("e_lon")) ** 2)
    hit = lambda ok, n: F.when(F.coalesce(ok, F.lit(False)), n).otherwise(0)
    count = hit(far < NEAR_DEGREES, NEAR_COUNTS) + hit(F.array_contains("zips", F.col("zip")), ZIP_COUNTS) + hit(F.array_contains("quarters", F.col("quarter")), QUARTER_COUNTS)
    judged = asked.join(known, "id", "left").withColumn("count", count)
    best = judged.groupBy("row").agg(F.min(F.struct((-F.col("count")).alias("c"), F.coalesce(far, F.lit(1e9)).alias("far"), "id")).alias("b"))
    return best.select(F.col("row").alias(row_id), F.col("b.id").alias("id"), (F.col("b.c") < 0).alias("settled"))


def exact_names(reference: DataFrame, name: str, entry_id: str) -> DataFrame:
    """Names that exactly one entry bears."""
    return reference.where(F.col(entry_id).rlike(r"\S")).groupBy(name).agg(F.countDistinct(entry_id).alias("n")).where("n = 1").select(name)

