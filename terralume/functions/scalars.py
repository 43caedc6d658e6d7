"""Column functions for raw listing fields: numbers, flags, dates, zip codes, URLs, text.

All are built-in expressions, so they stay in generated code and reach the scan where a filter uses them.
Casts never fail: what can't be read is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terralume.functions.places import STATES
from terralume.functions.usable import fold

PLAIN_NUMBER = r"^\s*-?\d+(\.\d+)?\s*$"
#: Three-letter months of card dates.
MONTHS = {"jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6, "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12}
TRUE_WORDS, FALSE_WORDS = ["1", "true", "sim", "yes"], ["0", "false", "nao", "não", "no"]


def missing(c: Column) -> Column:
    """Null or empty."""
    return c.isNull() | (c == "")


def blank(c: Column) -> Column:
    """Null, empty, or nothing but white space."""
    return c.isNull() | ~c.rlike(r"(?U)\S")


def pick(*columns: Column) -> Column:
    """The first that is not missing."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def pick_present(*columns: Column) -> Column:
    """The first that is not blank."""
    return F.coalesce(*[F.when(~blank(c), c) for c in columns])


def digits_int(text: Column) -> Column:
    """The digits of a text as one number: signs and separators vanish."""
    return F.nullif(F.regexp_replace(text, r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def to_int(text: Column) -> Column:
    """A whole number: plain numbers are cut towards zero, a unit of area is dropped, other texts give their digits."""
    bare = F.regexp_replace(text, r"\s*m[2²]\s*$", "")
    return F.when(bare.rlike(PLAIN_NUMBER), F.trim(bare).try_cast("double").try_cast("bigint")).otherwise(digits_int(bare))


def br_float(text: Column) -> Column:
    """A number with dots between thousands and a decimal comma."""
    kept = F.regexp_replace(F.replace(F.replace(F.trim(text), F.lit("."), F.lit("")), F.lit(","), F.lit(".")), r"[^0-9.\-]", "")
    return F.nullif(kept, F.lit("")).try_cast("double")


def to_float(text: Column) -> Column:
    """A plain number as it stands, anything else in the Brazilian way."""
    bare = F.regexp_replace(text, r"\s*m[2²]\s*$", "")
    return F.when(bare.rlike(PLAIN_NUMBER), F.trim(bare).try_cast("double")).otherwise(br_float(bare))


def plain_float(text: Column) -> Column:
    """A coordinate: no locale."""
    return F.trim(text).try_cast("double")


def flag(text: Column) -> Column:
    """True, false or null from words."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def zip_dashed(text: Column) -> Column:
    """The first ``ddddd-ddd`` or ``dddddddd`` that stands alone, with dash."""
    found = F.regexp_extract(text, r"\b(\d{5}-?\d{3})\b", 1)
    return F.when(found != "", F.concat(F.left(found, F.lit(5)), F.lit("-"), F.right(found, F.lit(3))))


def zip_digits(text: Column) -> Column:
    """Digits only, padded to eight; null if there are none or more than eight."""
    d = F.regexp_replace(text, r"[^0-9]", "")
    return F.when(F.length(d).between(1, 8), F.lpad(d, 8, "0"))


def zip_any(text: Column) -> Column:
    d = zip_digits(text)
    return F.coalesce(F.concat(F.left(d, F.lit(5)), F.lit("-"), F.right(d, F.lit(3))), zip_dashed(text))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(text), r"[^a-z0-9]+", "-"), r"^-|-$", "")


def token(text: Column) -> Column:
    """Lower case ASCII without outer blanks."""
    return F.regexp_replace(F.regexp_replace(fold(text), r"[^\x00-\x7F]", ""), r"^\s+|\s+$", "")


def key_text(text: Column) -> Column:
    """How a text takes part in a key: null is empty, lower case, no outer white space."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))


def half_even(value: Column) -> Column:
    """Rounded to a whole number, halves to the even one; null is 0."""
    return F.bround(F.coalesce(value, F.lit(0.0)), 0).cast("bigint")


def strip_tags(html: Column) -> Column:
    """Text without tags and repeated white space; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", " "), r"\s+", " ")
    return F.nullif(F.trim(bare), F.lit(""))


def compose(*texts: Column) -> Column:
    """Texts in paragraphs; missing ones are passed over."""
    return F.nullif(F.concat_ws("\n\n", *[F.nullif(t, F.lit("")) for t in texts]), F.lit(""))


def state_name(state: Column, city: Column) -> Column:
    """The one abbreviation that is written out, any other state as it is, and the state of the one town that tells it."""
    return F.when(state == "SP", "São Paulo").when(~missing(state), state).when(city == "São Paulo", "São Paulo")


def property_type(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.contains("apartamento"), "Apartamento").when(low.contains("casa"), "Casa").otherwise(F.nullif(F.trim(text), F.lit("")))


def first_nonzero(*amounts: Column) -> Column:
    """The first amount that is neither missing nor zero; the last one as it is."""
    return F.coalesce(*[F.nullif(a, F.lit(0).cast("bigint")) for a in amounts[:-1]], amounts[-1])


def business_from_url(url: Column) -> Column:
    return F.when(url.rlike("/aluguel/|/alugar/|/alugar$|/aluga-"), "rent").when(url.rlike("/venda/|/comprar/|/comprar$|/venda-"), "sale")


def flow_from_url(url: Column) -> Column:
    """rent or sale from the path of a URL, else from words in it that only one of the two has."""
    low = F.lower(url)
    words = token(low)
    rent, sale = words.rlike("aluguel|locacao|para-alugar|para-locar"), words.contains("venda")
    return F.when(low.contains("/aluguel/"), "rent").when(low.contains("/venda/"), "sale").when(rent & ~sale, "rent").when(sale & ~rent, "sale")


def slug_business(url: Column) -> Column:
    """rent or sale from the word that the last part of a listing's path begins with."""
    word = F.regexp_extract(url, r"/imovel/[^/?#]+/(aluguel|venda)", 1)
    return F.when(word == "aluguel", "rent").when(word == "venda", "sale")


def price(text: Column) -> Column:
    """A price: plain numbers are cut to whole ones, other texts give their digits; null without any, and for flags."""
    return F.when(F.lower(F.trim(text)).isin("true", "false"), F.lit(None).cast("bigint")).otherwise(to_int(text))


def first_zip(*texts: Column) -> Column:
    """The first zip code found in the texts, with dash."""
    return F.coalesce(*[zip_dashed(t) for t in texts])


def state_slug(text: Column) -> Column:
    """The slug of a state: abbreviations are written out."""
    names = F.create_map(*[x for code, name in STATES.items() for x in (F.lit(code), F.lit(name.replace(" ", "-")))])
    return F.coalesce(F.try_element_at(names, F.upper(F.trim(text))), slug(text))


def labelled_money(text: Column, label: str) -> Column:
    """The amount behind ``label: R$``; null if there is none."""
    return digits_int(F.nullif(F.regexp_extract(text, rf"(?i){label}[^:]*:\s*R\$\s*([\d.]+)", 1), F.lit("")))


def id_from_url(url: Column) -> Column:
    """``/imovel/<id>``, or the digits at the end of the path."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"/imovel/([^/?#]+)", 1), F.lit("")), F.nullif(F.regexp_extract(url, r"-(\d{6,})(?:[?#].*)?$", 1), F.lit("")))


def absolute_url(base: str, url: Column) -> Column:
    root = base.rstrip("/")
    return F.when(missing(url), None).when(url.rlike(r"^[a-z][a-z0-9+.\-]*:"), url).when(url.startswith("//"), F.concat(F.lit(base.split(":")[0] + ":"), url)).when(url.startswith("/"), F.concat(F.lit("/".join(root.split("/")[:3])), url)).otherwise(F.concat(F.lit(root + "/"), url))


def page_url(base: Column, page: Column) -> Column:
    joined = F.concat(base, F.when(base.contains("?"), "&").otherwise("?"))
    return F.when(page <= 1, F.concat(joined, F.lit("sf=1"))).otherwise(F.concat(joined, F.lit("sf=1&o="), page.cast("string")))


def lastmod_date(text: Column) -> Column:
    """The date of a last modification, in its own offset; ``yyyy-MM-dd...`` or ``yyyyMMdd``."""
    s = F.trim(text)
    return F.coalesce(F.try_to_date(F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(s, F.lit(10))), "yyyy-MM-dd"), F.try_to_date(F.when(s.rlike(r"^\d{8}($|T)"), F.left(s, F.lit(8))), "yyyyMMdd"))


def run_date(text: Column) -> Column:
    return F.try_to_date(F.when(text.rlike(r"^\d{2}-\d{2}-\d{4}$"), text), "dd-MM-yyyy")


def unix_iso(seconds: Column) -> Column:
    """Unix seconds as ISO text in UTC; null unless a whole number above zero."""
    n = F.trim(seconds.cast("string")).try_cast("bigint")
    return F.when(n > 0, F.date_format(F.timestamp_seconds(n), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def card_date(text: Column, on: Column) -> Column:
    """Dates of cards (``Hoje, 10:16``; ``Ontem, 23:33``; ``11 de abr, 03:26``) seen on the date ``on``, as ISO text at −03:00.

    A day and month later than ``on`` are of the year before.
    """
    s = fold(F.trim(text))
    hour, minute = (F.regexp_extract(s, r"(\d{1,2}):(\d{2})\s*$", g) for g in (1, 2))
    day = F.regexp_extract(s, r"^(\d{1,2})\s+de\s+([a-z]{3,})", 1).try_cast("int")
    months = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    month = F.try_element_at(months, F.left(F.regexp_extract(s, r"^(\d{1,2})\s+de\s+([a-z]{3,})", 2), F.lit(3)))
    this = F.try_to_date(F.concat_ws("-", F.year(on), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")
    earlier = F.try_to_date(F.concat_ws("-", F.year(on) - 1, F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")
    date = F.when(s.startswith("hoje"), on).when(s.startswith("ontem"), F.date_sub(on, 1)).when(this > on, earlier).otherwise(this)
    valid = (hour.try_cast("int") < 24) & (minute.try_cast("int") < 60)
    return F.when(date.isNotNull() & valid, F.concat(date.cast("string"), F.lit("T"), F.lpad(hour, 2, "0"), F.lit(":"), minute, F.lit(":00-03:00")))


def point(text: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of ``POINT(lon lat)``."""
    pattern = r"(?i)POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)"
    return tuple(F.nullif(F.regexp_extract(text, pattern, g), F.lit("")).try_cast("double") for g in (2, 1))


def merged_tags(*tags: Column) -> Column:
    """Names of sources put together with ``+``, each once, in order."""
    return F.nullif(F.array_join(F.array_distinct(F.filter(F.array(*tags), lambda t: t.isNotNull() & (t != ""))), "+"), F.lit(""))
