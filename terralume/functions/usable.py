"""Values that stand in for a missing one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are typed where nothing is known, folded to lower case without accents and outer marks.
PLACEHOLDER_WORDS = [
    "na", "n/a", "nd", "n/d", "n.d", "ni", "n/i", "n.i", "n.a", "s/n", "nan", "nat", "nil", "null", "none", "nulo", "nenhum", "nenhuma", "vazio",
    "nao informado", "nao informada", "nao disponivel", "nao consta", "sem informacao", "sem informacoes", "sem cep", "sem nome", "indefinido", "indefinida",
    "a consultar", "a combinar", "consultar", "consulte", "desconhecido", "desconhecida", "outro", "outros", "teste", "test", "invalid", "unknown", "undefined", "tbd",
]

#: Letters with marks and what they fold to.
_MARKED = "àáâãäåèéêëìíîïòóôõöùúûüçñýÿ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"


def fold(text: Column) -> Column:
    """Lower case, without accents (composed or combining)."""
    return F.regexp_replace(F.translate(F.lower(text), _MARKED, _PLAIN), r"\p{M}+", "")


def source_name(source: Column) -> Column:
    """A source's name as it is compared: lower case, no outer blanks; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", "")), F.lit(""))


def usable_text(text: Column) -> Column:
    """Whether a text has a letter or digit and is no placeholder: no such word, and not one letter (x, z) over and over."""
    s = F.regexp_replace(fold(text), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.coalesce((F.length(s) > 0) & ~s.isin(PLACEHOLDER_WORDS) & ~s.rlike(r"^([xz])\1+$"), F.lit(False))


def usable_zip(text: Column, digits: int = 8) -> Column:
    """Whether a zip code has all its digits and isn't one digit over and over."""
    d = F.regexp_replace(text, r"[\s.\-]", "")
    return F.coalesce(d.rlike(rf"^\d{{{digits}}}$") & ~d.rlike(r"^(\d)\1+$"), F.lit(False))


def usable_amount(value: Column) -> Column:
    """Whether an amount of money is real: above one, not a digit repeated five times or more, not digits counted up."""
    s = value.cast("bigint").cast("string")
    counted = reduce(lambda a, b: a | b, [s == "123456789"[:n] for n in range(5, 10)] + [s == "1234567890"])
    return F.coalesce((value > 1) & ~s.rlike(r"^(\d)\1{4,}$") & ~counted, F.lit(False))


def usable_count(value: Column) -> Column:
    """Whether a count of rooms, places or floors is real: zero is, negative numbers and nines over and over (99, 999) are not."""
    return F.coalesce((value >= 0) & ~value.cast("bigint").cast("string").rlike(r"^9{2,}$"), F.lit(False))
