"""Brazilian states and the spellings of places."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from terralume.functions.usable import fold

#: Abbreviation and name of the 27 federal units, folded.
STATES = {
    "AC": "acre", "AL": "alagoas", "AP": "amapa", "AM": "amazonas", "BA": "bahia", "CE": "ceara", "DF": "distrito federal", "ES": "espirito santo", "GO": "goias",
    "MA": "maranhao", "MT": "mato grosso", "MS": "mato grosso do sul", "MG": "minas gerais", "PA": "para", "PB": "paraiba", "PR": "parana", "PE": "pernambuco", "PI": "piaui",
    "RJ": "rio de janeiro", "RN": "rio grande do norte", "RS": "rio grande do sul", "RO": "rondonia", "RR": "roraima", "SC": "santa catarina", "SP": "sao paulo", "SE": "sergipe", "TO": "tocantins",
}

def _misread() -> dict[str, str]:
    """What the bytes of a marked letter look like when they are read one by one, in lower case, and the plain letter."""
    letters = "áàâãäéèêëíìîïóòôõöúùûüçñ"
    pairs = {}
    for letter in letters + letters.upper():
        for charset in ("latin-1", "cp1252"):
            try:
                pairs[letter.encode().decode(charset).lower()] = unicodedata.normalize("NFKD", letter)[0].lower()
            except UnicodeDecodeError:
                pass
    return {k: v for k, v in pairs.items() if not k.isalpha() or k[1] in "ªºµ"}


_MISREAD = _misread()


def plain(text: Column) -> Column:
    """Lower case without accents; marked letters that were read byte by byte are put right first."""
    low = F.lower(text)
    put_right = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), _MISREAD.items(), low)
    return fold(F.when(low.contains("ã") | low.contains("â"), put_right).otherwise(low))


def state_code(text: Column) -> Column:
    """The abbreviation of a state written as such, by name, or with ``BR-``, ``Estado:`` or both forms; null otherwise."""
    s = F.trim(F.regexp_replace(F.regexp_replace(plain(text), r"^\s*(estado( d[aeo])?\s*:?|br\s*-)\s*", ""), r"\s*\([a-z]{2}\)\s*$", ""))
    names = F.create_map(*[x for code, name in STATES.items() for x in (F.lit(name), F.lit(code), F.lit(code.lower()), F.lit(code))])
    return F.try_element_at(names, s)


STATE_PATTERN = "|".join(sorted([*STATES.values(), *(c.lower() for c in STATES)], key=len, reverse=True))
