"""Postal addresses taken apart: kind and name of the street, number, unit, town."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from terralume.functions.places import _MISREAD, STATES
from terralume.functions.usable import PLACEHOLDER_WORDS
from terralume.llm.canonical_values import ABBREVIATIONS

#: Kinds of street and how they are abbreviated, folded.
KINDS = {
    "rua": ["rua", "r"], "avenida": ["avenida", "av", "aven", "avda"], "travessa": ["travessa", "trav", "tv", "trv"], "alameda": ["alameda", "al", "alam"], "praca": ["praca", "pca", "pc", "pr"],
    "estrada": ["estrada", "estr", "est", "etr"], "rodovia": ["rodovia", "rod", "rodov"], "largo": ["largo", "lgo", "lg"], "viela": ["viela", "vla"], "beco": ["beco", "bc"], "ladeira": ["ladeira", "lad"], "passagem": ["passagem", "psg"], "via": ["via"],
}
#: Titles in names of streets and how they are abbreviated, folded.
TITLES = {
    "professor": ["prof"], "professora": ["profa"], "doutor": ["dr"], "doutora": ["dra"], "visconde": ["visc", "vde", "visc"], "coronel": ["cel", "cor"], "capitao": ["cap", "capt"], "engenheiro": ["eng", "engo"], "comendador": ["com", "comend"], "general": ["gen", "gal"], "senador": ["sen"],
    "presidente": ["pres"], "governador": ["gov"], "deputado": ["dep"], "major": ["maj"], "tenente": ["ten"], "marechal": ["mal", "mar"], "almirante": ["alm"], "barao": ["bar"], "padre": ["pe"], "vereador": ["ver"], "desembargador": ["des"], "brigadeiro": ["brig"], "conselheiro": ["cons"], "dom": ["d"], "santa": ["sta"], "santo": ["sto"],
}
#: Kinds of neighbourhood and how they are abbreviated, folded.
QUARTERS = {"vila": ["vl", "v"], "jardim": ["jd", "jrd", "jardins", "jdm"], "parque": ["pq", "pque", "prq"], "bairro": ["b", "bo", "br"], "residencial": ["res", "resid"], "conjunto": ["conj", "cj", "cjto"], "alto": ["at"], "centro": ["ctr"], "nucleo": ["nuc"]}
PARTICLES = {"da", "de", "do", "das", "dos", "d", "e"}
#: What is typed for a town where none is named.
NO_TOWN = {"zona rural", "interior", "litoral", "cidade", "regiao metropolitana", "outro municipio", "todas as cidades"}
_KIND_OF = {a: k for k, forms in KINDS.items() for a in forms}
_TITLE_OF = {a: k for k, forms in TITLES.items() for a in forms}
_QUARTER_OF = {a: k for k, forms in QUARTERS.items() for a in forms}
_TOWN_WORD = {a: words[0] for a, words in ABBREVIATIONS.items() if a not in ("s", "n")} | {"n": "nova", "s": "sao"}
_UNIT = re.compile(r"\b(?:apartamento|apartament|apto|apt|ap|unidade|unid|un|bloco|bl|sala|sl|cj)\.?\s*(?:no\.?\s*)?(\d+[a-z]?)\b")
_NUMBER = re.compile(r"(?:\b(?:numero|num|nro|nr|no|n)\.?\s*)?(?<![\d.])(\d{1,3}(?:\.\d{3})+|\d{1,6})(?![\d])\b")
_SPLIT = re.compile(r"\s*,\s*|\s+-\s+|\s*/\s*|\s*;\s*|\s*\|\s*")
_WORDS = re.compile(r"[a-z0-9]+")
_STATE_WORDS = {*STATES.values(), *(c.lower() for c in STATES)}
_MARKS = re.compile("[\u0300-\u036f]+")
_MISREAD_RE = re.compile("|".join(map(re.escape, _MISREAD)))


@dataclass(frozen=True)
class Address:
    kind: str
    name: tuple[str, ...]
    number: str
    unit: str
    town: str
    quarter: str


def fold(text: str | None) -> str:
    if not text:
        return ""
    low = text.lower().replace("°", "o")
    if "ã" in low or "â" in low:
        low = _MISREAD_RE.sub(lambda m: _MISREAD[m[0]], low)
    if low.isascii():
        return low
    bare = _MARKS.sub("", unicodedata.normalize("NFKD", low))
    return bare if bare.isascii() else "".join(c for c in bare if not unicodedata.combining(c))


@lru_cache(200_000)
def town_key(city: str | None) -> str:
    """The words of a town without state and filling words; empty if none is named."""
    s = re.sub(r"\s+", " ", fold(city)).strip()
    s = re.sub(r"^(municipio|cidade) d[eoa]s? ", "", s)
    if s.strip(" .-?*") in PLACEHOLDER_WORDS:
        return ""
    parts = [p for p in re.split(r"\s*/\s*|\s*,\s*|\s+-\s+|\s*\(", s) if p.strip(" .)") and p.strip(" .)") not in _STATE_WORDS] or [s]
    typed = _WORDS.findall(parts[0])
    words = [_TOWN_WORD.get(w, w) if len(w) > 1 or not i else w for i, w in enumerate(typed)]
    if typed[:2] in (["n", "sra"], ["n", "s"], ["n", "senhora"]):
        words[:2] = ["nossa", "senhora"]
    joined = " ".join(words)
    return "" if joined in PLACEHOLDER_WORDS or joined in NO_TOWN or joined.replace(" ", "") in ("nd", "na", "ni") else joined


@lru_cache(100_000)
def quarter_key(text: str | None) -> str:
    words = [_QUARTER_OF.get(w, w) for w in _WORDS.findall(fold(text))]
    joined = " ".join(words)
    if joined in PLACEHOLDER_WORDS:
        return ""
    return " ".join(words[1:]) if len(words) > 1 and words[0] == "bairro" else joined


@lru_cache(100_000)
def _plain(text: str | None) -> str:
    return " ".join(_WORDS.findall(fold(text)))


def _street_words(segment: str) -> tuple[str, tuple[str, ...]]:
    words = _WORDS.findall(segment)
    kind = ""
    if len(words) > 1 and words[0] in _KIND_OF:
        kind, words = _KIND_OF[words[0]], words[1:]
    if len(words) > 1 and words[0] in _TITLE_OF:
        words = [_TITLE_OF[words[0]], *words[1:]]
    return kind, tuple(w for w in words if w not in PARTICLES)


def _take_apart(text: str, drop: set[str]) -> tuple[str, tuple[str, ...], str, str, list[str]]:
    """(kind, name, number, unit, other segments) of one text."""
    s = fold(text)
    unit = ""
    if m := _UNIT.search(s):
        unit, s = m[1], s[: m.start()] + " , " + s[m.end() :]
    number, mark = "", -1
    if m := _NUMBER.search(s):
        number, s, mark = m[1].replace(".", "").lstrip("0"), s[: m.start()] + " , " + s[m.end() :], m.start()
    best, before, after, others, at = None, None, None, [], 0
    for seg in _SPLIT.split(s):
        at = s.find(seg, at)
        plain = " ".join(_WORDS.findall(seg))
        first = plain.split(" ", 1)[0]
        street = first in _KIND_OF and " " in plain  # such a segment is no other spelling of a town or neighbourhood
        if not plain or plain in drop or plain in _STATE_WORDS or (not street and (town_key(seg) in drop or quarter_key(seg) in drop)):
            continue
        if best is None and street:
            best = seg
        elif mark >= 0 and at < mark:
            before = seg
            others.append(seg)
        else:
            after = after or seg
            others.append(seg)
    chosen = best or before or after
    if chosen is None:
        return "", (), number, unit, others
    kind, name = _street_words(chosen)
    return kind, name, number, unit, [o for o in others if o is not chosen]


def parse(street: str | None, address: str | None, neighbourhood: str | None, city: str | None) -> Address:
    """What a row says of its address; empty text and ``()`` for what it doesn't say."""
    quarter, town = quarter_key(neighbourhood), town_key(city)
    drop = {x for x in (quarter, town, _plain(neighbourhood), _plain(city)) if x}
    kind, name, number, unit, others = _take_apart(street, drop) if street and street.strip() else ("", (), "", "", [])
    if address and address.strip():
        kind2, name2, number2, unit2, others2 = _take_apart(address, drop)
        if not name:
            kind, name, others = kind2, name2, others2
        number, unit = number or number2, unit or unit2
    if not town and others:
        town = town_key(others[-1]) if len(others) > 1 or quarter else ""
    return Address(kind, name, number, unit, town, quarter)
