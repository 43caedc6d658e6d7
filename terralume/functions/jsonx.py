"""JSON in text columns, read as variants: elements of the wrong kind are passed over, malformed texts are empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def objects(text: Column) -> Column:
    """The objects of a JSON array; an empty array for anything else."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.coalesce(F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT")), F.array().cast("array<variant>"))


def find_by_name(items: Column, *names: str) -> Column:
    """The first object with one of these names."""
    return F.get(F.filter(items, lambda v: F.lower(F.trim(_text(v, "$.name"))).isin(*names)), F.lit(0))


def find_by_label(items: Column, part: str) -> Column:
    """The first object whose label has ``part`` in it."""
    return F.get(F.filter(items, lambda v: F.lower(F.trim(_text(v, "$.label"))).contains(part)), F.lit(0))


def value_of(items: Column, names: list[str], label_part: str | None = None) -> Column:
    """The value of the object found by name, else by label; an object found without value doesn't fall through."""
    item = find_by_name(items, *names)
    return _text(F.coalesce(item, find_by_label(items, label_part)) if label_part else item, "$.value")


def has_label(items: Column, names: list[str], label: str) -> Column:
    """Whether an object of these names has ``label`` in its value or among its values' labels."""

    def one(v: Column) -> Column:
        values = F.coalesce(F.try_variant_get(v, "$.values", "array<variant>"), F.array().cast("array<variant>"))
        listed = F.exists(values, lambda x: F.coalesce(F.lower(F.trim(_text(x, "$.label"))) == label, F.lit(False)))
        return F.lower(F.trim(_text(v, "$.name"))).isin(*names) & (F.coalesce(F.lower(_text(v, "$.value")).contains(label), F.lit(False)) | listed)

    return F.exists(items, lambda v: F.coalesce(one(v), F.lit(False)))


def prop(text: Column, path: str) -> Column:
    """One property of a JSON object as text."""
    return F.get_json_object(text, path)


def all_props(items: Column) -> Column:
    """Name to value; of repeated names the last."""
    named = F.filter(items, lambda v: _text(v, "$.name").isNotNull())
    return F.aggregate(named, F.create_map().cast("map<string,string>"), lambda m, v: F.map_concat(F.map_filter(m, lambda k, _: k != F.lower(F.trim(_text(v, "$.name")))), F.create_map(F.lower(F.trim(_text(v, "$.name"))), _text(v, "$.value"))))
