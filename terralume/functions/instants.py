"""Instants written in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column, offset: str = "-03:00") -> Column:
    """The instant that ``text`` names, or null if it names none.

    ISO dates and times with or without offset, day-first dates with slashes, and bare numbers (Unix
    seconds). A time without an offset is read at ``offset``; a date alone is its midnight there.
    """
    s = F.trim(text)
    iso = F.regexp_replace(s, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})$", "$1:$2")
    dated = iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}")
    full = F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(iso, F.lit("T00:00:00" + offset))).when(iso.rlike(r"(Z|z|[+-]\d{1,2}:\d{2})$"), iso).otherwise(F.concat(iso, F.lit(offset)))
    seconds = F.timestamp_seconds(F.when(s.rlike(r"^\d{1,11}(\.\d+)?$"), s).try_cast("double"))
    return F.when(dated, F.upper(full).try_cast("timestamp")).otherwise(seconds)
