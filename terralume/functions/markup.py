"""Text of marked-up columns."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _decoded(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """Entities decoded; Spark has no such function, so texts with an ``&`` go through Python in Arrow batches, others don't change."""
    return F.when(text.contains("&"), _decoded(F.when(text.contains("&"), text))).otherwise(text)


def clean_text(text: Column) -> Column:
    """Entities decoded, tags and repeated white space gone; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(unescape(text), r"<[^>]*>", " "), r"(?U)\s+", " ")
    return F.nullif(F.regexp_replace(bare, r"(?U)^\s+|\s+$", ""), F.lit(""))


def clean_description(text: Column) -> Column:
    """Entities decoded and outer white space gone; tags stay."""
    return F.nullif(F.regexp_replace(unescape(text), r"(?U)^\s+|\s+$", ""), F.lit(""))
