"""JSON filter maps as column expressions (JSON-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import col_of

# Texts that count as true.
TRUE_TEXTS = ["1", "true", "yes", "on"]


def _value(filters: str | Column, key: str) -> Column:
    return F.try_variant_get(F.try_parse_json(col_of(filters)), f"$.{key}", "variant")


def json_truthy(filters: str | Column, key: str) -> Column:
    """JSON-2: a boolean as it is, a number when it is 1, a text when it is one of ``TRUE_TEXTS``
    (trimmed, any case); everything else, a missing key and broken JSON are false."""
    v = _value(filters, key)
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.lower(F.trim(text)).isin(TRUE_TEXTS))
        .otherwise(F.try_variant_get(v, "$", "double") == 1), F.lit(False))


def json_int(filters: str | Column, key: str) -> Column:
    """JSON-2: a number's whole part; anything else is NULL."""
    v = _value(filters, key)
    return F.when(~F.schema_of_variant(v).isin("STRING", "BOOLEAN"), F.try_variant_get(v, "$", "double").cast("long"))


def json_codes(filters: str | Column, key: str) -> Column:
    """JSON-2: a list of texts, trimmed, upper-cased, blanks dropped; not a list: empty."""
    items = F.try_variant_get(F.try_parse_json(col_of(filters)), f"$.{key}", "array<string>")
    return F.coalesce(F.filter(F.transform(items, lambda x: F.upper(F.trim(x))), lambda x: x != ""), F.array().cast("array<string>"))
