"""Search-field type of a JSON value, and the ISO-instant test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.variants import as_text, kind

# An instant as the standard ISO-8601 instant parser takes it
# (seconds required, fraction of up to nine digits, zone "Z" only).
ISO_INSTANT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?Z$"

# Keyword sub-field limit.
KEYWORD_IGNORE_ABOVE = 256


def is_iso_instant(text: Column) -> Column:
    """Shape by pattern, calendar validity by cast: neither alone is enough."""
    return (F.coalesce(text.rlike(ISO_INSTANT_PATTERN), F.lit(False))
            & text.try_cast("timestamp").isNotNull())


def es_type(v: Column) -> Column:
    """``date`` | ``long`` | ``text`` | ``float`` for one row value.

    Integers that fit 64 bits are ``long``; fractions (DECIMAL or DOUBLE) are
    ``float``; integers beyond 64 bits, booleans and nested values fall back to
    ``text``, as does anything not recognised. A JSON null is ``null``: it says
    nothing about its field.
    """
    return type_of(kind(v), as_text(v))


def type_of(k: Column, text: Column) -> Column:
    """:func:`es_type` of a value of this kind and text."""
    big_integer = k.rlike(r"^DECIMAL\((19|[2-9][0-9]|[1-9][0-9]{2,}),0\)$")
    return (F.when((k == "STRING") & is_iso_instant(text), F.lit("date"))
            .when(k == "BIGINT", F.lit("long"))
            .when(k == "VOID", F.lit("null"))
            .when(k == "STRING", F.lit("text"))
            .when(k.startswith("DECIMAL") & ~big_integer, F.lit("float"))
            .when(k.isin("DOUBLE", "FLOAT"), F.lit("float"))
            .otherwise(F.lit("text")))
