"""Small helpers over VARIANT row values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(v: Column) -> Column:
    """Text of a JSON value: strings as they are, numbers and booleans printed,
    objects and arrays as JSON, JSON null as SQL NULL."""
    return F.try_variant_get(v, "$", "string")


def text_map(m: Column) -> Column:
    """``map<string,variant>`` -> ``map<string,string>`` (same text as :func:`as_text`).

    A cast of the whole map, not a per-value lambda: it stays in generated code.
    """
    return m.try_cast("map<string,string>")


def kind(v: Column) -> Column:
    """Variant type name: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(v)


def field(data: Column, name: str, type_: str = "string") -> Column:
    """Typed read of one row column from the dynamic ``data`` map."""
    return F.try_variant_get(F.try_element_at(data, F.lit(name)), "$", type_)
