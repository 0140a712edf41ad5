"""Stable document ids: MD5 of the MD5 digest of a canonical row text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.variants import as_text, text_map


def _sized(text: Column) -> Column:
    """``length:text``, so that joined parts can be told apart whatever they hold."""
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def canonical_text(data: Column) -> Column:
    """``{k1=v1, k2=v2}`` with keys in byte order and JSON null printed ``null``.

    Map text in the original job followed a hash-map order, which is no
    contract; sorted keys make the id stable across engines and runs. Keys are
    unique (parsing keeps the last duplicate), so sorting the entries sorts by
    key; ``sort_array`` needs no comparator lambda.
    """
    entries = F.sort_array(F.map_entries(text_map(data)))
    pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def double_md5(text: Column) -> Column:
    """Lower-case hex of ``md5(md5_bytes(text))``."""
    return F.md5(F.unhex(F.md5(text)))


def content_id(data: Column) -> Column:
    """Id of the whole row content: any changed column gives a new document."""
    return double_md5(canonical_text(data))


def key_text(schema_name: Column, table_name: Column, data: Column, key_columns: Sequence[str]) -> Column:
    """``len:schema.table{k1=len:v1, k2=len:v2}`` over the key columns, in the given order.

    Lengths make the text injective: no value can pass for two. Null when a key
    column is absent or null; such a row has no key.
    """
    pairs = [F.concat(F.lit(f"{k}="), _sized(as_text(F.try_element_at(data, F.lit(k))))) for k in key_columns]
    joined = pairs[0]
    for p in pairs[1:]:
        joined = F.concat(joined, F.lit(", "), p)
    return F.concat(_sized(F.coalesce(schema_name, F.lit(""))), F.lit("."), table_name, F.lit("{"), joined, F.lit("}"))


def key_id(schema_name: Column, table_name: Column, data: Column, key_columns: Sequence[str]) -> Column:
    """Id of the primary key: every version of a row maps to one document.

    The schema-qualified table name salts the key so equal keys of two tables
    sharing an index never collide.
    """
    return double_md5(key_text(schema_name, table_name, data, key_columns))
