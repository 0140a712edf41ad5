"""Envelope and search-document text, built as maps and serialised once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def envelope_json(metadata: Column, data: Column) -> Column:
    """``{"metadata": {...}, "data": {...}}``; the derived location is not written."""
    return F.to_json(F.struct(metadata.alias("metadata"), data.alias("data")), _KEEP_NULLS)


# Document fields taken from the envelope, not from the row.
ENVELOPE_FIELDS = ("location", "metadata")


def _document(data: Column, location_json: Column, metadata: Column, empty: str = "") -> Column:
    """``{row columns..., "location": ..., "metadata": {...}}`` as JSON text.

    Row columns named like an envelope field are dropped first, so the
    envelope wins (the map filter only runs for rows that have such a column).
    The text is spliced from three serialised parts instead of merging maps.
    """
    data = F.coalesce(data, F.create_map().cast("map<string,variant>"))
    clash = F.map_contains_key(data, ENVELOPE_FIELDS[0]) | F.map_contains_key(data, ENVELOPE_FIELDS[1])
    rows = F.when(clash, F.map_filter(data, lambda k, _v: ~k.isin(*ENVELOPE_FIELDS))).otherwise(data)
    body = F.to_json(rows, _KEEP_NULLS)
    tail = F.concat(F.lit('"location":'), F.coalesce(location_json, F.lit("null")),
                    F.lit(',"metadata":'), F.coalesce(F.to_json(metadata), F.lit("null")), F.lit("}"))
    return F.when(F.size(rows) == 0, F.concat(F.lit("{" + empty), tail)).otherwise(
        F.concat(F.regexp_replace(body, r"\}$", ","), tail))  # names ``body`` once: it is serialised per mention


def search_document(data: Column, location: Column, metadata: Column) -> Column:
    """Row columns at top level, plus ``location: {lat, lon}`` and ``metadata``."""
    return _document(data, F.to_json(location), metadata)


def search_document_array(data: Column, location: Column, metadata: Column) -> Column:
    """Document with ``location`` as ``[lat, lon]`` (null when absent); an empty row is ``"data": null``.

    A search engine reads a geo-point array as ``[lon, lat]``; prefer
    :func:`search_document`, which writes the object form.
    """
    pair = F.when(location.isNotNull(), F.to_json(F.array(location["lat"], location["lon"])))
    return _document(data, pair, metadata, '"data":null,')


def search_document_raw(data: Column, raw_location: Column, metadata: Column) -> Column:
    """Document whose location is JSON text copied unvalidated from ``LAT``/``LON`` columns."""
    return _document(data, raw_location, metadata)


def comma_line(*cols: Column) -> Column:
    """``a,b,c`` where a null prints ``null`` (string concatenation semantics)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(","))
        parts.append(F.coalesce(c.cast("string"), F.lit("null")))
    return F.concat(*parts)
