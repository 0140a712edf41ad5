"""Geo point derived from row column names (no per-row Python).

Deliberate deviation, recorded here once: the source job meant "latitude first"
but its comparator only worked for a few upper-case layouts and dropped whole
events for others. This build implements the intent and never drops an event:

* latitude  = first column in document order whose lower-cased name contains
  ``lat``, whose value reads as a float, is finite and has ``|v| <= 90``;
* longitude = the same with ``lon`` and ``|v| <= 180``;
* both are needed, otherwise the point is ``(0, 0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.schemas import LOCATION_TYPE


def _candidates(data: Column, needle: str, bound: float) -> Column:
    values = F.transform(
        F.filter(F.map_entries(data), lambda e: F.lower(e["key"]).contains(needle)),
        lambda e: _as_float(e["value"]),
    )
    return F.filter(values, lambda v: v.isNotNull() & (F.abs(v) <= F.lit(bound)))


def _as_float(v: Column) -> Column:
    """Float read of any JSON value through its text, as a string-to-float parse does."""
    return F.try_variant_get(v, "$", "string").try_cast("float")


def latitude(data: Column) -> Column:
    return F.try_element_at(_candidates(data, "lat", 90.0), F.lit(1))


def longitude(data: Column) -> Column:
    return F.try_element_at(_candidates(data, "lon", 180.0), F.lit(1))


def location(data: Column) -> Column:
    """``struct<lat float, lon float>``; ``(0, 0)`` when no valid pair is found.

    The column names are joined and tested once for both needles; rows that
    cannot have a pair (most tables) skip the per-column candidate search.
    """
    lat, lon = latitude(data), longitude(data)
    point = F.struct(lat.alias("lat"), lon.alias("lon"))
    origin = F.struct(F.lit(0.0).cast("float").alias("lat"), F.lit(0.0).cast("float").alias("lon"))
    names = F.lower(F.array_join(F.map_keys(data), "\n"))
    maybe = F.coalesce(names.contains("lat") & names.contains("lon"), F.lit(False))
    # nested, so the candidate search is not hoisted out of the guarded branch
    found = F.when(maybe, F.when(lat.isNotNull() & lon.isNotNull(), point))
    return F.coalesce(found, origin).cast(LOCATION_TYPE)


def raw_location(data: Column) -> Column:
    """Unvalidated ``{"lat": ..., "lon": ...}`` JSON text from upper-case ``LAT``/``LON`` keys.

    Every matching column writes its JSON value, in document order and with no
    numeric or range test, so two ``LAT`` columns write ``lat`` twice and a
    side without a column is absent. A name holding both counts as ``LAT``.
    """
    hits = F.filter(F.map_entries(data), lambda e: e["key"].contains("LAT") | e["key"].contains("LON"))
    parts = F.transform(hits, lambda e: F.concat(
        F.when(e["key"].contains("LAT"), F.lit('"lat":')).otherwise(F.lit('"lon":')), F.to_json(e["value"])))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
