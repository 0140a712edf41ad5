"""Partition columns for file sinks (hour, month, location layouts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone the hourly JSON layout is cut in.
HOUR_LAYOUT_ZONE = "-05:00"


def hour_parts(ts: Column, zone: str = HOUR_LAYOUT_ZONE) -> list[Column]:
    """``year, month, day, hour`` strings (zero-padded) of ``ts`` seen in ``zone``."""
    local = F.from_utc_timestamp(ts, zone)
    return [F.date_format(local, "yyyy").alias("year"), F.date_format(local, "MM").alias("month"),
            F.date_format(local, "dd").alias("day"), F.date_format(local, "HH").alias("hour")]


def month_parts(ts: Column) -> list[Column]:
    return [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month")]


def pickup_location_part(location_id: Column) -> Column:
    """Three-digit, zero-padded location id."""
    return F.lpad(location_id.cast("string"), 3, "0").alias("pickup_location")
