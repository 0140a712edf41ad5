"""Event-time rollups: tumbling counts per table, sessions, stream health.

All of them are plain ``groupBy`` aggregations (partial aggregation before the
shuffle). In a stream, pass ``watermark`` to bound state and drop late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Defaults of the event-time job (watermark delay, window).
DEFAULT_WATERMARK = "100 milliseconds"
DEFAULT_WINDOW = "1 second"


def table_window_counts(df: DataFrame, size: str = DEFAULT_WINDOW, ts_col: str = "event_time",
                        key_col: str = "table_name", watermark: str | None = None) -> DataFrame:
    """``(window_start, window_end, table_name, n)`` per tumbling window."""
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    return (df.groupBy(F.window(ts_col, size).alias("w"), F.col(key_col))
              .agg(F.count("*").alias("n"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      F.col(key_col), "n"))


def session_counts_stream(df: DataFrame, gap: str, key_col: str, ts_col: str = "event_time",
                          watermark: str | None = None) -> DataFrame:
    """Native session windows (for streams): ``(key, session_start, session_end, n)``."""
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    return (df.groupBy(F.col(key_col), F.session_window(ts_col, gap).alias("s"))
              .agg(F.count("*").alias("n"))
              .select(F.col(key_col), F.col("s.start").alias("session_start"),
                      F.col("s.end").alias("session_end"), "n"))


def _interval_seconds(spec: str) -> int:
    num, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(num) * mult


def session_counts(df: DataFrame, gap: str, key_col: str, ts_col: str = "event_time") -> DataFrame:
    """Exact sessions in batch, safe for hot keys.

    A new session starts when the time since the previous event of the key is
    more than ``gap``; a session ends ``gap`` after its last event. This is
    the rule of Spark's ``session_window`` (an event exactly ``gap`` after the
    previous one still extends the session), so batch and stream agree.

    Events of a key inside one bucket of ``gap`` width always share a session,
    so a bucket is only ``(first, last, n)``: an aggregation with a map-side
    step, whatever share of all rows one key holds. The buckets are then
    chained per key; a key has at most one row per ``gap`` of its time range.
    """
    gap_us = _interval_seconds(gap) * 1_000_000
    t = F.unix_micros(F.col(ts_col))
    buckets = (df.select(F.col(key_col).alias("k"), t.alias("t")).where(F.col("t").isNotNull())
                 .groupBy("k", F.floor(F.col("t") / F.lit(gap_us)).alias("bucket"))
                 .agg(F.min("t").alias("s"), F.max("t").alias("e"), F.count("*").alias("n")))
    w = Window.partitionBy("k").orderBy("s")
    starts = F.coalesce(F.col("s") - F.lag("e").over(w) > F.lit(gap_us), F.lit(True))
    session = F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (buckets.withColumn("session", session).groupBy("k", "session")
                   .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"))
                   .select(F.col("k").alias(key_col), F.timestamp_micros("s").alias("session_start"),
                           F.timestamp_micros(F.col("e") + F.lit(gap_us)).alias("session_end"),
                           F.col("n").cast("long").alias("n")))


def stream_health(df: DataFrame, period: str = "1 minute", window_col: str = "arrival_time",
                  ts_col: str = "event_time", arrival_col: str = "arrival_time", value_col: str = "value",
                  stream_col: str | None = None, kept_col: str | None = None,
                  watermark: str | None = None) -> DataFrame:
    """Per-period records and bytes in, records kept, and delivery lag.

    Periods follow ``window_col`` (arrival by default, so records that never
    parsed are still counted); bytes are UTF-8. ``lag_ms`` is ``arrival - event
    time`` in milliseconds over the ``lag_records`` records whose event time is
    known: maximum, sum and average.
    """
    if watermark:
        df = df.withWatermark(window_col, watermark)
    lag = F.unix_millis(F.col(arrival_col)) - F.unix_millis(F.col(ts_col))
    keys = [F.window(window_col, period).alias("w")]
    if stream_col:
        keys.append(F.col(stream_col))
    kept = F.col(kept_col) if kept_col else F.lit(True)
    size = F.coalesce(F.octet_length(F.col(value_col)), F.lit(0)).cast("long")
    out = (df.groupBy(*keys)
             .agg(F.count("*").alias("records_in"),
                  F.sum(size).alias("bytes_in"),
                  F.sum(kept.cast("long")).alias("records_kept"),
                  F.sum(F.when(kept, size).otherwise(0)).alias("bytes_kept"),
                  F.count(lag).alias("lag_records"),
                  F.max(lag).alias("max_lag_ms"),
                  F.sum(lag).alias("sum_lag_ms"),
                  F.avg(lag).alias("avg_lag_ms")))
    cols = [F.col("w.start").alias("period_start")]
    if stream_col:
        cols.append(F.col(stream_col))
    return out.select(*cols, "records_in", "bytes_in", "records_kept", "bytes_kept", "lag_records", "max_lag_ms",
                      "sum_lag_ms", "avg_lag_ms")


def output_volume(docs: DataFrame, period: str = "1 minute", ts_col: str = "written_at",
                  doc_col: str = "doc", key_col: str = "index_name") -> DataFrame:
    """Rows and UTF-8 bytes written per period and index (the sink-side volume)."""
    return (docs.groupBy(F.window(ts_col, period).alias("w"), F.col(key_col))
                .agg(F.count("*").alias("rows_out"), F.sum(F.octet_length(doc_col).cast("long")).alias("bytes_out"))
                .select(F.col("w.start").alias("period_start"), F.col(key_col), "rows_out", "bytes_out"))
