"""File sinks, layouts and the one-pass fan-out used by batch and stream jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import documents, layout

# Fixed default: rows per output file, the stand-in for a size-based roll.
DEFAULT_MAX_RECORDS_PER_FILE = 1_000_000


def cluster_for_layout(df: DataFrame, parts: list[str]) -> DataFrame:
    """Bring the rows of a layout folder together before a partitioned write.

    Without it every task writes a file into every folder it sees (tasks x
    folders small files). The rebalance hint shuffles once by the layout
    columns, without sampling the input, and adaptive execution splits a hot
    folder over as many tasks as its measured size asks for.
    """
    return df.hint("rebalance", *[F.col(p) for p in parts])


def write_json_lines(df: DataFrame, path: str, ts_col: str = "event_time",
                     zone: str = layout.HOUR_LAYOUT_ZONE, by_table: bool = False,
                     mode: str = "append", max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                     cluster: bool = True) -> None:
    """Envelope JSON lines under ``[table_name=/]year=/month=/day=/hour=``.

    ``ts_col="event_time"`` buckets by event time; pass a processing-time
    column (``current_timestamp()``) for the original processing-time layout.
    """
    lines = df.withColumn("line", documents.envelope_json(F.col("metadata"), F.col("data")))
    write_lines(lines, path, ts_col, zone, by_table, mode, max_records_per_file, cluster)


def write_lines(df: DataFrame, path: str, ts_col: str = "event_time", zone: str = layout.HOUR_LAYOUT_ZONE,
                by_table: bool = False, mode: str = "append", max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                cluster: bool = True) -> None:
    """Ready lines (column ``line``) in the same folders."""
    parts = (["table_name"] if by_table else []) + ["year", "month", "day", "hour"]
    lines = df.select(F.col("line").alias("value"), *parts[:-4], *layout.hour_parts(F.col(ts_col), zone))
    if cluster:
        lines = cluster_for_layout(lines, parts)
    (lines.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
          .partitionBy(*parts).text(path))


def table_month_columns(df: DataFrame, ts_col: str = "event_time") -> DataFrame:
    return df.withColumns({"year": F.date_format(ts_col, "yyyy"), "month": F.date_format(ts_col, "MM")})


def write_table_month_parquet(df: DataFrame, path: str, ts_col: str = "event_time", mode: str = "append",
                              cluster: bool = True) -> None:
    """Parquet under ``table_name=/year=/month=`` (Striim layout)."""
    out = table_month_columns(df, ts_col)
    if cluster:
        out = cluster_for_layout(out, ["table_name", "year", "month"])
    keep = [c for c in out.columns if c not in ("value",)]
    out.select(*keep).write.mode(mode).partitionBy("table_name", "year", "month").parquet(path)


def write_trip_parquet(df: DataFrame, path: str, mode: str = "append", cluster: bool = True) -> None:
    """Trips under ``pickup_location=NNN/year=/month=``."""
    out = df.select("*", layout.pickup_location_part(F.col("pickup_location_id")),
                    *layout.month_parts(F.col("pickup_datetime")))
    if cluster:
        out = cluster_for_layout(out, ["pickup_location", "year", "month"])
    out.write.mode(mode).partitionBy("pickup_location", "year", "month").parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "append") -> None:
    """One UTF-8 line per record."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def print_rows(df: DataFrame) -> None:
    """Every row as one line on the standard output of the task that holds it."""
    def show(rows):
        for row in rows:
            print("|".join("null" if v is None else str(v) for v in row))
    df.foreachPartition(show)


def restream_records(df: DataFrame, partition_key: str | None = "0") -> DataFrame:
    """``(key, value)`` rows for a message-bus sink: envelope JSON value under a fixed key (all rows
    in one bus partition, in order), or under the document's id when ``partition_key`` is None."""
    key = F.lit(partition_key) if partition_key is not None else F.col("doc_id")
    return df.select(key.alias("key"),
                     documents.envelope_json(F.col("metadata"), F.col("data")).alias("value"))


def document_rows(routed: DataFrame) -> DataFrame:
    """What the document sink stores per version."""
    source = [c for c in ("arrival_time", "source", "seq") if c in routed.columns]
    return routed.select("index_name", "doc_id", "doc", "is_delete", "operation", "event_time", *source)
