"""Record sources: text files (one record per line or per file), message
buses when their connector is installed, start positions, and read-backs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin repartition of a batch input when asked for.

    Worth it only for a small input that is one file with one row group: it is
    scanned by one task and the parse that follows is CPU-bound. Inputs of many
    files have enough splits; leave ``partitions`` unset for them.
    """
    return df.repartition(partitions) if partitions and not df.isStreaming else df


# Start positions of a stream source.
START_POSITIONS = ("TRIM_HORIZON", "LATEST", "AT_TIMESTAMP")


def now_text() -> str:
    """The present instant as text with its zone."""
    return dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")


def epoch_millis(timestamp: str) -> int:
    """Epoch milliseconds of an ISO date or date-time; UTC unless it names a zone."""
    t = dt.datetime.fromisoformat(timestamp.strip().replace("Z", "+00:00"))
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


def start_at(df: DataFrame, position: str, timestamp: str | None, ts_col: str) -> DataFrame:
    """Keep records at or after a start position, by ``ts_col``.

    ``TRIM_HORIZON`` keeps everything, ``AT_TIMESTAMP`` keeps records from
    ``timestamp`` on, ``LATEST`` keeps records from ``timestamp`` on if given (the time a
    stream first started, see the job), else from the moment of the call.
    """
    position = position.upper()
    if position not in START_POSITIONS:
        raise ValueError(f"unknown start position {position!r}")
    if position == "AT_TIMESTAMP":
        if not timestamp:
            raise ValueError("AT_TIMESTAMP needs a timestamp")
        return df.where(F.col(ts_col) >= F.lit(timestamp).cast("timestamp"))
    if position == "LATEST":
        return df.where(F.col(ts_col) >= F.lit(timestamp or now_text()).cast("timestamp"))
    return df


def open_source(spark: SparkSession, kind: str, options: Mapping[str, str], streaming: bool = True,
                start_position: str = "TRIM_HORIZON", timestamp: str | None = None,
                partitions: int | None = None) -> DataFrame:
    """``(value string, seq long, arrival_time timestamp, source string)`` records.

    ``kind``:

    * ``text``      - one record per line of the files under ``options['path']``;
    * ``wholetext`` - one record per file;
    * ``kafka``     - the Kafka source (needs its connector on the classpath);
    * ``kinesis``   - the Kinesis source (needs its connector on the classpath).

    For files, ``arrival_time`` is the file's modification time and the start
    position filters on it (``AT_TIMESTAMP``), or keeps only files written
    after the query starts (``LATEST``). ``seq`` is the start of the record's
    split in its file; :func:`in_line_order` adds the line order.
    ``partitions`` spreads a batch read.
    """
    opts = dict(options)
    reader = spark.readStream if streaming else spark.read
    if kind in ("text", "wholetext"):
        path = opts.pop("path")
        r = reader.format("text").options(**opts)
        if kind == "wholetext":
            r = r.option("wholetext", "true")
        df = r.load(path)
        df = df.select(
            F.col("value"),
            F.col("_metadata.file_block_start").alias("seq"),
            F.col("_metadata.file_modification_time").alias("arrival_time"),
            F.col("_metadata.file_path").alias("source"))
    elif kind in ("kafka", "kinesis"):
        if kind == "kafka" and start_position.upper() == "TRIM_HORIZON":
            opts.setdefault("startingOffsets", "earliest")
        df = reader.format(kind).options(**opts).load()
        if kind == "kafka":
            df = df.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"),
                           F.col("timestamp").alias("arrival_time"), F.col("topic").alias("source"))
        else:
            df = df.select(F.col("data").cast("string").alias("value"), F.lit(None).cast("long").alias("seq"),
                           F.col("approximateArrivalTimestamp").alias("arrival_time"),
                           F.col("streamName").alias("source"))
    else:
        raise ValueError(f"unknown source kind {kind!r}")
    if kind in ("text", "wholetext"):
        df = start_at(df if streaming else in_line_order(df), start_position, timestamp, "arrival_time")
    return df if streaming else spread(df, partitions)


def in_line_order(df: DataFrame) -> DataFrame:
    """``seq`` rising along each file: the start of the record's split plus its row number in the task.

    A task reads no more bytes than a split has, and a line has a byte at
    least, so records of one split stay below those of the next. For batch
    frames, also those of a micro-batch; take it before any shuffle.
    """
    return df.withColumn("seq", F.col("seq") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def read_parquet_back(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Typed read of Parquet part files (declared schema when given)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
