"""The change-stream job: one source, parse, quarantine, route, fan out.

``run(spark, options)`` starts a Structured Streaming query whose every
micro-batch goes through :func:`fan_out` once (``foreachBatch``), so each
chosen sink reads the same persisted batch instead of re-reading the source.
Every sink writes under ``batch_id=<id>`` (``run_id=<id>`` in batch runs), so a
batch replayed after a failure replaces its own output; the document state
knows the batches it holds and takes each once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.functions import documents
from tributary.operators import bulk, routing, state
from tributary.operators import envelope as env
from tributary.session import prepare
from tributary.sources.files import epoch_millis, in_line_order, now_text, open_source
from tributary.streaming import sinks

SOURCE_KEYS = ("input_path", "input_kafka_topic", "input_kinesis_stream")
OUTPUT_KEYS = ("output_documents", "output_document_log", "output_json", "output_parquet",
               "output_restream", "output_discarding", "output_console", "output_sinks", "output_bulk")

# Fixed value: quarantine reason of rows behind the watermark.
LATE = "late"


# Files per micro-batch unless set: a backlog is read in several batches, none of it is skipped.
DEFAULT_FILES_PER_TRIGGER = 1000


class JobConfigError(ValueError):
    pass


def validate(options: Mapping[str, Any], streaming: bool = False) -> None:
    """Exactly one source and at least one output; a stream names its checkpoint folder, since
    without one a restart would begin again at batch 0 and write over earlier output."""
    sources = [k for k in SOURCE_KEYS if options.get(k)]
    if len(sources) != 1:
        raise JobConfigError(
            f"specify exactly one source of {', '.join(SOURCE_KEYS)} (got {sources or 'none'})")
    if options.get("input_kafka_topic") and not options.get("input_kafka_bootstrap_servers"):
        raise JobConfigError("input_kafka_topic needs input_kafka_bootstrap_servers")
    if not any(options.get(k) for k in OUTPUT_KEYS):
        raise JobConfigError(f"specify at least one output of {', '.join(OUTPUT_KEYS)}")
    if options.get("start_position", "TRIM_HORIZON").upper() == "AT_TIMESTAMP" and not options.get("start_timestamp"):
        raise JobConfigError("start_position AT_TIMESTAMP needs start_timestamp")
    if streaming and not options.get("checkpoint_location"):
        raise JobConfigError("a streaming run needs checkpoint_location")
    if options.get("late_after") and not options.get("checkpoint_location"):
        raise JobConfigError("late_after needs checkpoint_location: the watermark is kept beside it")
    if options.get("late_after") and not options.get("output_quarantine"):
        raise JobConfigError("late_after needs output_quarantine: late rows go there")
    if int(options.get("sink_retries", 0)) < 0:
        raise JobConfigError("sink_retries cannot be negative")


def _prefixed(options: Mapping[str, Any], key: str) -> str | None:
    path = options.get(key)
    if not path or path is True:
        return path
    prefix = options.get("path_prefix", "")
    return f"{path.rstrip('/')}/{prefix}" if prefix else path


def _small_file(spark: SparkSession, path: str, text: str | None = None) -> str | None:
    """Text of a small file beside the checkpoint (``None`` if there is none); with ``text`` it is written."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if text is not None:
        out = fs.create(target, True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        return text
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _first_start(spark: SparkSession, checkpoint: str) -> str:
    """When the stream of this checkpoint first started; written once beside it, read on every restart."""
    path = f"{checkpoint.rstrip('/')}_started_at"
    return _small_file(spark, path) or _small_file(spark, path, now_text())


# Notes of older batches are deleted; Spark itself replays the last batch only.
KEEP_NOTES = 100


def _forget(spark: SparkSession, options: Mapping[str, Any], batch_id: int, names: Iterable[str]) -> None:
    jvm = spark.sparkContext._jvm
    for name in names if batch_id >= 0 else ():
        path = jvm.org.apache.hadoop.fs.Path(_batch_note(options, batch_id, name))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def _batch_note(options: Mapping[str, Any], batch_id: int, what: str) -> str:
    return f"{str(options['checkpoint_location']).rstrip('/')}_batches/{batch_id}.{what}"


def watermark_of(spark: SparkSession, options: Mapping[str, Any], batch_id: int) -> int | None:
    """The watermark a batch is judged by, in epoch microseconds: the one the batch before it ended with.

    It is the latest event time of all batches so far less ``late_after``. A replayed batch reads the
    same note again and judges alike."""
    note = _small_file(spark, _batch_note(options, batch_id - 1, "seen")) if batch_id > 0 else None
    seen = json.loads(note)["max_event_time"] if note else None
    return None if seen is None else seen - _micros(str(options["late_after"]))


def _micros(delay: str) -> int:
    n, unit = delay.split()
    scale = {"millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6, "day": 86400 * 10 ** 6}
    return int(n) * scale[unit.rstrip("s")]


def source_frame(spark: SparkSession, options: Mapping[str, Any], streaming: bool = True) -> DataFrame:
    pos, ts = options.get("start_position", "TRIM_HORIZON"), options.get("start_timestamp")
    if pos.upper() == "LATEST":
        # files written while the job was down are still to come, so a restart keeps the first start
        ts = _first_start(spark, options["checkpoint_location"]) if streaming and options.get("input_path") else None
    if options.get("input_path"):
        opts = {"path": options["input_path"]}
        if streaming and options.get("max_bytes_per_trigger"):
            opts["maxBytesPerTrigger"] = str(options["max_bytes_per_trigger"])
        elif streaming:
            opts["maxFilesPerTrigger"] = str(options.get("max_files_per_trigger", DEFAULT_FILES_PER_TRIGGER))
        return open_source(spark, options.get("input_kind", "text"), opts, streaming, pos, ts,
                           options.get("input_partitions"))
    if options.get("input_kafka_topic"):
        opts = {"kafka.bootstrap.servers": options["input_kafka_bootstrap_servers"],
                "subscribe": options["input_kafka_topic"]}
        if pos.upper() == "AT_TIMESTAMP":
            opts["startingTimestamp"] = str(epoch_millis(str(options["start_timestamp"])))
        elif pos.upper() == "LATEST":
            opts["startingOffsets"] = "latest"
        return open_source(spark, "kafka", opts, streaming, pos, ts)
    opts = {"streamName": options["input_kinesis_stream"],
            "initialPosition": pos.lower() if pos.upper() != "AT_TIMESTAMP" else "at_timestamp"}
    if options.get("input_region"):
        opts["region"] = options["input_region"]
    return open_source(spark, "kinesis", opts, streaming, pos, ts)


def parse_stage(records: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    if options.get("unbatch"):
        records = env.unbatch(records)
    if options.get("envelope", "dms") == "striim":
        parsed = env.striim_as_changes(env.parse_striim(records,
                                                        positional_columns=options.get("positional_columns")))
    else:
        parsed = env.parse_dms(records)
    # user hooks: DataFrame -> DataFrame functions applied to the parsed rows
    for hook in options.get("transforms", ()):
        parsed = parsed.transform(hook)
    if options.get("selection_rules"):
        keep = routing.selection_predicate(options["selection_rules"])
        parsed = parsed.where(F.col("parse_error").isNotNull() | keep)
    return parsed


def _route(df: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    return routing.route(df, prefix=options.get("index_prefix", routing.INDEX_PREFIX),
                         id_mode=options.get("id_mode", "content"), key_columns=options.get("key_columns"),
                         location_mode=options.get("location_mode", "object"))


def batch_rows(records: DataFrame, options: Mapping[str, Any], watermark: int | None = None) -> DataFrame:
    """One parse of a batch: the narrow rows every sink is fed from.

    ``reason`` says why a row goes to quarantine (parse, routing, or an event
    time behind the watermark), ``kept`` whether it is a row change. Text
    columns a sink does not need are left out.
    """
    batch = parse_stage(records, options)
    routed = _route(batch, options)
    is_data = F.col("parse_error").isNull() & F.coalesce(F.col("record_type") == routing.DATA_RECORD_TYPE, F.lit(False))
    needs_document = options.get("output_documents") or options.get("output_document_log") or options.get("output_bulk")
    # a missing key only matters where there are documents to name
    reason = F.coalesce("parse_error", F.when(is_data, F.col("route_error")) if needs_document else F.lit(None).cast("string"))
    if watermark is not None:
        reason = F.coalesce(reason, F.when(is_data & (F.unix_micros("event_time") < F.lit(watermark)), F.lit(LATE)))
    columns = [F.when(reason.isNotNull(), F.col("value")).alias("value"), reason.alias("reason"),
               (is_data & reason.isNull()).alias("kept"), "event_time", "schema_name", "table_name", "operation",
               "record_type", *[c for c in ("arrival_time", "source", "seq") if c in batch.columns]]
    if options.get("output_metrics"):
        columns.append(F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint").alias("bytes_in"))
    if needs_document or options.get("restream_key", "0") is None:
        columns += ["index_name", "doc_id", "is_delete"]
    if needs_document:
        columns.append("doc")
    if options.get("output_json") or options.get("output_restream"):
        columns.append(documents.envelope_json(F.col("metadata"), F.col("data")).alias("line"))
    if options.get("output_parquet"):
        columns += ["metadata", "partition_key_type", F.to_json("data").alias("data")]
    return routed.select(*columns)


def _deliver(spark: SparkSession, name: str, write: Callable[[], None], rows: DataFrame, batch_id: int, tag: str,
             options: Mapping[str, Any]) -> None:
    """Run one sink of a batch: retried with growing pauses, then its rows go to the dead letters if there are any.

    A sink that is through leaves a note beside the checkpoint, so a replay of the batch (because another
    sink failed for good, or the driver was lost) does not send its rows again.
    """
    note = _batch_note(options, batch_id, f"{name}.done") if options.get("checkpoint_location") else None
    if note and _small_file(spark, note) is not None:
        return
    retries = int(options.get("sink_retries", 0))
    for attempt in range(retries + 1):
        try:
            write()
            break
        except Exception as e:
            if attempt < retries:
                time.sleep(float(options.get("sink_backoff", 1.0)) * 2 ** attempt)
                continue
            if not options.get("output_dead_letter"):
                raise
            lost = rows.withColumns({"sink": F.lit(name), "error": F.lit(f"{type(e).__name__}: {e}"[:1000]),
                                     "failed_at": F.current_timestamp()})
            folder = f"{_prefixed(options, 'output_dead_letter')}/sink={name}/{tag}"
            lost.drop("sink").write.mode("overwrite").parquet(folder)
    if note:
        _small_file(spark, note, tag)


def dead_letters(spark: SparkSession, options: Mapping[str, Any], sink: str) -> DataFrame:
    """Rows a sink did not take, with the error and the batch they came in."""
    return spark.read.parquet(f"{_prefixed(options, 'output_dead_letter')}/sink={sink}")


def batch_metrics(rows: DataFrame) -> DataFrame:
    """One row about a batch: volume in, kept, quarantined and late, and delivery lag (M1-M4)."""
    lag = F.when(F.col("kept"), F.unix_millis("arrival_time") - F.unix_millis("event_time")) \
        if "arrival_time" in rows.columns else F.lit(None).cast("bigint")
    docs = F.octet_length("doc").cast("bigint") if "doc" in rows.columns else F.lit(0).cast("bigint")
    return rows.agg(
        F.count("*").alias("records_in"), F.coalesce(F.sum("bytes_in"), F.lit(0)).alias("bytes_in"),
        F.count_if("kept").alias("records_kept"), F.coalesce(F.sum(F.when(F.col("kept"), docs)), F.lit(0)).alias("bytes_out"),
        F.count_if((F.col("reason") == LATE).eqNullSafe(F.lit(True))).alias("records_late"),
        F.count_if(F.col("reason").isNotNull() & (F.col("reason") != LATE)).alias("records_bad"),
        F.count(lag).alias("lag_records"), F.max(lag).alias("max_lag_ms"), F.sum(lag).alias("sum_lag_ms"),
        F.max("event_time").alias("max_event_time"), F.current_timestamp().alias("processed_at"))


def fan_out(records: DataFrame, batch_id: int, options: Mapping[str, Any], source: str | None = None,
            tag: str | None = None) -> None:
    """Parse one batch of raw records once and write it to every chosen sink.

    With more than one sink the narrow rows (text, no parsed maps) are kept in
    memory for the batch, so neither the source nor the parse runs twice.
    ``output_sinks`` maps names to functions of the user's own, called with the
    kept rows and the batch id.
    """
    spark = records.sparkSession
    prepare(spark)
    tag = tag or f"batch_id={batch_id}"
    watermark = watermark_of(spark, options, batch_id) if options.get("late_after") else None
    rows = batch_rows(records, options, watermark)
    chosen = [k for k in (*OUTPUT_KEYS, "output_quarantine", "output_metrics", "late_after") if options.get(k)]
    shared = len(chosen) > 1 or len(options.get("output_sinks") or ()) > 1
    if shared:
        rows = rows.persist()
    cluster = bool(options.get("cluster_layouts", True))
    kept = rows.where("kept")

    def target(key: str) -> str:
        return f"{_prefixed(options, key)}/{tag}"

    def quarantine():
        bad = rows.where(F.col("reason").isNotNull()).withColumnRenamed("reason", "parse_error")
        env.quarantine_view(bad).write.mode("overwrite").parquet(target("output_quarantine"))

    def metrics():
        mark = F.lit(watermark).cast("bigint")
        (batch_metrics(rows).withColumn("watermark", F.timestamp_micros(mark))
            .write.mode("overwrite").parquet(target("output_metrics")))

    def document_log():
        (sinks.document_rows(kept).withColumn("written_at", F.current_timestamp())
              .write.mode("overwrite").partitionBy("index_name").parquet(target("output_document_log")))

    def documents_state():
        store = state.StateStore(spark, _prefixed(options, "output_documents"),
                                 int(options.get("state_buckets", state.DEFAULT_BUCKETS)))
        store.append(sinks.document_rows(kept), source or str(options.get("query_name") or "stream"), batch_id,
                     int(options.get("state_compact_every", state.DEFAULT_COMPACT_EVERY)))

    def json_lines():
        processing = options.get("json_time", "event") == "processing"
        src = kept.withColumn("event_time", F.current_timestamp()) if processing else kept
        sinks.write_lines(src, target("output_json"), by_table=bool(options.get("json_by_table", False)),
                          mode="overwrite", cluster=cluster)

    def parquet():
        out = sinks.table_month_columns(kept.drop("value", "reason", "kept", "line", "doc", "doc_id", "index_name",
                                                  "is_delete", "bytes_in"))
        out = out.withColumns({"day": F.date_format("event_time", "dd"), "hour": F.date_format("event_time", "HH")})
        if cluster:
            out = sinks.cluster_for_layout(out, ["table_name", "year", "month", "day", "hour"])
        (out.write.mode("overwrite").partitionBy("table_name", "year", "month", "day", "hour")
            .parquet(target("output_parquet")))

    def restream():
        key = options.get("restream_key", "0")
        recs = kept.select((F.lit(key) if key is not None else F.col("doc_id")).alias("key"), F.col("line").alias("value"))
        if options.get("output_kafka_bootstrap_servers"):
            (recs.write.format("kafka")
                 .option("kafka.bootstrap.servers", options["output_kafka_bootstrap_servers"])
                 .option("topic", options["output_restream"]).save())
        else:
            sinks.write_text(recs, target("output_restream"), mode="overwrite")

    def bulk_bodies():
        requests = bulk.bulk_requests(sinks.document_rows(kept), int(options.get("bulk_max_bytes", bulk.MAX_BYTES)),
                                      int(options.get("bulk_max_actions", bulk.MAX_ACTIONS)),
                                      shards=int(options.get("bulk_shards", bulk.DEFAULT_SHARDS)),
                                      order=("event_time", *[c for c in ("arrival_time", "source", "seq") if c in kept.columns]))
        requests.write.mode("overwrite").parquet(target("output_bulk"))

    own = {"output_quarantine": quarantine, "output_bulk": bulk_bodies, "output_metrics": metrics, "output_document_log": document_log,
           "output_documents": documents_state, "output_json": json_lines, "output_parquet": parquet,
           "output_restream": restream,
           "output_discarding": lambda: rows.write.format("noop").mode("overwrite").save(),
           "output_console": lambda: sinks.print_rows(kept.select("table_name", "operation", "record_type"))}
    try:
        for key, write in own.items():
            if options.get(key):
                # quarantine and metrics are about all rows, the sinks about the kept ones
                _deliver(spark, key.removeprefix("output_"), write, rows if write in (quarantine, metrics) else kept,
                         batch_id, tag, options)
        for name, send in (options.get("output_sinks") or {}).items():
            _deliver(spark, name, lambda send=send: send(kept.drop("value", "reason", "kept"), batch_id), kept, batch_id, tag, options)
        if options.get("late_after"):
            # late rows are behind the watermark, so they never move it
            top = rows.where(F.col("reason").isNull()).agg(F.max(F.unix_micros("event_time"))).first()[0]
            before = None if watermark is None else watermark + _micros(str(options["late_after"]))
            seen = max((t for t in (top, before) if t is not None), default=None)
            _small_file(spark, _batch_note(options, batch_id, "seen"), json.dumps({"max_event_time": seen}))
        if options.get("checkpoint_location"):
            done = [k.removeprefix("output_") for k in own] + list(options.get("output_sinks") or ())
            _forget(spark, options, batch_id - KEEP_NOTES, ["seen", *[f"{d}.done" for d in done]])
    finally:
        if shared:
            rows.unpersist()


def run(spark: SparkSession, options: Mapping[str, Any]) -> StreamingQuery:
    """Start the job. ``trigger``: ``"available_now"`` or an interval such as
    ``"60 seconds"`` (the checkpoint cadence of the original deployment)."""
    validate(options, streaming=True)
    prepare(spark)
    records = source_frame(spark, options, streaming=True)
    from_files = bool(options.get("input_path"))
    writer = (records.writeStream
                    .foreachBatch(lambda df, bid: fan_out(in_line_order(df) if from_files else df, bid, options))
                    .option("checkpointLocation", options["checkpoint_location"]))
    trig = options.get("trigger", "60 seconds")
    writer = writer.trigger(availableNow=True) if trig == "available_now" else writer.trigger(processingTime=trig)
    if options.get("query_name"):
        writer = writer.queryName(options["query_name"])
    return writer.start()


def run_batch(spark: SparkSession, options: Mapping[str, Any], run_id: str | None = None) -> None:
    """The same pipeline over a bounded input. A run writes under ``run_id=<id>``: give the id of a
    failed run to repeat it, else each call is a run of its own."""
    validate(options)
    prepare(spark)
    run_id = run_id or options.get("run_id") or uuid.uuid4().hex
    # a bounded run is one batch: nothing is late in it, and a repeated run writes every sink again
    options = {k: v for k, v in options.items() if k not in ("checkpoint_location", "late_after")}
    fan_out(source_frame(spark, options, streaming=False), 0, options, source=f"run {run_id}", tag=f"run_id={run_id}")


def _rollup_frame(parsed: DataFrame, rollup: str, params: Mapping[str, Any]) -> DataFrame:
    from tributary.functions.variants import field
    from tributary.operators import windows
    watermark = params.get("watermark", windows.DEFAULT_WATERMARK)
    if rollup == "window_counts":
        return windows.table_window_counts(routing.only_data(parsed), params.get("size", windows.DEFAULT_WINDOW),
                                           watermark=watermark)
    if rollup == "sessions":
        key = params["key"]
        kept = routing.only_data(parsed).withColumn(key, field(F.col("data"), key, params.get("key_type", "string")))
        return windows.session_counts_stream(kept, params.get("gap", "30 minutes"), key, watermark=watermark)
    if rollup == "quiet_keys":
        from tributary.streaming import keyed
        key = params["key"]
        rows = routing.only_data(parsed).withColumn(key, field(F.col("data"), key, params.get("key_type", "string")))
        return keyed.count_with_timeout(rows, key, params.get("timeout", "30 minutes"), watermark=watermark)
    if rollup == "health":
        kept = F.col("parse_error").isNull() & F.coalesce(F.col("record_type") == "data", F.lit(False))
        return windows.stream_health(parsed.withColumn("kept", kept), params.get("period", "1 minute"),
                                     kept_col="kept", watermark=watermark)
    raise JobConfigError(f"unknown rollup {rollup!r}")


def run_rollup(spark: SparkSession, options: Mapping[str, Any], rollup: str = "window_counts",
               output_mode: str = "append", **params: Any) -> StreamingQuery:
    """Event-time rollup of the stream: ``window_counts`` (W2: ``size``),
    ``sessions`` (W3: ``key``, ``gap``), ``quiet_keys`` (W3: ``key``,
    ``timeout``) or ``health`` (M1-M3: ``period``, windowed on arrival time). Watermarked (W1); late rows are dropped and
    show up in ``numRowsDroppedByWatermark`` (W4). Sinks: ``output_memory``
    (query name), ``output_parquet`` (append mode) or the console."""
    validate({**options, "output_discarding": True}, streaming=True)
    prepare(spark)
    # a key's rows become one row per task and session before they are shuffled
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    if rollup == "quiet_keys":
        from tributary.streaming.keyed import use_rocksdb
        use_rocksdb(spark)
    parsed = parse_stage(source_frame(spark, options, streaming=True), options)
    out = _rollup_frame(parsed, rollup, params)
    w = out.writeStream.outputMode(output_mode).option("checkpointLocation", options["checkpoint_location"])
    if options.get("output_memory"):
        w = w.format("memory").queryName(options["output_memory"])
    elif options.get("output_parquet"):
        w = w.format("parquet").option("path", options["output_parquet"])
    else:
        w = w.format("console")
    trig = options.get("trigger", "available_now")
    w = w.trigger(availableNow=True) if trig == "available_now" else w.trigger(processingTime=trig)
    return w.start()


def run_window_counts(spark: SparkSession, options: Mapping[str, Any], size: str = "1 second",
                      watermark: str = "100 milliseconds", output_mode: str = "append") -> StreamingQuery:
    """Tumbling event-time counts per table from the stream (see :func:`run_rollup`)."""
    return run_rollup(spark, options, "window_counts", output_mode, size=size, watermark=watermark)
