"""Registered queries that drive the Structured Streaming job end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import state
from tributary.plans.queries import _kept, register
from tributary.session import scratch_path
from tributary.sources import fixtures as fx
from tributary.streaming import job


# Files of one arrival step; a micro-batch takes one step.
STEP_FILES = 4


def write_envelope_files(spark, envelopes, files: int = STEP_FILES) -> str:
    """Envelope text files, the stand-in for the change stream's shards."""
    path = scratch_path(spark, "stream-input")
    envelopes.select("value").repartition(files).write.text(path)
    return path


def write_steps(spark, steps, files: int = STEP_FILES) -> str:
    """Envelope files in arrival steps, each of ``files`` files: a step's files are written after those of the
    step before, so a stream of ``files`` files a batch takes them in this order."""
    path = scratch_path(spark, "stream-steps")
    for step in steps:
        step.select("value").repartition(files).write.mode("append").text(path)
    return path


def _orders_state_sql() -> str:
    k = "o_orderkey"
    return (f"SELECT 'dms_flink_orders' AS index_name, "
            f"count(DISTINCT CASE WHEN {k} % 100 = 8 THEN -1 ELSE {k} END) AS n_docs, "
            f"count(*) FILTER (WHERE {k} % 100 = 10) AS n_deleted FROM orders WHERE {_kept(k)} "
            f"UNION ALL SELECT '_quarantine', count(*), 0 FROM orders WHERE {k} % 100 IN (1, 4, 5, 6, 7, 11)")


@register("stream_fanout", _orders_state_sql())
def stream_fanout(spark, sf_dir):
    """Orders envelopes as files -> streaming job (availableNow) -> document
    state merged per micro-batch + quarantine sink; read back (S1 S3 O1 O13)."""
    inp = write_envelope_files(spark, fx.orders_envelopes(spark, sf_dir, plant=True))
    out = scratch_path(spark, "stream-out")
    opts = {"input_path": inp, "output_documents": f"{out}/state", "output_quarantine": f"{out}/quarantine",
            "trigger": "available_now", "max_files_per_trigger": 2,
            "checkpoint_location": f"{out}/_checkpoint"}
    q = job.run(spark, opts)
    q.awaitTermination()
    docs = (state.read_index(spark, f"{out}/state", apply_deletes=False)
                 .groupBy("index_name")
                 .agg(F.count("*").alias("n_docs"), F.sum(F.col("is_delete").cast("long")).alias("n_deleted")))
    bad = spark.read.parquet(f"{out}/quarantine").agg(
        F.lit("_quarantine").alias("index_name"), F.count("*").alias("n_docs"), F.lit(0).cast("long").alias("n_deleted"))
    return docs.unionByName(bad)


@register("latest_from_files", """
SELECT 'dms_flink_supplier' AS index_name, CAST(s_suppkey AS BIGINT) AS s_suppkey,
       CASE WHEN s_suppkey % 3 = 0 THEN 'delete' ELSE 'update' END AS operation, 3 AS version, 3 AS n_versions
FROM supplier""")
def latest_from_files(spark, sf_dir):
    """Three versions of every row with one event time, in two steps of files: the later file wins, and in it
    the later line, without a sequence number from the source (O1, S1)."""
    s = fx.read_table(spark, sf_dir, "supplier")
    op = F.when((F.col("version") == 3) & (F.pmod("s_suppkey", F.lit(3)) == 0), F.lit("delete")).otherwise(F.lit("update"))
    rows = s.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    envs = fx.dms_envelopes(rows, table="supplier", key="s_suppkey", columns=[F.col("s_suppkey"), F.col("version")],
                            event_time=F.lit("2022-01-01").cast("timestamp"), operation=op, passthrough=["version"])
    path, out = scratch_path(spark, "versions"), scratch_path(spark, "versions-out")
    for wanted in (F.col("version") == 1, F.col("version") > 1):  # the versions of a row lie in order in one file
        (envs.where(wanted).repartition(STEP_FILES, "seq").sortWithinPartitions("seq", "version").select("value")
             .write.mode("append").text(path))
    job.run_batch(spark, {"input_path": path, "output_documents": out, "id_mode": "key", "key_columns": ["s_suppkey"]})
    docs = state.read_index(spark, out, apply_deletes=False)
    return docs.select("index_name", F.get_json_object("doc", "$.s_suppkey").cast("bigint").alias("s_suppkey"), "operation",
                       F.get_json_object("doc", "$.version").cast("int").alias("version"),
                       F.col("n_versions").cast("int").alias("n_versions"))


@register("fan_out_sinks", f"""
SELECT sink, count(*) AS n FROM customer, (VALUES ('documents'), ('document_log'), ('json'), ('parquet'), ('restream')) s(sink)
WHERE {_kept('c_custkey')} GROUP BY sink
UNION ALL SELECT 'quarantine', count(*) FROM customer WHERE c_custkey % 100 IN (1, 4, 5, 6, 7, 11)""")
def fan_out_sinks(spark, sf_dir):
    """One parse, six sinks: state, document log, JSON lines, Parquet, re-stream and quarantine beside a
    discarding one (O1, O4, O5, O6, O8, O13), each read back."""
    inp = write_envelope_files(spark, fx.customer_envelopes(spark, sf_dir, plant=True))
    out = scratch_path(spark, "fan-out")
    keys = ("documents", "document_log", "json", "parquet", "restream", "quarantine")
    opts = {f"output_{k}": f"{out}/{k}" for k in keys}
    job.run_batch(spark, {"input_path": inp, "output_discarding": True, **opts}, run_id="one")
    counts = [state.read_index(spark, f"{out}/documents", apply_deletes=False).agg(F.sum("n_versions").alias("n"))]
    counts += [spark.read.parquet(f"{out}/{k}").agg(F.count("*").alias("n")) for k in ("document_log", "parquet", "quarantine")]
    counts += [spark.read.text(f"{out}/{k}").agg(F.count("*").alias("n")) for k in ("json", "restream")]
    names = ("documents", "document_log", "parquet", "quarantine", "json", "restream")
    rows = [c.select(F.lit(k).alias("sink"), "n") for k, c in zip(names, counts)]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every


_EVENTS_END = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 100 MILLISECOND FROM events)"


def _event_files(spark, sf_dir, **kwargs):
    """All events in one step, a step without events, then the same events in 1999: late by then.

    A batch drops what is behind the watermark the batch before it began with,
    so late rows come two batches after the rows that make them late."""
    envs = fx.events_envelopes(spark, sf_dir, **kwargs).select("value")
    late = F.regexp_replace("value", r'"timestamp":"(\d{4})', '"timestamp":"1999')
    path = write_steps(spark, [envs])
    # one row a file, so that this step has as many files as the others
    spark.range(0, STEP_FILES, 1, STEP_FILES).select(F.lit("{}").alias("value")).write.mode("append").text(path)
    envs.select(late.alias("value")).repartition(STEP_FILES).write.mode("append").text(path)
    return path


def _rollup(spark, path, rollup, **params):
    out = scratch_path(spark, rollup)
    job.run_rollup(spark, {"input_path": path, "max_files_per_trigger": STEP_FILES, "output_parquet": f"{out}/rows",
                           "checkpoint_location": f"{out}/_checkpoint"}, rollup, **params).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


@register("stream_windows", f"""
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS table_name, count(*) AS n
FROM events WHERE date_trunc('second', ts) + INTERVAL 1 SECOND <= {_EVENTS_END} GROUP BY ALL""")
def stream_windows(spark, sf_dir):
    """Tumbling counts of a stream with a watermark: a second file of late rows adds nothing, windows
    the watermark has passed are final (W1, W2, W4)."""
    rows = _rollup(spark, _event_files(spark, sf_dir, table_by_event_type=True), "window_counts")
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "table_name", "n")


@register("stream_sessions", f"""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
g AS (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, count(*) AS n
FROM g GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {_EVENTS_END}""")
def stream_sessions(spark, sf_dir):
    """Sessions of a stream, closed by the watermark; late rows add nothing."""
    rows = _rollup(spark, _event_files(spark, sf_dir), "sessions", key="user_id", key_type="bigint")
    return rows.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"), "n")


@register("quiet_keys", f"""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p,
                  lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS q,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
quiet AS (SELECT user_id, ts, n FROM e WHERE (q IS NULL OR q - ts > INTERVAL 30 MINUTE) AND ts + INTERVAL 30 MINUTE <= {_EVENTS_END})
SELECT user_id, n, n - coalesce(lag(n) OVER (PARTITION BY user_id ORDER BY n), 0) AS burst,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS last_change FROM quiet""")
def quiet_keys(spark, sf_dir):
    """A keyed process with timers on the stream: each time a user has been quiet for 30 minutes, how many events
    it has had, how many since its last report, and when the last was (A3, W3); late rows add nothing."""
    rows = _rollup(spark, _event_files(spark, sf_dir), "quiet_keys", key="user_id", key_type="bigint")
    return rows.select("user_id", "n", "burst", F.date_format("last_change", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_change"))


# Arrival steps of the late-row queries; each spans all event times.
LATE_STEPS = 4
_JUDGED = f"""
SELECT *, event_id % {LATE_STEPS} AS step, event_id % 100 IN (1, 4, 5, 6, 7, 11) AS bad, event_id % 100 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 11) AS data
FROM events"""
_LATE_SQL = f"""
WITH e AS ({_JUDGED}),
tops AS (SELECT step, max(ts) AS top FROM e WHERE data GROUP BY step),
marks AS (SELECT s.step, (SELECT max(top) FROM tops t WHERE t.step < s.step) - INTERVAL 1 HOUR AS mark FROM tops s),
judged AS (SELECT e.*, data AND coalesce(ts < mark, false) AS late FROM e JOIN marks USING (step))"""


def _run_late(spark, sf_dir):
    """The job over events that arrive in steps, each over all event times: later steps are mostly late."""
    envs = fx.events_envelopes(spark, sf_dir, plant=True, table_by_event_type=True)
    inp = write_steps(spark, [envs.where(F.pmod("seq", F.lit(LATE_STEPS)) == n) for n in range(LATE_STEPS)])
    out = scratch_path(spark, "late")
    opts = {"input_path": inp, "trigger": "available_now", "max_files_per_trigger": STEP_FILES, "late_after": "1 hour",
            "checkpoint_location": f"{out}/_checkpoint",
            **{f"output_{k}": f"{out}/{k}" for k in ("document_log", "quarantine", "metrics")}}
    job.run(spark, opts).awaitTermination()
    return out


@register("late_rows", _LATE_SQL + """
SELECT event_type AS table_name, CASE WHEN late THEN 'late' ELSE 'on_time' END AS branch, count(*) AS n
FROM judged WHERE data GROUP BY ALL""")
def late_rows(spark, sf_dir):
    """Rows behind the watermark as a side output: on-time rows reach the sink, late ones the quarantine with the
    reason ``late``, none is lost (W4 P5)."""
    out = _run_late(spark, sf_dir)
    on_time = spark.read.parquet(f"{out}/document_log").select(
        F.get_json_object("doc", "$.metadata.table-name").alias("table_name"), F.lit("on_time").alias("branch"))
    late = spark.read.parquet(f"{out}/quarantine").where(f"parse_error = '{job.LATE}'").select(
        F.get_json_object("value", "$.metadata.table-name").alias("table_name"), F.lit("late").alias("branch"))
    return on_time.union(late).groupBy("table_name", "branch").agg(F.count("*").alias("n"))


@register("job_metrics", _LATE_SQL + """
SELECT CAST(step AS INTEGER) AS batch_id, count(*) AS records_in, count(*) FILTER (data AND NOT late) AS records_kept,
       count(*) FILTER (late) AS records_late, count(*) FILTER (bad) AS records_bad,
       strftime(any_value(mark), '%Y-%m-%d %H:%M:%S.%f') AS watermark
FROM judged JOIN marks USING (step) GROUP BY step""")
def job_metrics(spark, sf_dir):
    """What the running job measured, one row a micro-batch: volume in and kept, late, bad, its watermark."""
    rows = spark.read.parquet(f"{_run_late(spark, sf_dir)}/metrics")
    return rows.select("batch_id", "records_in", "records_kept", "records_late", "records_bad",
                       F.date_format("watermark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("watermark"))
