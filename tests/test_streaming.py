"""Streaming job: validation, batch = stream, restart, late data."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tributary.operators import state
from tributary.session import local_path, scratch_path
from tributary.streaming import job


def _envelope(table, key, ts, op="update", rt="data"):
    return json.dumps({"metadata": {"timestamp": ts, "record-type": rt, "operation": op,
                                    "partition-key-type": "primary-key", "schema-name": "S", "table-name": table},
                       "data": {"id": key, "v": f"{table}-{key}-{op}"}})


def _write(path, name, lines):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_validate():
    with pytest.raises(job.JobConfigError):
        job.validate({"output_discarding": True})
    with pytest.raises(job.JobConfigError):
        job.validate({"input_path": "x", "input_kafka_topic": "t", "output_discarding": True})
    with pytest.raises(job.JobConfigError):
        job.validate({"input_path": "x"})
    job.validate({"input_path": "x", "output_discarding": True})
    with pytest.raises(job.JobConfigError):  # a restart without one would begin again at batch 0
        job.validate({"input_path": "x", "output_discarding": True}, streaming=True)


def test_kafka_start_time_is_epoch_milliseconds():
    from tributary.sources.files import epoch_millis
    assert epoch_millis("2024-01-15 00:00:00") == epoch_millis("2024-01-15T01:00:00+01:00") == 1705276800000


def test_two_batch_runs_keep_both_outputs(spark):
    inp = scratch_path(spark, "runs-in")
    out = scratch_path(spark, "runs-out")
    for n in (1, 2):
        _write(f"{inp}{n}", "f.txt", [_envelope("a", k, "2022-01-01T00:00:00Z") for k in range(n)])
        opts = {"input_path": f"{inp}{n}", "output_json": f"{out}/json", "output_documents": f"{out}/state"}
        job.run_batch(spark, opts)
    job.run_batch(spark, opts, run_id="again")
    job.run_batch(spark, opts, run_id="again")  # a repeated run replaces its own output
    assert spark.read.text(f"{out}/json").count() == 1 + 2 + 2
    assert state.read_index(spark, f"{out}/state").agg(F.sum("n_versions")).first()[0] == 1 + 2 + 2


def test_latest_keeps_files_written_while_stopped(spark):
    import time
    inp, out = scratch_path(spark, "latest-in"), scratch_path(spark, "latest-out")
    _write(inp, "old.txt", [_envelope("a", 1, "2022-01-01T00:00:00Z")])
    time.sleep(1.1)
    opts = {"input_path": inp, "output_restream": f"{out}/re", "start_position": "LATEST", "trigger": "available_now",
            "checkpoint_location": f"{out}/_ck"}
    job.run(spark, opts).awaitTermination()
    _write(inp, "while-stopped.txt", [_envelope("a", 2, "2022-01-01T00:00:00Z")])
    time.sleep(1.1)
    job.run(spark, opts).awaitTermination()
    assert [json.loads(r[0])["data"]["id"] for r in spark.read.text(f"{out}/re").select("value").collect()] == [2]


def test_one_parse_feeds_every_sink(spark, capfd):
    inp, out = scratch_path(spark, "five-in"), scratch_path(spark, "five-out")
    _write(inp, "f.txt", [_envelope("a", k, "2022-01-01T00:00:00Z") for k in range(40)] + ["bad"])
    opts = {"input_path": inp, **{f"output_{k}": f"{out}/{k}" for k in ("documents", "json", "parquet", "restream", "quarantine")}}
    rows = job.batch_rows(job.source_frame(spark, opts, streaming=False), opts)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 3 and plan.count("from_json") == 1  # envelope, reason, metadata text
    job.run_batch(spark, opts)
    assert spark.read.parquet(f"{out}/parquet").count() == 40 and spark.read.text(f"{out}/json").count() == 40
    job.run_batch(spark, {"input_path": inp, "output_console": True})  # every row, not a first screen


def test_rows_without_key_or_table_go_to_quarantine(spark):
    inp, out = scratch_path(spark, "key-in"), scratch_path(spark, "key-out")
    no_table = json.loads(_envelope("a", 1, "2022-01-01T00:00:00Z"))
    del no_table["metadata"]["table-name"]
    no_key = json.loads(_envelope("a", 1, "2022-01-01T00:00:00Z"))
    del no_key["data"]["id"]
    _write(inp, "f.txt", [json.dumps(no_table), json.dumps(no_key), _envelope("a", 1, "2022-01-01T00:00:00Z")])
    job.run_batch(spark, {"input_path": inp, "output_documents": f"{out}/s", "output_quarantine": f"{out}/q",
                          "id_mode": "key", "key_columns": ["id"]})
    assert sorted(r["parse_error"] for r in spark.read.parquet(f"{out}/q").collect()) == ["key_missing", "table_missing"]
    assert state.read_index(spark, f"{out}/s").count() == 1


def test_stream_equals_batch_and_restart(spark):
    inp = scratch_path(spark, "in")
    lines1 = [_envelope("a", k, f"2022-01-01T00:00:0{k % 10}Z") for k in range(20)] + ["broken", ""]
    lines2 = [_envelope("a", k, "2022-01-02T00:00:00Z", op="delete") for k in range(5)] + \
             [_envelope("b", k, "2022-01-02T00:00:00Z") for k in range(3)]
    _write(inp, "f1.txt", lines1)
    out_s, out_b = scratch_path(spark, "out-s"), scratch_path(spark, "out-b")
    common = {"input_path": inp, "id_mode": "key", "key_columns": ["id"]}
    opts = {**common, "output_documents": f"{out_s}/state", "output_quarantine": f"{out_s}/q",
            "output_json": f"{out_s}/json", "output_parquet": f"{out_s}/pq", "output_restream": f"{out_s}/re",
            "output_document_log": f"{out_s}/log", "trigger": "available_now",
            "checkpoint_location": f"{out_s}/_ck"}
    job.run(spark, opts).awaitTermination()
    _write(inp, "f2.txt", lines2)
    job.run(spark, opts).awaitTermination()  # restart from the checkpoint: only the new file
    _write(out_b + "-in", "all.txt", lines1 + lines2)
    job.run_batch(spark, {**common, "input_path": out_b + "-in", "output_documents": f"{out_b}/state"})

    def snap(p):
        return sorted((r["index_name"], r["doc_id"], r["doc"], r["is_delete"]) for r in
                      state.read_index(spark, p, apply_deletes=False).collect())
    s = snap(f"{out_s}/state")
    assert s == snap(f"{out_b}/state")
    assert len(s) == 23 and sum(1 for r in s if r[3]) == 5
    assert {r["index_name"] for r in state.read_index(spark, f"{out_s}/state").collect()} == {"dms_flink_a", "dms_flink_b"}
    assert spark.read.parquet(f"{out_s}/q").count() == 2
    log = spark.read.parquet(f"{out_s}/log")
    assert log.count() == 28 and log.select("batch_id").distinct().count() == 2
    js = spark.read.text(f"{out_s}/json")
    assert js.count() == 28 and {"year", "month", "day", "hour"} <= set(js.columns)
    assert spark.read.parquet(f"{out_s}/pq").count() == 28
    assert spark.read.text(f"{out_s}/re").count() == 28


def test_watermark_drops_late_rows(spark):
    import time
    inp = scratch_path(spark, "win-in")
    _write(inp, "f1.txt", [_envelope("a", 1, "2022-01-01T00:00:10.000Z"),
                           _envelope("a", 2, "2022-01-01T00:00:10.500Z")])
    time.sleep(1.1)
    # 100 ms behind the newest event: counted
    _write(inp, "f2.txt", [_envelope("a", 3, "2022-01-01T00:00:10.400Z")])
    time.sleep(1.1)
    # 10 s behind: dropped as late
    _write(inp, "f3.txt", [_envelope("a", 4, "2022-01-01T00:00:00.000Z")])
    opts = {"input_path": inp, "max_files_per_trigger": 1, "output_memory": "wc_test",
            "checkpoint_location": scratch_path(spark, "win-ck")}
    q = job.run_window_counts(spark, opts, size="1 second", watermark="100 milliseconds", output_mode="update")
    q.awaitTermination()
    rows = spark.sql("select window_start, n from wc_test").collect()
    best = {}
    for r in rows:
        best[r["window_start"]] = max(best.get(r["window_start"], 0), r["n"])
    assert list(best.values()) == [3]
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 1


def test_transform_hooks_and_rules(spark):
    inp = scratch_path(spark, "hook-in")
    _write(inp, "f.txt", [_envelope("keep", 1, "2022-01-01T00:00:00Z"), _envelope("skip", 2, "2022-01-01T00:00:00Z"),
                          _envelope("keep", 3, "2022-01-01T00:00:00Z")])
    out = scratch_path(spark, "hook-out")
    rules = [{"rule-type": "selection", "object-locator": {"schema-name": "S", "table-name": "k%"},
              "rule-action": "include"}]
    job.run_batch(spark, {"input_path": inp, "output_documents": f"{out}/state", "selection_rules": rules,
                          "transforms": [lambda df: df.where(F.col("data")["id"].cast("int") != 3)]})
    docs = state.read_index(spark, f"{out}/state").collect()
    assert [(d["index_name"], json.loads(d["doc"])["id"]) for d in docs] == [("dms_flink_keep", 1)]


def test_replayed_batch_leaves_no_duplicates(spark):
    inp = scratch_path(spark, "replay-in")
    _write(inp, "f.txt", [_envelope("a", k, "2022-01-01T00:00:00Z") for k in range(10)] + ["bad"])
    out = scratch_path(spark, "replay-out")
    opts = {"input_path": inp, "output_documents": f"{out}/state", "output_document_log": f"{out}/log",
            "output_json": f"{out}/json", "output_parquet": f"{out}/pq", "output_quarantine": f"{out}/q",
            "output_restream": f"{out}/re"}
    records = job.source_frame(spark, opts, streaming=False)
    job.fan_out(records, 7, opts)
    job.fan_out(records, 7, opts)  # the same micro-batch again, as after a lost executor
    assert state.read_index(spark, f"{out}/state").count() == 10
    assert spark.read.parquet(f"{out}/log").count() == 10
    assert spark.read.text(f"{out}/json").count() == 10
    assert spark.read.parquet(f"{out}/pq").count() == 10
    assert spark.read.parquet(f"{out}/q").count() == 1
    assert spark.read.text(f"{out}/re").count() == 10


def test_striim_envelopes_through_job(spark):
    inp = scratch_path(spark, "striim-in")
    ev = lambda k, op: json.dumps({"before": {}, "data": {"ID": str(k), "NAME": f"n{k}"},
                                   "metadata": {"TableName": "S.T", "OperationName": op, "OperationType": "DML",
                                                "TimeStamp": "2022-01-01T00:00:00.000-00:00", "DBTimeStamp": 1640995200},
                                   "__striimmetadata": {"position": f"p{k}"}})
    ddl = json.dumps({"metadata": {"TableName": "S.T", "OperationName": "ALTER", "OperationType": "DDL"}, "data": {}})
    _write(inp, "f.txt", [ev(1, "INSERT"), ev(2, "UPDATE"), ev(3, "DELETE"), ddl, "not json"])
    out = scratch_path(spark, "striim-out")
    job.run_batch(spark, {"input_path": inp, "envelope": "striim", "output_documents": f"{out}/state",
                          "output_quarantine": f"{out}/q", "id_mode": "key", "key_columns": ["ID"]})
    docs = state.read_index(spark, f"{out}/state", apply_deletes=False).collect()
    assert sorted((json.loads(d["doc"])["ID"], d["is_delete"]) for d in docs) == [("1", False), ("2", False), ("3", True)]
    assert {d["index_name"] for d in docs} == {"dms_flink_t"}
    assert spark.read.parquet(f"{out}/q").count() == 1


def test_stream_rollups_equal_batch(spark):
    from tributary.operators import envelope, routing, windows
    from tributary.functions.variants import field
    inp = scratch_path(spark, "roll-in")
    lines = []
    for k in range(60):
        minute, sec = divmod(k * 7, 60)
        lines.append(_envelope("t", k % 4, f"2022-01-01T00:{minute:02d}:{sec:02d}Z"))
    _write(inp, "f.txt", lines + ["bad"])
    opts = {"input_path": inp}
    q = job.run_rollup(spark, {**opts, "output_memory": "roll_sessions", "checkpoint_location": scratch_path(spark, "ck1")},
                       "sessions", "complete", key="id", key_type="bigint", gap="1 minute", watermark="1 hour")
    q.awaitTermination()
    q = job.run_rollup(spark, {**opts, "output_memory": "roll_health", "checkpoint_location": scratch_path(spark, "ck2")},
                       "health", "complete", period="1 minute", watermark="1 hour")
    q.awaitTermination()
    parsed = envelope.parse_dms(job.source_frame(spark, opts, streaming=False))
    kept = routing.only_data(parsed).withColumn("id", field(F.col("data"), "id", "bigint"))
    want_s = sorted(tuple(r) for r in windows.session_counts(kept, "1 minute", "id").collect())
    got_s = sorted(tuple(r) for r in spark.sql("select id, session_start, session_end, n from roll_sessions").collect())
    assert got_s == want_s and len(got_s) >= 4
    ok = F.col("parse_error").isNull() & F.coalesce(F.col("record_type") == "data", F.lit(False))
    want_h = sorted(tuple(r) for r in windows.stream_health(parsed.withColumn("kept", ok), kept_col="kept").collect())
    got_h = sorted(tuple(r) for r in spark.sql("select * from roll_health").collect())
    assert got_h == want_h and sum(r[1] for r in got_h) == 61
