"""Late rows as a side output, metrics of the job, sinks that fail, and keyed processing with timers."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import _envelope
from tests.test_streaming import _write as _write_file
from tributary.session import local_path, scratch_path
from tributary.streaming import job, keyed


def _at(second):
    return (dt.datetime(2022, 1, 1) + dt.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _write(path, name, lines):
    """A file of a step; the digits of its name give its time, so a stream takes files by name."""
    _write_file(path, name, lines)
    when = 1_700_000_000 + int(name.split(".")[0])
    os.utime(os.path.join(local_path(path), name), (when, when))


def _options(inp, out, **more):
    return {"input_path": inp, "trigger": "available_now", "max_files_per_trigger": 1,
            "checkpoint_location": f"{out}/_checkpoint", "sink_backoff": 0.01, **more}


def _run(spark, options):
    job.run(spark, options).awaitTermination()


# --- late rows ------------------------------------------------------------------------------

def test_late_rows_are_kept_apart_also_after_a_restart(spark):
    inp, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    opts = _options(inp, out, late_after="10 seconds", **{f"output_{k}": f"{out}/{k}" for k in ("document_log", "quarantine", "metrics")})
    _write(inp, "0.txt", [_envelope("a", 1, _at(100)), _envelope("a", 2, _at(3))])  # nothing is late in the first batch
    _run(spark, opts)
    _write(inp, "1.txt", [_envelope("a", 3, _at(90)), _envelope("a", 4, _at(89.999999)), _envelope("b", 5, _at(1)),
                          _envelope("a", 6, _at(0), rt="control"), "{}"])
    _run(spark, opts)
    _write(inp, "2.txt", [_envelope("a", 7, _at(89)), _envelope("a", 8, _at(500))])
    _write(inp, "3.txt", [_envelope("a", 9, _at(480)), _envelope("a", 10, _at(495))])
    _run(spark, opts)
    kept = {int(r[0]) for r in spark.read.parquet(f"{out}/document_log").select(F.get_json_object("doc", "$.id")).collect()}
    bad = spark.read.parquet(f"{out}/quarantine").select("parse_error", F.get_json_object("value", "$.data.id").alias("id")).collect()
    assert kept == {1, 2, 3, 8, 10}
    assert sorted((r.parse_error, r.id) for r in bad if r.id) == [("late", "4"), ("late", "5"), ("late", "7"), ("late", "9")]
    rows = spark.read.parquet(f"{out}/metrics").orderBy("batch_id").collect()
    assert [(r.records_in, r.records_kept, r.records_late, r.records_bad) for r in rows] == [(2, 2, 0, 0), (5, 1, 2, 1), (2, 1, 1, 0), (2, 1, 1, 0)]
    assert rows[0].watermark is None and rows[3].watermark == dt.datetime(2022, 1, 1, 0, 8, 10)
    assert all(r.bytes_in > 0 and r.bytes_out > 0 for r in rows[:1])


def test_a_replayed_batch_is_judged_by_the_same_watermark(spark):
    out = scratch_path(spark, "late-replay")
    opts = _options("unused", out, late_after="1 second", output_quarantine=f"{out}/quarantine", output_document_log=f"{out}/log")

    def batch(*seconds):
        return spark.createDataFrame([(_envelope("a", s, _at(s)), s) for s in seconds], "value string, seq long")
    job.fan_out(batch(10, 20), 0, opts)
    for _ in range(2):
        assert job.watermark_of(spark, opts, 1) == int(dt.datetime(2022, 1, 1, 0, 0, 19, tzinfo=dt.timezone.utc).timestamp()) * 10 ** 6
        job.fan_out(batch(5, 900), 1, opts)
    assert spark.read.parquet(f"{out}/quarantine").count() == 1 and spark.read.parquet(f"{out}/log").count() == 3


def test_late_needs_a_place(spark):
    base = {"input_path": "x", "output_discarding": True, "late_after": "1 second"}
    with pytest.raises(job.JobConfigError, match="checkpoint"):
        job.validate(base)
    with pytest.raises(job.JobConfigError, match="output_quarantine"):
        job.validate({**base, "checkpoint_location": "c"})


# --- sinks that fail ------------------------------------------------------------------------

class Flaky:
    """A user's sink that fails a number of times, then keeps what it gets."""

    def __init__(self, failures):
        self.failures, self.calls, self.got = failures, 0, []

    def __call__(self, df, batch_id):
        self.calls += 1
        if self.failures:
            self.failures -= 1
            raise OSError("unreachable")
        self.got += [(batch_id, r[0]) for r in df.select("table_name").collect()]


def test_a_sink_that_fails_twice_gets_each_row_once(spark):
    inp, out = scratch_path(spark, "flaky-in"), scratch_path(spark, "flaky-out")
    _write(inp, "0.txt", [_envelope("a", 1, _at(0)), _envelope("b", 2, _at(0))])
    sink = Flaky(2)
    _run(spark, _options(inp, out, sink_retries=2, output_sinks={"search": sink}, output_json=f"{out}/json"))
    assert sink.calls == 3 and sorted(sink.got) == [(0, "a"), (0, "b")]
    assert spark.read.text(f"{out}/json").count() == 2


def test_rows_a_sink_never_takes_become_dead_letters(spark):
    inp, out = scratch_path(spark, "dead-in"), scratch_path(spark, "dead-out")
    _write(inp, "0.txt", [_envelope("a", 1, _at(0)), "{}"])
    _write(inp, "1.txt", [_envelope("b", 2, _at(0))])
    sink, other = Flaky(3), Flaky(0)
    opts = _options(inp, out, sink_retries=1, output_sinks={"search": sink, "other": other}, output_dead_letter=f"{out}/dead",
                    output_json=f"{out}/json")
    _run(spark, opts)
    assert sink.got == [(1, "b")] and other.got == [(0, "a"), (1, "b")]  # other sinks are not affected
    assert spark.read.text(f"{out}/json").count() == 2
    dead = job.dead_letters(spark, opts, "search").collect()
    assert [(r.table_name, r.batch_id, r.error) for r in dead] == [("a", 0, "OSError: unreachable")]


def test_without_dead_letters_the_batch_fails_and_done_sinks_are_not_run_again(spark):
    inp, out = scratch_path(spark, "fail-in"), scratch_path(spark, "fail-out")
    _write(inp, "0.txt", [_envelope("a", 1, _at(0))])
    good, bad = Flaky(0), Flaky(1)
    opts = _options(inp, out, output_sinks={"good": good, "bad": bad})
    with pytest.raises(Exception):
        _run(spark, opts)
    assert good.got == [(0, "a")] and bad.got == []
    _run(spark, opts)  # the checkpoint replays the batch
    assert good.got == [(0, "a")] and bad.got == [(0, "a")]


# --- keyed process --------------------------------------------------------------------------

def _quiet(events, timeout, until):
    """Reports by walking each key's events."""
    out = []
    by = defaultdict(list)
    for k, t in events:
        by[k].append(t)
    for k, times in by.items():
        times.sort()
        last = 0
        for i, t in enumerate(times):
            if (i + 1 == len(times) or times[i + 1] - t > timeout) and t + timeout <= until:
                out.append((k, i + 1, i + 1 - last, t))
                last = i + 1
    return sorted(out)


def _report(df):
    epoch = dt.datetime(2022, 1, 1)
    return sorted((r.id, r.n, r.burst, round((r.last_change - epoch).total_seconds(), 6)) for r in df.collect())


def _stream(spark, inp, out, **params):
    job.run_rollup(spark, {"input_path": inp, "max_files_per_trigger": 1, "output_parquet": f"{out}/rows",
                           "checkpoint_location": f"{out}/_checkpoint"}, "quiet_keys", key="id", timeout="20 seconds",
                   watermark="1 seconds", **params).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def test_quiet_keys_with_a_hot_key_and_a_restart(spark):
    rng = random.Random(5)
    steps, events = [], []
    for step in range(4):  # in a step times are in no order, and within a second of the watermark they may be late by it
        rows = [("hot" if rng.random() < .4 else f"k{rng.randrange(40)}", round(step * 100 + rng.random() * 99, 3)) for _ in range(400)]
        steps.append(rows)
        events += rows
    inp, out = scratch_path(spark, "quiet-in"), scratch_path(spark, "quiet-out")
    for n, rows in enumerate(steps):
        _write(inp, f"{n}.txt", [_envelope("t", k, _at(t)) for k, t in rows])
        got = _report(_stream(spark, inp, out))  # every step is a start of its own
        top = max(t for _, t in events[:400 * (n + 1)])
        assert got == _quiet(events[:400 * (n + 1)], 20, round(top - 1, 3))
    _write(inp, "9.txt", [_envelope("t", "z", _at(9000))])
    hot = [r for r in _report(_stream(spark, inp, out)) if r[0] == "hot"]
    assert len(hot) == 1 and hot[0][1] == sum(k == "hot" for k, _ in events) > 500  # never quiet before


def test_a_key_that_returns_keeps_its_total(spark):
    inp, out = scratch_path(spark, "total-in"), scratch_path(spark, "total-out")
    for n, times in enumerate([(0, 5), (25,), (45.000001,), (300,)]):
        _write(inp, f"{n}.txt", [_envelope("t", "a", _at(t)) for t in times] + [_envelope("t", "b", _at(times[-1]))])
    got = [r for r in _report(_stream(spark, inp, out)) if r[0] == "a"]
    # 25 is exactly the timeout after 5 and extends; 45.000001 is a microsecond too late
    assert got == [("a", 3, 3, 25.0), ("a", 4, 1, 45.000001)]


def test_batch_report_equals_walking(spark):
    rng = random.Random(2)
    events = [(f"k{rng.randrange(5)}", rng.randrange(2000)) for _ in range(300)]
    df = spark.createDataFrame([(k, dt.datetime(2022, 1, 1) + dt.timedelta(seconds=t)) for k, t in events], "id string, event_time timestamp")
    until = F.lit("2022-01-01 00:25:00").cast("timestamp")
    assert _report(keyed.count_with_timeout_batch(df, "id", "20 seconds", until=until)) == _quiet(events, 20, 1500)


class Threshold:
    """A user's own process: says when a key has passed three rows, forgets it after a minute without rows."""

    def rows(self, key, state, rows):
        n, last = state or (0, 0)
        before = n
        for pdf in rows:
            n += len(pdf)
            last = max(last, int(pdf["us"].max()))
        return ([(n, "passed")] if before <= 3 < n else []), (n, last), last + 60_000_000

    def timer(self, key, state, at):
        return [(state[0], "forgotten")], None, None


def test_a_users_own_process(spark):
    inp, out = scratch_path(spark, "own-in"), scratch_path(spark, "own-out")
    for n, (key, times) in enumerate([("a", (0, 1)), ("a", (2, 3, 4)), ("b", (200,)), ("b", (201,)), ("a", (300,)), ("b", (500,))]):
        _write(inp, f"{n}.txt", [_envelope(key, 0, _at(t)) for t in times])
    keyed.use_rocksdb(spark)
    parsed = job.parse_stage(job.source_frame(spark, {"input_path": inp, "max_files_per_trigger": 1}), {})
    rows = parsed.select("table_name", "event_time", F.unix_micros("event_time").alias("us")).withWatermark("event_time", "1 second")
    q = (keyed.process(rows, ["table_name"], Threshold(), "n bigint, what string").writeStream.outputMode("append")
         .format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/_c").trigger(availableNow=True).start())
    q.awaitTermination()
    got = [(r.table_name, r.n, r.what) for r in spark.read.parquet(f"{out}/rows").collect()]
    assert sorted(got) == [("a", 1, "forgotten"), ("a", 5, "forgotten"), ("a", 5, "passed"), ("b", 2, "forgotten")]
