"""Keyed processing with event-time timers, and the count with timeout built on it.

:func:`process` runs a :class:`KeyedProcess` over a stream: its state is any
picklable tuple per key, its one timer is an event time. A timer fires once the
watermark has passed it, in the batch that brings rows of its key or in one
that brings none. State lives in the query's state store (RocksDB, so it may be
larger than memory) and is checkpointed with the query: a restart goes on where
the stream stopped.

:func:`count_with_timeout` reports a key each time it has been quiet for a
timeout: how many events it has had so far, how many since its last report, and
when the last one was. Rows of a key become intervals (first, last, count; no
gap above the timeout inside) in the tasks that read them, so a key that holds
a third of all rows sends a few rows per task to its state.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tributary.operators.windows import DEFAULT_WATERMARK, _interval_seconds

# Fixed value: the state store that keeps state on local disk and checkpoints changes.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of queries started from now on may grow beyond memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class KeyedProcess(Protocol):
    """What a user writes. Both methods give rows to emit, the new state (``None`` drops the key) and the next
    timer in epoch microseconds (``None``: none)."""

    def rows(self, key: tuple, state: Any, rows: Iterator[pd.DataFrame]) -> tuple[Iterable[tuple], Any, int | None]: ...

    def timer(self, key: tuple, state: Any, at: int) -> tuple[Iterable[tuple], Any, int | None]: ...


def process(df: DataFrame, key_cols: list[str], user: KeyedProcess, output_schema: str) -> DataFrame:
    """Run ``user`` over a watermarked stream; ``output_schema`` has no key columns, they come first.

    Timers that are due when rows of a key arrive fire before the rows are
    handed over; a timer set behind the watermark fires at once.
    """
    keys = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in key_cols)
    names = [*key_cols, *[f.strip().split()[0] for f in output_schema.split(",")]]

    def run(key: tuple, rows: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        watermark = group.getCurrentWatermarkMs() * 1000
        state, timer = pickle.loads(group.get[0]) if group.exists else (None, None)
        out: list[tuple] = []

        def fire(state, timer):
            while timer is not None and timer <= watermark:
                found, state, timer = user.timer(key, state, timer)
                out.extend((*key, *r) for r in found)
            return state, timer
        state, timer = fire(state, timer)
        if not group.hasTimedOut:
            found, state, timer = user.rows(key, state, rows)
            out.extend((*key, *r) for r in found)
            state, timer = fire(state, timer)
        if state is None:
            if group.exists:
                group.remove()
        else:
            group.update((pickle.dumps((state, timer)),))
            if timer is not None:
                # the store counts milliseconds and fires when the watermark is above
                group.setTimeoutTimestamp(max(-(-timer // 1000) - 1, watermark // 1000 + 1))
        if out:
            yield pd.DataFrame(out, columns=names)
    return df.groupBy(*key_cols).applyInPandasWithState(
        run, f"{keys}, {output_schema}", "state binary", "append", GroupStateTimeout.EventTimeTimeout)


def _intervals(key: pa.Array, t: np.ndarray, gap: int) -> pa.RecordBatch:
    """Runs of events of one key with no gap above ``gap``: first, last, count."""
    codes = key.dictionary_encode()
    k = codes.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((t, k))
    k, t = k[order], t[order]
    new = np.ones(len(t), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] - t[:-1] > gap)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(t)) - 1
    return pa.RecordBatch.from_arrays([codes.dictionary.take(pa.array(k[first])), pa.array(t[first]), pa.array(t[last]),
                                       pa.array(last - first + 1)], ["key", "s", "e", "n"])


class QuietKeys:
    """Emits ``(n, burst, last_change)`` when a key has been quiet for ``gap`` microseconds.

    State: events reported so far, and the open intervals (first, last, count)
    in time order. Late events join an interval that is still open.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def rows(self, key, state, rows):
        total, spans = state or (0, [])
        for pdf in rows:
            spans = spans + list(zip(pdf["s"].tolist(), pdf["e"].tolist(), pdf["n"].tolist()))
        merged: list[tuple[int, int, int]] = []
        for s, e, n in sorted(spans):
            if merged and s - merged[-1][1] <= self.gap:
                a, b, m = merged[-1]
                merged[-1] = (a, max(b, e), m + n)
            else:
                merged.append((s, e, n))
        return [], (total, merged), merged[0][1] + self.gap

    def timer(self, key, state, at):
        total, spans = state
        (_, last, n), rest = spans[0], spans[1:]
        total += n
        return [(total, n, pd.Timestamp(last, unit="us"))], (total, rest), rest[0][1] + self.gap if rest else None


def count_with_timeout(df: DataFrame, key_col: str, timeout: str, ts_col: str = "event_time",
                       watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """``(key, n, burst, last_change)`` each time a key of the stream has had no event for ``timeout``.

    ``n`` counts all its events so far, ``burst`` those since its last report. An
    event exactly ``timeout`` after the one before it still extends the burst. A
    report comes once the watermark has passed ``last_change + timeout``; a key
    keeps its total. Rows without a key or time are left out, and so are rows
    behind the watermark (see the job's ``late_after`` to keep them).
    """
    gap = _interval_seconds(timeout) * 1_000_000

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                yield _intervals(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), gap)
    kind = df.schema[key_col].dataType.simpleString()
    spans = (df.where(F.col(key_col).isNotNull() & F.col(ts_col).isNotNull())
               .select(F.col(key_col).alias("key"), F.unix_micros(ts_col).alias("t"))
               .mapInArrow(task, f"key {kind}, s bigint, e bigint, n bigint")
               .withColumn("at", F.timestamp_micros("e")).withWatermark("at", watermark))
    return (process(spans, ["key"], QuietKeys(gap), "n bigint, burst bigint, last_change timestamp")
            .withColumnRenamed("key", key_col))


def count_with_timeout_batch(df: DataFrame, key_col: str, timeout: str, ts_col: str = "event_time",
                             until: F.Column | None = None) -> DataFrame:
    """The same report over a bounded table: every quiet spell that ends before ``until`` (all if ``None``)."""
    from pyspark.sql import Window

    from tributary.operators.windows import session_counts
    bursts = session_counts(df.where(F.col(key_col).isNotNull()), timeout, key_col, ts_col)
    total = F.sum("n").over(Window.partitionBy(key_col).orderBy("session_end").rowsBetween(Window.unboundedPreceding, 0))
    out = bursts.select(key_col, total.alias("n"), F.col("n").alias("burst"), "session_end")
    if until is not None:
        out = out.where(F.col("session_end") <= until)
    gap = F.expr(f"interval {_interval_seconds(timeout)} seconds")
    return out.select(key_col, "n", "burst", (F.col("session_end") - gap).alias("last_change"))
