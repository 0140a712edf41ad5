"""Document state (O1, N13) and event-time rollups."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import state, windows
from tributary.session import scratch_path


def _docs(spark, rows):
    return spark.createDataFrame(rows, "index_name string, doc_id string, doc string, is_delete boolean, "
                                       "operation string, event_time timestamp, seq long")


T0 = dt.datetime(2022, 1, 1)


def test_latest_and_deletes(spark):
    rows = [("i", "a", "v1", False, "update", T0, 1), ("i", "a", "v2", False, "update", T0, 2),
            ("i", "b", "x1", False, "insert", T0, 3), ("i", "b", "del", True, "delete", T0 + dt.timedelta(1), 4),
            ("i", "c", "late", False, "update", T0 - dt.timedelta(1), 9), ("i", "c", "new", False, "update", T0, 5)]
    df = _docs(spark, rows)
    keep = {r["doc_id"]: r["doc"] for r in state.latest_documents(df, apply_deletes=False).collect()}
    assert keep == {"a": "v2", "b": "del", "c": "new"}
    live = {r["doc_id"]: r["doc"] for r in state.latest_documents(df).collect()}
    assert live == {"a": "v2", "c": "new"}


def _files(spark, path):
    from tributary.session import local_path
    return {str(f): f.stat().st_size for f in pathlib.Path(local_path(path)).rglob("*.parquet")}


def test_state_appends_batches_once(spark):
    path = scratch_path(spark, "state-test")
    b1 = _docs(spark, [("i", "a", "v1", False, "u", T0, 1), ("j", "z", "z1", False, "u", T0, 2)])
    b2 = _docs(spark, [("i", "a", "v2", False, "u", T0, 3), ("i", "b", "b1", False, "u", T0, 4)])
    store = state.StateStore(spark, path)
    assert store.append(b1, "s", 0) and store.append(b2, "s", 1)
    assert not store.append(b2, "s", 1)  # replayed batch
    assert not state.StateStore(spark, path).append(b1, "s", 0)  # and after a restart
    want = {("i", "a"): ("v2", 2), ("i", "b"): ("b1", 1), ("j", "z"): ("z1", 1)}

    def got():
        return {(r["index_name"], r["doc_id"]): (r["doc"], r["n_versions"]) for r in state.read_index(spark, path).collect()}
    assert got() == want
    assert {r["doc_id"] for r in state.read_index(spark, path, "j").collect()} == {"z"}
    store.compact()
    assert got() == want and len(store.snapshot()["parts"]) == 1
    assert not store.append(b2, "s", 1) and store.append(b2, "other", 1)
    assert got()["i", "a"] == ("v2", 3)
    before = _files(spark, path)
    assert len(store.vacuum(keep=1)) == 2 and got()["i", "a"] == ("v2", 3) and len(_files(spark, path)) < len(before)


def test_failure_between_write_and_commit_loses_nothing(spark, monkeypatch):
    path = scratch_path(spark, "state-fail")
    store = state.StateStore(spark, path)
    store.append(_docs(spark, [("i", "a", "v1", False, "u", T0, 1)]), "s", 0)
    b2 = _docs(spark, [("i", "a", "v2", False, "u", T0, 2), ("i", "b", "b1", False, "u", T0, 3)])

    def die(self, entry):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(state.StateStore, "_commit", die)
        with pytest.raises(RuntimeError):
            store.append(b2, "s", 1)
        with pytest.raises(RuntimeError):
            store._commit({})
    assert [(r["doc"], r["n_versions"]) for r in store.read().collect()] == [("v1", 1)]
    again = state.StateStore(spark, path)
    assert again.append(b2, "s", 1)
    assert sorted((r["doc"], r["n_versions"]) for r in again.read().collect()) == [("b1", 1), ("v2", 2)]
    with pytest.raises(Exception):  # a second writer cannot take a number that is there
        again._commit(again.snapshot())


def test_bytes_written_follow_the_batch(spark):
    path = scratch_path(spark, "state-size")
    store = state.StateStore(spark, path)
    store.append(_docs(spark, [("i", f"d{k}", "x" * 50 + str(k), False, "u", T0, k) for k in range(4000)]), "s", 0)
    first = _files(spark, path)
    store.append(_docs(spark, [("i", f"d{k}", "y", False, "u", T0, 9000 + k) for k in range(20)]), "s", 1)
    second = {f: n for f, n in _files(spark, path).items() if f not in first}
    assert set(first) <= set(_files(spark, path)) and sum(second.values()) < sum(first.values()) / 5
    assert store.read().where("doc = 'y'").count() == 20


def test_versions_of_one_event_time_follow_arrival(spark):
    path = scratch_path(spark, "state-order")
    store = state.StateStore(spark, path)
    for n, (doc, gone) in enumerate([("zzz", False), ("aaa", False), ("bbb", True)]):
        store.append(_docs(spark, [("i", "a", doc, gone, "delete" if gone else "update", T0, None)]), "s", n)
    row = store.read(apply_deletes=False).first()
    assert (row["doc"], row["is_delete"], row["n_versions"]) == ("bbb", True, 3)
    assert store.read().count() == 0


def test_numeric_index_names_stay_text(spark):
    path = scratch_path(spark, "state-numeric")
    state.StateStore(spark, path).append(_docs(spark, [("007", "a", "v", False, "u", T0, 1)]), "s", 0)
    assert [r["index_name"] for r in state.read_index(spark, path, "007").collect()] == ["007"]


def test_hot_document_reduces(spark):
    # one document id holds most rows: the partial aggregation keeps it cheap and exact
    rows = [("i", "hot", f"v{k}", False, "u", T0 + dt.timedelta(seconds=k), k) for k in range(2000)]
    rows += [("i", f"d{k}", "x", False, "u", T0, k) for k in range(100)]
    out = {r["doc_id"]: r for r in state.latest_documents(_docs(spark, rows)).collect()}
    assert out["hot"]["doc"] == "v1999" and out["hot"]["n_versions"] == 2000 and len(out) == 101


def _brute_sessions(events, gap):
    out = []
    for k in sorted({e[0] for e in events}):
        ts = sorted(e[1] for e in events if e[0] == k)
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if t - prev > gap:
                out.append((k, start, prev + gap, n))
                start, n = t, 0
            n += 1
            prev = t
        out.append((k, start, prev + gap, n))
    return sorted(out)


def test_sessions_match_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    events = []
    for k in range(6):
        t = T0
        for _ in range(40 if k else 1500):  # key 0 holds most rows
            t += dt.timedelta(minutes=rnd.choice([1, 5, 20, 29, 30, 31, 45, 90, 200]))
            events.append((k, t))
    df = spark.createDataFrame(events, "k long, event_time timestamp")
    got = sorted(tuple(r) for r in windows.session_counts(df, "30 minutes", "k").collect())
    assert got == _brute_sessions(events, dt.timedelta(minutes=30))
    native = sorted(tuple(r) for r in windows.session_counts_stream(df, "30 minutes", "k").collect())
    assert got == native


def test_window_counts_and_health(spark):
    rows = [("t1", T0, T0 + dt.timedelta(milliseconds=5), "äbc", True),
            ("t1", T0 + dt.timedelta(milliseconds=500), T0 + dt.timedelta(seconds=2), "de", True),
            ("t2", T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(seconds=1), "f", False)]
    df = spark.createDataFrame(rows, "table_name string, event_time timestamp, arrival_time timestamp, "
                                     "value string, kept boolean")
    w = {(r["window_start"], r["table_name"]): r["n"] for r in windows.table_window_counts(df).collect()}
    assert w == {(T0, "t1"): 2, (T0 + dt.timedelta(seconds=1), "t2"): 1}
    h = windows.stream_health(df, kept_col="kept").first()
    assert (h["records_in"], h["bytes_in"], h["records_kept"], h["bytes_kept"]) == (3, 7, 2, 6)
    assert (h["lag_records"], h["max_lag_ms"], h["sum_lag_ms"], round(h["avg_lag_ms"], 2)) == (3, 1500, 1505, 501.67)


def test_output_volume(spark):
    rows = [("i", "a", "12345", T0), ("i", "b", "12", T0 + dt.timedelta(seconds=30)),
            ("j", "c", "1", T0 + dt.timedelta(minutes=1))]
    df = spark.createDataFrame(rows, "index_name string, doc_id string, doc string, written_at timestamp")
    got = sorted(tuple(r) for r in windows.output_volume(df).collect())
    assert got == [(T0, "i", 2, 7), (T0 + dt.timedelta(minutes=1), "j", 1, 1)]
