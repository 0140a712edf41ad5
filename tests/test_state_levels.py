"""The levelled state: cost of merging, lookups that open few runs, failures between write and commit."""

import datetime as dt
import math
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import state
from tributary.session import local_path, scratch_path

T0 = dt.datetime(2022, 1, 1)
SCHEMA = ("index_name string, doc_id string, doc string, is_delete boolean, operation string, event_time timestamp, "
          "seq long")


def _batch(spark, keys, version, index="i", gone=()):
    return spark.createDataFrame([(index, f"d{k}", f"v{version}", k in gone, "u", T0 + dt.timedelta(seconds=version), version)
                                  for k in keys], SCHEMA)


def _model(batches):
    """Document -> (doc, deleted, versions) after all batches."""
    out = {}
    for version, (keys, gone) in enumerate(batches):
        for k in keys:
            out[f"d{k}"] = (f"v{version}", k in gone, out.get(f"d{k}", (0, 0, 0))[2] + 1)
    return out


def _state(df):
    return {r["doc_id"]: (r["doc"], r["is_delete"], r["n_versions"]) for r in df.collect()}


def test_random_batches_equal_a_dictionary(spark):
    rng = random.Random(1)
    store = state.StateStore(spark, scratch_path(spark, "levels"), buckets=3)
    batches = []
    for n in range(14):
        keys = rng.sample(range(60), rng.randrange(0, 30))
        batches.append((keys, set(rng.sample(keys, len(keys) // 6))))
        assert store.append(_batch(spark, keys, n, gone=batches[-1][1]), "s", n, compact_every=3)
        assert not store.append(_batch(spark, keys, n), "s", n)
    want = _model(batches)
    assert _state(store.read(apply_deletes=False)) == want
    assert _state(store.read("i")) == {k: v for k, v in want.items() if not v[1]}
    for ids in (["d1"], ["d2", "d3", "missing"], [f"d{k}" for k in range(60)]):
        assert _state(store.lookup("i", ids, apply_deletes=False)) == {k: v for k, v in want.items() if k in ids}
    assert store.lookup("other", ["d1"]).count() == 0 and store.runs_for("other", ["d1"]) == []
    store.compact()
    runs = store.snapshot()["runs"]
    assert sorted(r["bucket"] for r in runs) == [0, 1, 2] and sum(r["rows"] for r in runs) == len(want)
    assert _state(store.read(apply_deletes=False)) == want
    assert store.append(_batch(spark, [1], 99), "s", 14) and _state(store.read("i"))["d1"][0] == "v99"
    assert _state(state.read_index(spark, store.path, "i", doc_ids=["d1"])) == {"d1": ("v99", False, want["d1"][2] + 1)}


def test_merging_costs_a_logarithm(spark):
    """Distinct documents: a row is rewritten at most once per tier."""
    store, fan_in, rows, batches = state.StateStore(spark, scratch_path(spark, "log"), buckets=2), 3, 40, 27
    most = 0
    for n in range(batches):
        before = store.snapshot()["rows_rewritten"]
        store.append(_batch(spark, range(n * rows, n * rows + rows), n), "s", n, compact_every=fan_in)
        now = store.snapshot()
        most = max(most, now["rows_rewritten"] - before)
        # in a bucket at most fan_in - 1 runs of a tier, and what waits for its turn
        assert len([r for r in now["runs"] if r["bucket"] is None]) < fan_in
    assert most <= state.MERGE_BUDGET * fan_in * rows  # no append rewrites the whole state
    tiers = math.log(batches, fan_in) + 1
    assert now["rows_rewritten"] <= batches * rows * tiers
    assert store.read().count() == batches * rows


def test_waiting_merges_are_done_later(spark):
    store = state.StateStore(spark, scratch_path(spark, "later"), buckets=4)
    for n in range(9):
        store.append(_batch(spark, range(n * 30, n * 30 + 30), n), "s", n, compact_every=3, merge_rows=0)
    waiting = store.due(3)
    assert waiting
    assert store.merge_due(3, budget=0) == sum(r["rows"] for r in waiting[0])  # one merge at least
    assert len(store.due(3)) == len(waiting) - 1
    store.merge_due(3)
    assert store.due(3) == [] and store.read().count() == 270


def test_lookup_opens_few_runs(spark):
    store = state.StateStore(spark, scratch_path(spark, "lookup"), buckets=4)
    for n in range(8):
        store.append(_batch(spark, range(n * 500, n * 500 + 500), n), "s", n, compact_every=4, merge_rows=0)
    runs = store.snapshot()["runs"]
    assert len(runs) == 8
    opened = [len(store.runs_for("i", [f"d{k}"])) for k in range(0, 4000, 131)]
    assert all(n >= 1 for n in opened) and sum(opened) <= 1.2 * len(opened)
    assert sum(len(store.runs_for("i", [f"x{k}"])) for k in range(30)) <= 6  # unknown ids open next to none
    df = store.lookup("i", ["d777"])
    assert _state(df) == {"d777": ("v1", False, 1)}
    parts = {f.split("part=")[1].split("/index_name")[0] for f in df.inputFiles()}
    assert parts == {f"{r['part']}/bucket={r['bucket']}" for r in store.runs_for("i", ["d777"])}


def test_a_lost_merge_changes_nothing(spark, monkeypatch):
    store = state.StateStore(spark, scratch_path(spark, "lost"), buckets=2)
    for n in range(4):
        store.append(_batch(spark, range(20), n), "s", n, compact_every=0)
    before = _state(store.read())

    def die(self, entry):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(state.StateStore, "_commit", die)
        with pytest.raises(RuntimeError):
            store.merge_due(4)
    assert _state(store.read()) == before and len(store.snapshot()["parts"]) == 4
    store.merge_due(4)
    assert _state(store.read()) == before and {r["bucket"] for r in store.snapshot()["runs"]} == {0, 1}
    # the four deltas, the lost part; then a merged bucket that is superseded
    assert len(store.vacuum(keep=1)) == 5
    filters = pathlib.Path(local_path(store.path)) / "filter"
    assert len(list(filters.iterdir())) == 1


def test_ids_of_any_text(spark):
    ids = ["", " ", "é中", "a\x00b", "%_'\"\\", "x" * 5000]
    rows = [("007", i, "doc", False, "u", T0, n) for n, i in enumerate(ids)] + [("8", "", "other", False, "u", T0, 1)]
    store = state.StateStore(spark, scratch_path(spark, "odd-ids"), buckets=2)
    for n in range(2):
        store.append(spark.createDataFrame(rows, SCHEMA), "s", n, compact_every=2)
    for i in ids:
        assert _state(store.lookup("007", [i])) == {i: ("doc", False, 2)}
    assert _state(store.lookup("8", [""])) == {"": ("other", False, 2)}


def test_empty_batches(spark):
    store = state.StateStore(spark, scratch_path(spark, "empty"))
    for n in range(3):
        assert store.append(_batch(spark, [], n), "s", n, compact_every=2)
    assert store.snapshot()["runs"] == [] and store.read().count() == 0 and store.lookup("i", ["a"]).count() == 0
    assert not store.append(_batch(spark, [1], 0), "s", 2)
    assert store.read().agg(F.count("*")).first()[0] == 0
