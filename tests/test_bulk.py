"""Bulk requests (O2) against packing row by row."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.operators import bulk

SCHEMA = "index_name string, doc_id string, doc string, is_delete boolean, event_time timestamp, seq long"
T0 = dt.datetime(2022, 1, 1)


def _lines(r):
    target = json.dumps({"_index": r[0], "_id": r[1]}, separators=(",", ":"), ensure_ascii=False)
    return f'{{"delete":{target}}}\n' if r[3] else f'{{"index":{target}}}\n{r[2]}\n'


def plain(rows, shard, max_bytes, max_actions):
    """Requests by adding documents one at a time."""
    by = defaultdict(list)
    for r in rows:
        by[shard(r)].append(r)
    out = []
    for s, docs in by.items():
        requests = [[]]
        for line in (_lines(r) for r in sorted(docs, key=lambda r: (r[4], r[5], _lines(r)))):
            now = requests[-1]
            if now and (len(now) == max_actions or len("".join([*now, line]).encode()) > max_bytes):
                requests.append([])
            requests[-1].append(line)
        out += [(s, i, len(q), len("".join(q).encode()), "".join(q)) for i, q in enumerate(requests)]
    return sorted(out)


@pytest.mark.parametrize("max_bytes,max_actions", [(400, 1000), (10 ** 6, 7), (500, 4), (1, 1), (10 ** 9, 10 ** 9)])
def test_requests_equal_plain_packing(spark, max_bytes, max_actions):
    rng = random.Random(max_bytes)
    rows = [("i" if rng.random() < .7 else "é", f"d{rng.randrange(40)}", json.dumps({"v": "ü" * rng.randrange(60)}), rng.random() < .2,
             T0 + dt.timedelta(seconds=rng.randrange(50)), rng.randrange(3)) for _ in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    number = F.substring("doc_id", 2, 9).cast("int") % 3
    got = bulk.bulk_requests(df, max_bytes, max_actions, shard=number)
    want = plain(rows, lambda r: int(r[1][1:]) % 3, max_bytes, max_actions)
    assert sorted(map(tuple, got.collect())) == want
    assert all(r[3] <= max_bytes or r[2] == 1 for r in want)


def test_versions_of_a_document_stay_in_order(spark):
    rows = [("i", f"d{k % 7}", str(n), False, T0 + dt.timedelta(seconds=n), n) for n, k in enumerate(range(210))]
    got = bulk.bulk_requests(spark.createDataFrame(rows, SCHEMA).repartition(4), max_actions=9, shards=3).orderBy("shard", "request").collect()
    seen = defaultdict(list)
    for r in got:
        lines = r.body.splitlines()
        for action, doc in zip(lines[::2], lines[1::2]):
            seen[json.loads(action)["index"]["_id"]].append(int(doc))
    assert {k: sorted(v) for k, v in seen.items()} == dict(seen) and sum(map(len, seen.values())) == 210


def test_deletes_and_edges(spark):
    rows = [("i", "a", None, True, T0, 1), ("i", "b", None, False, T0, 2), ("i", "c\"\n", "{}", True, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    body = "".join(r.body for r in bulk.bulk_requests(df, shards=1).collect())
    assert body == '{"delete":{"_index":"i","_id":"c\\"\\n"}}\n{"delete":{"_index":"i","_id":"a"}}\n'  # no document, no request
    kept = "".join(r.body for r in bulk.bulk_requests(df, shards=1, apply_deletes=False).collect())
    assert kept == '{"index":{"_index":"i","_id":"c\\"\\n"}}\n{}\n'
    assert bulk.bulk_requests(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bulk.bulk_requests(df, max_actions=0)


def test_bulk_output_of_the_job(spark):
    from tests.test_streaming import _envelope, _write
    from tributary.session import scratch_path
    from tributary.streaming import job
    inp, out = scratch_path(spark, "bulk-in"), scratch_path(spark, "bulk-out")
    _write(inp, "0.txt", [_envelope("t", k, "2022-01-01T00:00:00Z", op="delete" if k == 5 else "update") for k in range(20)])
    job.run_batch(spark, {"input_path": inp, "output_bulk": f"{out}/bulk", "bulk_max_actions": 6, "bulk_shards": 1})
    got = spark.read.parquet(f"{out}/bulk").orderBy("request").collect()
    assert [r.n_actions for r in got] == [6, 6, 6, 2]
    actions = [json.loads(x) for r in got for x in r.body.splitlines()]
    assert sum("delete" in a for a in actions) == 1 and [a["id"] for a in actions if "id" in a] == [k for k in range(20) if k != 5]
