"""Shards: the law, slots, checksums, and how few links are torn."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.llm import sharding as sh


def check(rows, texts, shards=16):
    """Every promise of the result; gives the shards of each text."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert {r.law for r in rows} <= {"rows"} and all(r.grown_shard is None for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def spread(rows, texts):
    """Shards each text of several rows lies in (ids are unique here)."""
    of = {r.doc_id: r.shard for r in rows}
    by = defaultdict(set)
    n = Counter(t or "" for _, t in texts)
    for i, t in texts:
        if n[t or ""] > 1:
            by[t or ""].add(of[i])
    return by


def test_table_keeps_equal_texts_together(docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = sh.shard_documents(docs).collect()
    check(rows, texts)
    by = spread(rows, texts)
    assert by and sum(len(s) - 1 for s in by.values()) == 0


def test_groups_of_many_sizes(frame):
    rng = random.Random(6)
    texts = [f"text {i}" for i in range(3000) for _ in range(1 if i % 3 else rng.randrange(2, 9))]
    rng.shuffle(texts)
    df = frame(texts).repartition(6)
    rows = sh.shard_documents(df, bucket_rows=200).collect()
    pairs = list(enumerate(texts))
    check(rows, pairs)
    by = spread(rows, pairs)
    assert sum(len(s) == 1 for s in by.values()) >= 0.97 * len(by)


def test_hot_group_tears_between_stars(frame):
    """A third of all rows are one text: no shard holds it, and few of its links are torn."""
    texts = ["hot"] * 2000 + [f"pair {i // 2}" for i in range(1000)] + [f"one {i}" for i in range(3000)]
    random.Random(2).shuffle(texts)
    df = frame(texts)
    numbered = df.select(F.col("doc_id").alias("node"), F.unhex(F.sha2("text", 256)).alias("digest"))
    links = sh.equal_text_links(numbered, 64)
    assert links.count() == 1999 + 500
    rows = sh.balanced_shards(numbered.select("node"), links, bucket_rows=500).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == 6000 and set(counts.values()) == {375}
    labels = df.sparkSession.createDataFrame([(r.node, r.shard) for r in rows], "node long, label int")
    assert sh.cut_links(links, labels) < 0.08 * links.count()  # dealt by hash: 15 of 16
    out = sh.shard_documents(df, bucket_rows=500, stars=64).collect()
    pairs = list(enumerate(texts))
    check(out, pairs)
    by = spread(out, pairs)
    by.pop("hot")
    assert sum(len(s) == 1 for s in by.values()) >= 0.95 * len(by)


def test_general_links_under_quotas(spark):
    """Two dense communities a shard: propagation tears far fewer links than a hash, within the quotas."""
    rng = random.Random(8)
    groups = [list(range(g * 50, g * 50 + 50)) for g in range(16)]
    links = [(a, b) for g in groups for a in g for b in rng.sample(g, 4) if a != b]
    links += [(rng.randrange(800), rng.randrange(800)) for _ in range(60)]
    links = spark.createDataFrame(links, "a long, b long").where("a <> b")
    nodes = spark.range(800).select(F.col("id").alias("node"), F.lit(1).cast("bigint").alias("weight"))
    start = nodes.select("node", F.pmod(F.xxhash64("node"), F.lit(8)).cast("int").alias("label"))
    labels = sh.propagate(nodes, links, 8, 130, rounds=12)
    assert labels.count() == 800 and labels.groupBy("label").count().agg(F.max("count")).first()[0] <= 150
    assert sh.cut_links(links, labels) < 0.6 * sh.cut_links(links, start)
    rows = sh.balanced_shards(nodes.select("node"), links, 8).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == 800 and max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("n", [1, 5, 16, 33])
def test_few_rows(frame, n):
    texts = ["same"] * n
    check(sh.shard_documents(frame(texts)).collect(), list(enumerate(texts)))


def test_edge_rows(frame, spark):
    ids, texts = [1, 1, None, None, 2, 3, 4], ["a", "a", None, "", "x" * 500000, "é\x00", "ok"]
    df = frame(texts, ids).selectExpr("*", "1 as node", "'q' as label", "2 as shard", "3 as digest", "4 as star", "5 as linked")
    check(sh.shard_documents(df).collect(), list(zip(ids, texts)))
    assert sh.shard_documents(frame([])).count() == 0
