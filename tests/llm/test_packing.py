"""Best-fit packing: invariants on whole tables, and a plain best-fit on one shard."""

import random
from collections import Counter, defaultdict

from tributary.llm import packing


def plain(sizes, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(sizes, sources, clusters):
        fit = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= n and s not in b["s"] and c not in b["c"]]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "s": set(), "c": set()})
        bins[i]["room"] -= n
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
        out.append(i)
    return out


def test_best_fit_equals_plain_search():
    rng = random.Random(9)
    for _ in range(20):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.randrange(0, 50) for _ in range(n)), reverse=True)
        sources = [0 if rng.random() < .4 else rng.randrange(8) for _ in range(n)]
        clusters = [rng.randrange(60) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 60) == plain(sizes, sources, clusters, 60)


def check(rows, words, capacity):
    """Whole texts in pieces, no bin too full, no bin with a source or a cluster twice."""
    pieces, room, pairs = defaultdict(list), Counter(), Counter()
    for r in rows:
        pieces[r.doc_id].append((r.start_word, r.n_words))
        room[r.bin_id] += r.n_words
        pairs[r.bin_id, "s", r.source] += 1
        pairs[r.bin_id, "c", r.cluster] += 1
    assert max(room.values()) <= capacity and max(pairs.values()) == 1
    for d, n in words.items():
        at = 0
        for start, size in sorted(pieces[d]):
            assert start == at
            at += size
        assert at == n


def test_table(docs):
    rows = packing.pack(docs).collect()
    check(rows, {r.doc_id: len(r.text.split()) for r in docs.collect()}, packing.CAPACITY)
    assert sorted(r.slot for r in rows)[0] == 0


def test_hot_source_and_edge_rows(spark):
    rows = [(i, " ".join(["w%d" % i] * (i % 90)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(300)]
    rows += [(300, None, None), (301, "", "x"), (302, "a " * 250, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as bin_id", "2 as shard", "3 as piece")
    out = packing.pack(df, capacity=100, shard=64).collect()
    check(out, {d: len((t or "").split()) for d, t, _ in rows}, 100)
    twice = spark.createDataFrame([(None, "a b", "s")] * 4 + [(1, "A  b", "t")], "doc_id long, text string, source string")
    out = packing.pack(twice).collect()
    assert len(out) == 5 and len({r.bin_id for r in out}) == 5 and len({r.cluster for r in out}) == 1
    assert packing.pack(twice.limit(0)).count() == 0
