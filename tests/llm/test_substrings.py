"""Long-substring removal against every window of every text in one dictionary."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tributary.llm import rindex, substrings


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        hit = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        kept = bytes(b for b, h in zip(r, hit) if not h)
        runs = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out.append((d, len(r), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_suffix_array_and_runs():
    rng = random.Random(1)
    t = np.array([rng.randrange(3) for _ in range(500)] * 3 + [9], np.int64)
    sa = rindex.suffix_array(t)
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    index = rindex.RunIndex.build(t)
    bwt = np.repeat(index.symbols, index.lengths)
    assert bwt.tolist() == t[sa - 1].tolist() and len(index.symbols) < len(t) / 2


def test_index_marks_equal_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        part = "".join(rng.choice("abc") for _ in range(40)).encode()
        strings = []
        for _ in range(6):
            a, b = sorted((rng.randrange(41), rng.randrange(41)))
            strings.append("".join(rng.choice("abcd") for _ in range(rng.randrange(15))).encode() + part[a:b]
                           + "".join(rng.choice("abcd") for _ in range(rng.randrange(15))).encode())
        strings = list(dict.fromkeys(s for s in strings if s))
        hit = [bytearray(len(s)) for s in strings]
        for i, a, b in rindex.repeated_spans(strings, 8):
            hit[i][a:b] = b"\1" * (b - a)
        seen = Counter(s[i:i + 8] for s in strings for i in range(len(s) - 7))
        want = [bytearray(len(s)) for s in strings]
        for w, s in zip(want, strings):
            for i in range(len(s) - 7):
                if seen[s[i:i + 8]] > 1:
                    w[i:i + 8] = b"\1" * 8
        assert hit == want


def test_table_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(substrings.remove_repeats(docs)) == brute(rows, substrings.LENGTH)


@pytest.mark.parametrize("group", [2, 2000])
def test_hot_passage_and_periodic_texts(frame, group):
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))
    hot, short = noise(60), noise(17)
    texts = [noise(rng.randrange(40)) + hot[rng.randrange(12):60 - rng.randrange(12)] + noise(rng.randrange(60)) for _ in range(25)]
    texts += [noise(30) + short + noise(30) for _ in range(25)]
    texts += ["=" * 150, "=" * 25 + "x", "ab" * 70, "ab" * 9, noise(300) + hot, texts[0], texts[1], "", None, "é" * 40, "x" * 19]
    df = frame(texts)
    out = substrings.remove_repeats(df, length=20, gram=6, group=group, widths=(6, 2, 1))
    assert got(out) == brute(list(enumerate(texts)), 20)


def test_edge_rows(frame):
    text = "abcdefghij" * 60
    rows = [(1, text), (1, text), (None, None), (None, "z" + text), (2, "short")]
    df = frame([t for _, t in rows], [d for d, _ in rows]).selectExpr("*", "1 as digest", "2 as rep", "3 as n_bytes", "'k' as key")
    assert got(substrings.remove_repeats(df)) == brute(rows, 400)
    assert substrings.remove_repeats(frame([])).count() == 0


def test_groups_stay_whole_when_a_join_is_replanned(spark):
    """The group sizes turn out small enough to broadcast, so the shuffle of the spans by their key is read locally."""
    rng = random.Random(12)
    rows = []
    for key in range(400):
        part = rng.randbytes(150)
        rows += [(key, b"%d" % i, key, 0, 1, 0, True, rng.randbytes(40) + part + rng.randbytes(800)) for i in range(4)]
    spans = spark.createDataFrame(spark.sparkContext.parallelize(rows[::4] + rows[1::4] + rows[2::4] + rows[3::4], 4), substrings._SPANS)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "256k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sized = spans.join(spans.groupBy("key").count(), "key").where("count <= 2000")
        marks = substrings._indexed(sized, 150).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    covered = {(m.rep, m.digest) for m in marks if m.s <= 40 and m.e >= 190}
    assert covered == {(r[2], r[1]) for r in rows}
