"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import phrases as ph

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=100, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        counts = {p: a for p, a in counts.items() if a >= least}
        inside = set()
        for q, b in counts.items():
            for k in range(2, len(q)):
                inside |= {q[i:i + k] for i in range(len(q) - k + 1) if b >= counts[q[i:i + k]]}
        scored = []
        for p, a in counts.items():
            if len(p) > 1 and p not in inside:
                score, j = min((1000 * a * n[lang] // (counts[p[:j]] * counts[p[j:]]), j) for j in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:j]], counts[p[j:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
                for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_table_equals_brute_force(docs):
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    want = brute(rows, least=20)
    assert len({len(r[2].split(" ")) for r in want}) >= 3
    assert got(ph.collocations(docs, least=20)) == want
    assert got(ph.collocations(docs)) == brute(rows)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])  # a full bitmap counts more, and finds the same
def test_planted_phrases(spark, bits):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["É", "中文", "a\x00b", "new", "york", "city", "hall", "x y", "|"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "]) for _ in range(60))
        lang = rng.choice(["en", "en", "en", "de", None, "und"])
        rows.append((lang, text + rng.choice(["", " New York City Hall", " New York", " the the the the the the"])))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(5)
    want = brute(rows, least=10, top=50)
    assert got(ph.collocations(df, least=10, top=50, bits=bits)) == want
    assert any(r[2] == "new york" for r in want)


def test_ties_are_ranked_by_bytes(spark):
    text = " . ".join(f"{a} {b}" for a, b in [("z", "é"), ("a", "中"), ("b", "y"), ("ab", "c")] * 3)
    df = spark.createDataFrame([(1, "xx", text)], "doc_id long, lang string, text string")
    assert got(ph.collocations(df, least=3)) == brute([("xx", text)], least=3)
    assert got(ph.collocations(df, least=3, top=2)) == brute([("xx", text)], least=3, top=2)


def test_large_counts_stay_exact(spark):
    """1000 * a * n beyond 64 bits."""
    counts = spark.createDataFrame([(10 ** 14 + 7, 3 * 10 ** 15 + 1, 10 ** 14 + 9, 10 ** 15 + 3)], "a long, n long, l long, r long")
    row = counts.select(F.expr(ph.SCORE).alias("s"), "*").first()
    assert row.s == 1000 * row.a * row.n // (row.l * row.r)


def test_edge_rows(spark):
    schema = "doc_id long, lang string, text string, rank int, phrase string, n string, k int, prefix string"
    rows = [(1, None, None, 1, "p", "q", 2, ""), (2, "en", "", 1, "p", "q", 2, ""), (2, "en", " .,;\n", 1, "p", "q", 2, ""),
            (None, "", "A a  a" * 50000, 1, "p", "q", 2, ""), (3, "und", "b c", 1, "p", "q", 2, ""), (3, "und", "b c", 1, "p", "q", 2, ""),
            (4, None, "B c", 1, "p", "q", 2, "")]
    df = spark.createDataFrame(rows, schema)
    assert got(ph.collocations(df, least=3)) == brute([(r[1], r[2]) for r in rows], least=3)
    assert ph.collocations(df.limit(0)).count() == 0


def test_tasks_hand_on_groups_not_phrases(spark):
    """Rows that are shuffled are as many for any number of frequent phrases."""
    known = spark.sparkContext.broadcast(np.full(1 << 10, 255, np.uint8))
    text = " . ".join(f"a{i} b{i} c{i}" for i in range(4 * ph.GROUPS))
    docs = spark.createDataFrame([("en", text)] * 3, "lang string, text string").select("text", "lang").repartition(3)
    handed = ph._stripes(docs, 5, [known, known])
    assert handed.count() <= 3 * ph.GROUPS
    merged = {(r.k, r.phrase): r.n for r in ph._merged(handed, 5, 3).collect()}
    assert len(merged) == 1 + 6 * 4 * ph.GROUPS and merged.pop((0, None)) == 9 * 4 * ph.GROUPS
    assert set(merged.values()) == {3}


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_groups_handed_on_unfinished(spark, monkeypatch, longest):
    monkeypatch.setattr(ph, "MERGE_ENTRIES", 60)
    monkeypatch.setattr(ph, "FLUSH_ENTRIES", 10)
    rng = random.Random(9)
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choice(["a", "b", "cc", "é", "d."]) for _ in range(80))) for _ in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(4)
    assert got(ph.collocations(df, least=5, longest=longest)) == brute(rows, least=5, longest=longest)
