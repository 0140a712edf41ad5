"""Greedy string tiling against a plain word-by-word version."""

import random
import re
import time
import tracemalloc

import pyarrow as pa

from tributary.llm import ragged, tiling


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("(?:[a-z0-9]|[^\x00-\x7f])+", low)


def plain_tiles(item, text, k):
    """Textbook greedy tiling: longest unmarked common run first, whatever the order of ties."""
    used_i, used_t, covered = set(), set(), 0
    while True:
        best = (k - 1, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while (a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n]
                       and a + n not in used_i and b + n not in used_t):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < k:
            return covered
        used_i |= set(range(a, a + n))
        used_t |= set(range(b, b + n))
        covered += n


def brute(docs, items, k=5, percent=50):
    out = []
    for d, t in docs:
        for i, x in items:
            w, v = words(t), words(x)
            if not v:
                continue
            n = plain_tiles(v, w, min(k, len(v)))
            if 100 * n >= percent * len(v):
                out.append((d, i, len(v), n))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.item_id, r.item_words, r.covered_words) for r in df.collect()), key=str)


def test_planted_passages(frame):
    rng = random.Random(6)

    def noise(n):
        return " ".join(f"v{rng.randrange(900)}" for _ in range(n))
    items = [(i, noise(rng.randrange(6, 40))) for i in range(8)] + [(8, "two words"), (9, None), (10, " .,")]
    docs = [(d, noise(60)) for d in range(10)]
    for d, (i, x) in enumerate(items[:8]):
        w = x.split()
        half = len(w) // 2
        docs += [(100 + d, f"{noise(9)} {x.upper()}. {noise(9)}"),
                 (200 + d, f"{noise(5)} {' '.join(w[half:])}, {noise(4)} {' '.join(w[:half])}!"),
                 (300 + d, noise(3) + " " + " ".join(w[:max(len(w) // 3, 1)]) + " " + noise(3))]
    docs += [(400, "Two, words"), (401, "two"), (None, items[0][1]), (402, None), (402, items[1][1]), (402, items[1][1])]
    df = frame([t for _, t in docs], [d for d, _ in docs]).selectExpr("*", "1 as item_id", "2 as n_tiles")
    bench = frame([t for _, t in items], [i for i, _ in items]).withColumnRenamed("doc_id", "item_id")
    want = brute(docs, items)
    assert {(100 + i, i) for i in range(8)} <= {(d, i) for d, i, _, _ in want}
    assert got(tiling.contaminated(df, bench)) == want
    assert got(tiling.contaminated(df, bench, block_words=20)) == want  # many blocks, same rows


def test_table_equals_brute_force_on_seeded_pairs(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = got(tiling.contaminated(docs, bench))
    grams = {i: {tuple(words(x)[j:j + 5]) for j in range(len(words(x)) - 4)} for i, x in items.items()}
    want = []
    for d, t in texts.items():
        own = {tuple(words(t)[j:j + 5]) for j in range(len(words(t)) - 4)}
        want += brute([(d, t)], [(i, items[i]) for i, g in grams.items() if g & own])
    assert found == sorted(want, key=str)


def test_tiles_do_not_overlap():
    # item a b c d e f, text holds "a b c d" and "c d e f": the second tile is cut to what is left
    assert sorted(n for _, _, n in tiling.tiles([(0, 0, 4), (2, 10, 4)], 6, 14, 2)) == [2, 4]


def _block(texts):
    return ragged.words(*ragged.utf8(pa.array(texts, pa.large_string())), lower=True, punctuation=False)


def test_matches_of_repetitive_texts_equal_plain_tiling():
    rng = random.Random(11)
    items = ["a " * 30, "a b " * 12, "a b c d e f g", "x " * 9 + "y " * 9, "a b a b a c a b a b a c a b"]
    texts = ["a " * 70, "b a " * 40, "a b c d e f g " * 3, "x " * 20, "y " * 7 + "x " * 7, "a b a b a c " * 6 + "q"]
    texts += [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(25)]
    items += [" ".join(rng.choice("ab") for _ in range(25)) for _ in range(6)]
    for k, percent in ((3, 1), (5, 50)):
        found = tiling.Seeds(list(range(len(items))), items, k).matches(_block(texts), percent)
        want = []
        for d, t in enumerate(texts):
            for i, x in enumerate(items):
                n = plain_tiles(words(x), words(t), min(k, len(words(x))))
                if n and 100 * n >= percent * len(words(x)):
                    want.append((d, i, n))
        assert sorted((d, i, n) for d, i, n, _, _ in found) == want


def test_a_phrase_that_all_share_costs_little():
    rng = random.Random(3)

    def noise(n):
        return " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(n))
    phrase = "the same five common words"
    items = [f"{noise(20)} {phrase} {noise(20)}" for _ in range(500)]
    texts = [f"{noise(40)} {phrase} {noise(40)}" for _ in range(2000)] + [items[7], f"{noise(9)} {items[9]}"]
    began = time.perf_counter()
    found = list(tiling.Seeds(list(range(500)), items, 5).matches(_block(texts), 50))
    assert time.perf_counter() - began < 30  # alone on a core: under 5 s
    assert sorted((d, i, n) for d, i, n, _, _ in found) == [(2000, 7, 45), (2001, 9, 45)]


def test_equal_words_over_and_over_stay_small():
    tracemalloc.start()
    found = list(tiling.Seeds([1], ["la " * 800], 5).matches(_block(["la " * 200_000, "la " * 399]), 50))
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    assert found == [(0, 0, 800, 1, 800)]


def test_empty_tables(frame):
    none = frame([]).withColumnRenamed("doc_id", "item_id")
    assert tiling.contaminated(frame(["a b c"]), none).count() == 0
    assert tiling.contaminated(frame([]), frame(["a b"]).withColumnRenamed("doc_id", "item_id")).count() == 0
