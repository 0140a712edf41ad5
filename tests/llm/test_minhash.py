"""Near-duplicates against all pairs compared by brute force."""

import random
import re
from itertools import combinations

import pytest

from tributary.llm.minhash import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)], d == low[find(i)]) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_table_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize("small_group", [1, 32])
def test_large_group_of_near_copies(frame, small_group):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(220)]
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randrange(0, 7)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(t))
    texts += [" ".join(f"u{rng.randrange(400)}" for _ in range(200)) for _ in range(10)] + [texts[0]] * 5
    rng.shuffle(texts)
    df = frame(texts)
    assert got(near_duplicates(df, small_group=small_group)) == brute(list(enumerate(texts)))


def test_edge_rows(frame, spark):
    texts = [None, "", " \t\n", "one two", "ONE  two", "one two three", "É a b c d", "é a b c d", "x" * 300000]
    df = frame(texts + ["one two"], list(range(9)) + [3])
    out = got(near_duplicates(df))
    assert out == brute(list(zip(list(range(9)) + [3], texts + ["one two"])))
    extra = frame(["a b c d e f", "a b c d e f"], [7, None]).selectExpr(
        "doc_id", "text", "1 as n_shingles", "'q' as component_id", "null as fp", "2 as class_id")
    rows = {r.doc_id: r for r in near_duplicates(extra).collect()}
    assert rows[None].component_id == 7 and not rows[None].kept and rows[7].kept
    assert near_duplicates(frame([])).count() == 0
