"""Base counts and suffix-array repeats against plain Python."""

import random
import re
import time

import numpy as np
import pyarrow as pa

from tributary.llm import quality, ragged

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + j for p in at.values() if len(p) > 1 for i in p for j in range(3)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def windows_again(w, k):
    """First words of the k-word windows that occur more than once."""
    at = {}
    for i in range(len(w) - k + 1):
        at.setdefault(tuple(w[i:i + k]), []).append(i)
    return sorted(i for p in at.values() if len(p) > 1 for i in p)


def repeats(text, k):
    """Words covered by repeats of k words or more, and the longest repeat: a repeat of n words is a repeat of
    every window in it, so longer and longer windows are tried while one occurs again."""
    w = WORD.findall(text or "")
    again = windows_again(w, k)
    covered = {i + j for i in again for j in range(k)}
    if not again:
        return 0, 0
    run = best = 1  # windows in a row bound the longest repeat
    for a, b in zip(again, again[1:]):
        run = run + 1 if b == a + 1 else 1
        best = max(best, run)
    lo, hi = k, k + best - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if windows_again(w, mid) else (lo, mid - 1)
    return len(covered), lo


def all_pairs(text, k):
    """The same by comparing every pair of places."""
    w = WORD.findall(text or "")
    covered, longest = set(), 0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            n = 0
            while j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= k:
                covered |= {*range(i, i + n), *range(j, j + n)}
                longest = max(longest, n)
    return len(covered), longest


def test_table_equals_plain_counts(docs):
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in quality.quality(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(rows[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_repeats_equal_brute_force():
    rng = random.Random(2)
    texts = ["", "a", "a " * 40, "a b c d e " * 9 + "x"]
    for _ in range(60):
        block = [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 30))]
        out = []
        for _ in range(rng.randrange(1, 5)):
            out += [rng.choice("abcdefghijklmnopq") for _ in range(rng.randrange(0, 25))] + block[:rng.randrange(1, 30)]
        texts.append(" ".join(out))
    buf, offs = ragged.utf8(pa.array(texts, pa.large_string()))
    for k in (2, 5):
        m = quality.measure(buf, offs, k)
        assert list(zip(m["n_covered_words"].tolist(), m["longest_repeat"].tolist())) == [all_pairs(t, k) for t in texts] \
            == [repeats(t, k) for t in texts]


def test_repetitive_texts_cost_no_more():
    """A million equal words, and periods: linear in the text, with the exact results."""
    buf, offs = ragged.utf8(pa.array(["la " * 1_000_000, "a b c " * 50_000, "x"], pa.large_string()))
    began = time.perf_counter()
    m = quality.measure(buf, offs)
    assert time.perf_counter() - began < 60  # alone on a core: under 10 s
    assert m["n_covered_words"].tolist() == [1_000_000, 150_000, 0]
    assert m["longest_repeat"].tolist() == [999_999, 149_997, 0]
    small = quality.measure(*ragged.utf8(pa.array(["la " * 60, "a b c " * 20], pa.large_string())))
    assert list(zip(small["n_covered_words"].tolist(), small["longest_repeat"].tolist())) == [repeats("la " * 60, 12), repeats("a b c " * 20, 12)]


def test_intervals_are_maximal_repeats():
    text = "x a b c y a b c z a b q"
    buf, offs = ragged.utf8(pa.array([text], pa.large_string()))
    w = ragged.words(buf, offs)
    sa = quality.suffix_array(w, 2)
    found = {(size, tuple(sorted(sa.order[lo:hi].tolist()))) for size, lo, hi in quality.lcp_intervals(sa, w)}
    assert found == {(3, (1, 5)), (2, (1, 5, 9))}


def test_verdict_and_edge_rows(frame):
    clean = " ".join(f"w{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(60))
    copied = clean + " " + passage + " mid " + passage + " end " + passage
    rows = {r.doc_id: r for r in quality.quality(
        frame([clean, copied, None, "", clean], [1, 2, 3, 4, 1]).selectExpr("*", "9 as kept", "1 as n_words")).collect()}
    assert rows[1].kept and rows[1].n_covered_words == 0
    assert rows[2].longest_repeat == 60 and rows[2].n_covered_words == 180 and not rows[2].kept
    assert rows[3].base_failed and rows[3].n_words == 0 and not rows[4].kept
    assert quality.quality(frame([])).count() == 0
    assert np.array_equal(ragged.words(*ragged.utf8(pa.array([""], pa.large_string()))).first, [0, 0])
