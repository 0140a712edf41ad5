"""Alignment of two tokenizers against plain sets of token ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
spm = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from tributary.llm import alignment as al  # noqa: E402

A, B = P.path(al.TOKENIZER_A), P.path(al.TOKENIZER_B)


@pytest.fixture(scope="module")
def library():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, spm.SentencePieceProcessor(model_file=B)


def plain(library, texts):
    """Rows of the contract by sets of end offsets."""
    a, b = library
    bytes_a, bytes_b = al.EncoderA(A).bytes.of_id, al.EncoderB(B).bytes.of_id
    rows, counts = [], Counter()
    for t in texts:
        ia = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ib = b.encode(t or "")
        full = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a[i] for i in ia) != full or b"".join(bytes_b[i] for i in ib) != full:
            rows.append(None)
            continue
        ends = []
        for ids, table in ((ia, bytes_a), (ib, bytes_b)):
            at, out = 0, {}
            for k, i in enumerate(ids):
                at += len(table[i])
                out[at] = k
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ia[ends[0][c]], ib[ends[1][c]]) for c in cuts]
        groups, x, y = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, ia[x:ends[0][c] + 1])) + "|" + ",".join(map(str, ib[y:ends[1][c] + 1])))
            x, y = ends[0][c] + 1, ends[1][c] + 1
        rows.append((len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(links)
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (r[0], r[1], r[2], len(r[3]), sum(counts[p] == top[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4])
            for r in rows]


def got(df):
    return sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_table_equals_plain_sets(docs, library):
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain(library, [r.text for r in rows])))
    assert got(al.alignment(docs, A, B)) == want


def test_odd_texts(frame, library):
    rng = random.Random(9)
    texts = [None, "", " ", "a▁b", "▁", "<|endoftext|> <s> </s> <0x41>", "<unk>", "a\x00b", "naïve  ﬁ 中文 😀", "x" * 30000,
             "ab" * 9000, " " * 5000 + "end", "\t \n" * 700, "the " * 4000, "﻿ a", "é"]
    texts += ["".join(chr(rng.choice([rng.randrange(0, 128), rng.randrange(0, 0x300), rng.randrange(0x2000, 0x3100), 32,
                                      0x2581, 0x1F600])) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    want = sorted((i, *w) for i, w in enumerate(plain(library, texts)))
    assert got(al.alignment(frame(texts), A, B)) == want


@pytest.mark.parametrize("lane", [1, 7, 1 << 20])
def test_lanes_change_nothing(lane):
    m = al.model(A, B)
    texts = ["", "one", "internationalisation of 中文 texts, " * 40, "a▁b", "x" * 999]
    want, have = al.align(m, texts), al.align(m, texts, lane)
    for w, h in zip(want, have):
        assert np.array_equal(np.array(w), np.array(h))


def test_a_long_text_takes_few_steps():
    """A lane owns a stretch of bytes, so steps follow the stretch and not the text."""
    end_a, end_b = np.arange(2, 400002, 2), np.arange(3, 400002, 3)
    lo = np.arange(0, 400000, 1000)
    cut = [np.searchsorted(e, x, "right") for e in (end_a, end_b) for x in (lo, lo + 1000)]
    a, b = al.lockstep(end_a, end_b, *cut)
    assert np.array_equal(np.sort(end_a[a]), np.arange(6, 400001, 6)) and np.array_equal(end_a[a], end_b[b])


def test_edge_rows(frame, spark):
    df = frame(["a b", "a b", None], [3, 3, None]).selectExpr("*", "1 as n_a", "'q' as links", "0 as pair")
    rows = sorted(((r.doc_id or 0), r.n_a, r.n_links, r.count_sum) for r in al.alignment(df, A, B).collect())
    assert rows == [(0, 0, 0, 0), (3, 2, 2, 4), (3, 2, 2, 4)]
    assert al.alignment(frame([]), A, B).count() == 0
