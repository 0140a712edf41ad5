"""Token counts against the tokenizer library itself."""

import random

import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
spm = pytest.importorskip("sentencepiece")

from tributary.llm import tokens  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=P.path(tokens.MODEL))


def want(library, texts):
    return [len(x) for x in library.encode([t or "" for t in texts], num_threads=1)]


def test_table_equals_library(docs, library):
    rows = docs.select("doc_id", "text").collect()
    expected = {r.doc_id: (len(r.text.encode()), n, n > 4096) for r, n in zip(rows, want(library, [r.text for r in rows]))}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(docs, P.path(tokens.MODEL)).collect()}
    assert got == expected


def test_odd_texts(library):
    rng = random.Random(5)
    alphabet = "abcdefgh  \n\t\r'\"<>/▁é中😀ﬁ\x00\x0b​0123"
    texts = ["", " ", "  a  b", "<s> </s> <unk> <0x0A>", "▁▁", "a▁b", "\n\n", "x" * 5000, "ab" * 3000, " " * 900,
             "the " * 1000, "\r\r\n);\r\n", "中" * 700, "﻿a", "é"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 900))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2fff)])) for _ in range(200)) for _ in range(60)]
    m = tokens.merges(P.path(tokens.MODEL))
    assert tokens.count_block(m, pa.array(texts, pa.large_string())).tolist() == want(library, texts)


def test_edge_rows(frame):
    df = frame([None, "", "a", "a"], [1, None, 3, 3]).selectExpr("*", "1 as n_tokens", "'x' as n_bytes")
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokens.token_counts(df, P.path(tokens.MODEL)).collect())
    assert rows == [(0, 0, 0), (1, 0, 0), (3, 1, 1), (3, 1, 1)]
    assert tokens.token_counts(frame([]), P.path(tokens.MODEL)).count() == 0
