"""Token counts by rank-synchronous merging over ragged arrays (operator 10).

The model's pieces and scores are read once per worker. A text is cut into
pre-tokens at places no piece spans (before a run of spaces, around characters
no piece holds). Each distinct pre-token of a block is merged once: all of
them lie in one flat symbol array, and in every round each one merges its own
best pair (best score, then leftmost), all in one numpy pass, until no pair of
any of them is a piece. Symbols that are no piece count their bytes (byte
fallback) or one. Counts are added up per text.

A pre-token of more than ``LONG`` symbols would need as many rounds as merges;
it is merged with a heap instead, in the same order of merges.

Defined results: null and empty texts have no tokens; equal rows give equal
rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
LONG = 400
# Distinct pre-tokens a worker remembers between blocks before it starts afresh.
REMEMBER = 1 << 20

SPACE = "▁"
_BYTE = ragged.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_EMPTY, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
_NONE = np.int64(1 << 62)


class Merges:
    """Merge table of a sentencepiece BPE model: pairs of symbols, rank and result."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in ids}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that span a space inside need another pre-tokenizer")
        fallback = any(sp.is_byte(i) for i in range(sp.get_piece_size()))
        chars = sorted({c for p in pieces for c in p})
        names = chars + sorted(p for p in pieces if len(p) > 1)
        number = {p: i for i, p in enumerate(names)}
        self.stranger = len(names)  # any character no piece holds
        rank = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: -pieces[p]))}
        pairs = sorted((number[p[:i]] * (len(names) + 1) + number[p[i:]], rank[p], number[p])
                       for p in pieces if len(p) > 1 for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
        self.keys, self.ranks, self.results = (np.array(x, np.int64) for x in zip(*pairs))
        self.table = {k: (r, to) for k, r, to in pairs}
        self.of_char = np.full(0x110000, self.stranger, np.int32)
        self.of_char[[ord(c) for c in chars]] = np.arange(len(chars))
        # tokens of a symbol left over: 1 for a piece, else its bytes
        self.cost = np.array([1 if p in pieces or not fallback else len(p.encode()) for p in names] + [0], np.int64)
        self.fallback = fallback
        self.newline_apart = not any("\n" in p for p in pieces)
        self.known: dict[int, int] = {}

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * (self.stranger + 1) + right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[i] == key
        return np.where(hit, self.ranks[i], _NONE), self.results[i]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        if not words:
            return out
        sizes = np.array([len(s) for s in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = self.of_char[code].astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        odd = sym == self.stranger
        if odd.any():
            c = code[odd]
            n = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF) if self.fallback else np.ones(len(c), np.int64)
            np.add.at(out, word[odd], n)
        long = sizes > LONG
        if long.any():
            cut = np.concatenate([[0], np.cumsum(sizes)])
            for i in np.flatnonzero(long):
                out[i] += self.count_long(sym[cut[i]:cut[i + 1]].tolist())
            keep = ~long[word]
            sym, word = sym[keep], word[keep]
        while len(sym):
            rank, to = self.pair_rank(sym[:-1], sym[1:])
            rank[word[:-1] != word[1:]] = _NONE
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            # best pair of each sequence: lowest rank, then leftmost
            order = np.append(np.where(rank < _NONE, rank * len(sym) + np.arange(len(rank)), _NONE), _NONE)
            best = np.minimum.reduceat(order, heads)
            done = best == _NONE
            if done.any():
                over = np.repeat(done, np.diff(np.append(heads, len(sym))))
                np.add.at(out, word[over], self.cost[sym[over]])
            at = best[~done] % len(sym)
            keep = np.ones(len(sym), bool)
            sym[at] = to[at]
            keep[at + 1] = False
            if done.any():
                keep &= ~over
            sym, word = sym[keep], word[keep]
        return out

    def count_long(self, sym: list[int]) -> int:
        """One long pre-token, merged with a heap over a linked list."""
        n, base = len(sym), self.stranger + 1
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (hit := self.table.get(sym[i] * base + sym[j])):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j], hit[1]))
        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            if sym[i] != a or nxt[i] >= n or sym[nxt[i]] != b:
                continue
            j = nxt[i]
            sym[i], sym[j] = to, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        return int(sum(self.cost[s] for s in sym if s >= 0))


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _pre_tokens(buf: np.ndarray, offs: np.ndarray, newline_apart: bool) -> np.ndarray:
    """Byte starts of the pre-tokens; every text starts with its dummy space."""
    space = buf == 0x20
    cut = np.zeros(len(buf), bool)
    cut[1:] = space[1:] & ~space[:-1]
    if newline_apart:
        line = buf == 0x0A
        cut |= line
        cut[1:] |= line[:-1]
    heads = offs[:-1]
    cut[heads[heads < len(buf)]] = True
    return np.flatnonzero(cut)


def count_block(m: Merges, texts: pa.Array) -> np.ndarray:
    """Tokens of each text of a block."""
    texts = pc.replace_substring(texts, SPACE, " ")  # both stand for the space piece
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts,
                       pc.binary_join_element_wise(_EMPTY, texts, _SPACE))
    buf, offs = ragged.utf8(texts)
    if not len(buf):
        return np.zeros(len(texts), np.int64)
    starts = _pre_tokens(buf, offs, m.newline_apart)
    ends = np.append(starts[1:], len(buf))
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # bounded pieces
        to = max(int(np.searchsorted(starts, starts[at] + ragged.BLOCK_BYTES, "right")), at + 1)
        lo, hi = int(starts[at]), int(ends[to - 1])
        size = ends[at:to] - starts[at:to]
        pos = np.arange(hi - lo) - np.repeat(starts[at:to] - lo, size)
        hashes[at:to] = np.add.reduceat(_BYTE[buf[lo:hi]] * ragged.powers(int(size.max()))[pos], starts[at:to] - lo)
        at = to
    hashes = ragged.mix64(hashes + (ends - starts).astype(np.uint64))
    distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    keys = distinct.tolist()
    known = m.known
    new = [i for i, h in enumerate(keys) if h not in known]
    if new:
        if len(known) + len(new) > REMEMBER:
            known.clear()
            new = list(range(len(keys)))
        raw = buf.tobytes()
        words = [raw[starts[f]:ends[f]].decode().replace(" ", SPACE) for f in first[new].tolist()]
        known.update(zip([keys[i] for i in new], m.count(words).tolist()))
    per = np.array([known[h] for h in keys], np.int64)[back]
    total = np.concatenate([[0], np.cumsum(per)])
    cut = np.searchsorted(starts, offs)
    return total[cut[1:]] - total[cut[:-1]]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", *,
                 limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. The model file must lie at ``model_path`` on every executor."""
    def task(batches):
        m = merges(model_path)
        for part, _, offs in ragged.blocks(batches, "text"):
            n = count_block(m, ragged.texts_of(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(task, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"))
