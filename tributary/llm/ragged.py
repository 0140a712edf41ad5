"""Ragged text arrays: many texts of one Arrow batch as flat numpy arrays.

A batch of texts is one UTF-8 byte buffer plus offsets. Words, word hashes and
word windows are computed over the flat buffer, so a task spends its time in
numpy, not in a Python loop over words. Work is cut into blocks of bounded
bytes; one very long text forms a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The word separators of the contracts, \x20 and \x09-\x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Target bytes of text per numpy block.
BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_WORD_BYTE = np.where(SEPARATORS, np.uint64(0), _BYTE)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_COEF = np.cumprod(np.full(256, _STEP, np.uint64), dtype=np.uint64)  # word positions in a window
_SHORT = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 0x20
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n-1)`` modulo 2^64; the table grows on demand."""
    global _powers
    if n > len(_powers):
        size = max(n, 2 * len(_powers), 1024)
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with full avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(column: pa.Array) -> pa.Array:
    """The column as large_string with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array without nulls."""
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches holding about ``limit`` text bytes each, as
    ``(rows, bytes, offsets)``."""
    for batch in batches:
        col = texts_of(batch.column(batch.schema.get_field_index(text)))
        buf, offs = utf8(col)
        at = 0
        while at < len(col):
            to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(col))
            yield batch.slice(at, to - at), buf[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to


@dataclass
class Words:
    """Words of a block: byte start and length, index of the text, 64-bit hash."""
    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of the first word of each text; one entry more than texts

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def _word_piece(buf: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and polynomial hashes of the words that start in ``buf[lo:hi]``."""
    part = buf[lo:hi]
    s = starts - lo
    seg = np.diff(np.append(s, len(part)))
    body = part[s[0]:]
    pos = np.arange(len(body)) - np.repeat(s - s[0], seg)
    h = np.add.reduceat(_WORD_BYTE[body] * powers(int(seg.max()))[pos], s - s[0])
    size = np.add.reduceat((~SEPARATORS[body]).astype(np.int64), s - s[0])
    return size, h


def words(buf: np.ndarray, offs: np.ndarray, lower: bool = False, punctuation: bool = True) -> Words:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a block; a word never crosses texts.

    ``lower`` folds A-Z; without ``punctuation`` every ASCII character but
    letters and digits separates words too.
    """
    n_docs = len(offs) - 1
    if lower:
        buf = _LOWER[buf]
    if not punctuation:
        buf = _PLAIN[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64))
    sep = SEPARATORS[buf]
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = sep[:-1]
    heads = offs[:-1]
    before[heads[heads < len(buf)]] = True
    starts = np.flatnonzero(~sep & before)
    sizes, hashes = [], []
    at = 0
    while at < len(starts):  # bounded pieces, cut at word starts
        to = max(int(np.searchsorted(starts, starts[at] + BLOCK_BYTES, "right")), at + 1)
        hi = int(starts[to]) if to < len(starts) else len(buf)
        size, h = _word_piece(buf, starts[at:to], int(starts[at]), hi)
        sizes.append(size)
        hashes.append(h)
        at = to
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    h = mix64(h + size.astype(np.uint64) * _STEP)
    doc = np.searchsorted(offs, starts, "right") - 1
    first = np.searchsorted(starts, offs)
    return Words(starts, size, doc, h, first)


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word window inside one text: ``(hash, index of its first word)``."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += w.hash[j:j + n] * _COEF[j]
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1:k - 1 + n])
    return mix64(acc[at]), at


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence shorter than a window, salted by its length."""
    n = len(hashes)
    acc = np.sum(hashes * _COEF[:n], dtype=np.uint64, keepdims=True)
    return mix64(acc + _SHORT[n:n + 1])[0]
