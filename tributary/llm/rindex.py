"""Run-length index of one bounded block of strings: BWT runs with sampled run ends.

The suffix array of the block gives its Burrows-Wheeler transform, kept as
runs. At each run border two text positions are sampled: the suffix at a run's
head with its neighbour above, and the suffix at a run's tail with its
neighbour below. Inside a run the matching statistics only fall by one per
position (equal BWT symbols map neighbours to neighbours), so the samples with
their match lengths give the longest match of every position: a sample
``(at, size)`` says that the text from ``at`` on repeats elsewhere for ``size``
symbols, and the positions after it, up to the next sample, repeat to the same
end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tributary.llm import ragged


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only tied suffixes are sorted again. The last symbol must be unique."""
    n = len(t)
    key = t.astype(np.int64) << 42
    key[:-1] |= t[1:].astype(np.int64) << 21
    key[:-2] |= t[2:].astype(np.int64)
    order = np.argsort(key)
    key = key[order]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    tied = slots
    step = 3
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new, tied, 0))  # a rank is the first slot of its group
        rank[order[tied]] = head
        alone = new & np.concatenate([new[1:], [True]])
        tied = tied[~alone]
        if not len(tied):
            return order
        at = order[tied]
        key = rank[at] * (n + 1) + rank[np.minimum(at + step, n - 1)]
        by = np.argsort(key)
        order[tied] = at[by]
        key = key[by]
        step *= 2


@dataclass
class RunIndex:
    """Run-compressed BWT of ``text`` with the samples at run heads and tails."""
    text: np.ndarray
    symbols: np.ndarray      # symbol of each run
    lengths: np.ndarray      # length of each run
    head: np.ndarray         # text position of the suffix at each run's first row, from the second run on
    above: np.ndarray        # text position of the suffix in the row above it
    tail: np.ndarray         # text position of the suffix at each run's last row, but for the last run
    below: np.ndarray        # text position of the suffix in the row below it

    @classmethod
    def build(cls, text: np.ndarray) -> RunIndex:
        sa = suffix_array(text)
        bwt = text[sa - 1]
        border = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        starts = np.concatenate([[0], border])
        return cls(text, bwt[starts], np.diff(np.append(starts, len(bwt))),
                   sa[border], sa[border - 1], sa[border - 1], sa[border])

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Samples ``(at, size)`` whose match elsewhere has ``least`` symbols or more."""
        n = len(self.text)
        pw = ragged.powers(n + 1)
        values = ragged.mix64(self.text.astype(np.uint64) + np.uint64(1))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(values * pw[:n], dtype=np.uint64)])

        def equal(i, j, size):
            lo, hi = np.minimum(i, j), np.maximum(i, j)
            return (prefix[lo + size] - prefix[lo]) * pw[hi - lo] == prefix[hi + size] - prefix[hi]
        at = np.concatenate([self.head, self.tail])
        other = np.concatenate([self.above, self.below])
        room = n - np.maximum(at, other)
        fits = room >= least
        at, other, room = at[fits], other[fits], room[fits]
        hit = equal(at, other, least)
        at, other, room = at[hit], other[hit], room[hit]
        size = np.full(len(at), least, np.int64)
        bit = 1 << max(int(room.max(initial=1)).bit_length() - 1, 0)
        while bit:
            ok = size + bit <= room
            ok[ok] = equal(at[ok] + size[ok], other[ok] + size[ok], bit)
            size += np.where(ok, bit, 0)
            bit >>= 1
        return at, size


def repeated_spans(strings: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """Spans ``(string, start, end)`` covered by a substring of ``least`` bytes that also starts
    at another place of any of the strings; spans of one string may overlap."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1)
    text = np.empty(int(ends[-1]), np.int64)
    body = np.ones(len(text), bool)
    body[ends - 1] = False
    text[body] = np.frombuffer(b"".join(strings), np.uint8)
    text[ends - 1] = 256 + np.arange(len(strings))  # a separator of its own ends each string
    at, size = RunIndex.build(text).long_matches(least)
    which = np.searchsorted(ends, at, "right")
    start = at - (ends - sizes - 1)[which]
    return list(zip(which.tolist(), start.tolist(), (start + size).tolist()))
