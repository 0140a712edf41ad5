"""Quality rules with suffix-array repetition (operator 6).

Per text: counts for the base rules, and the repeats found by a word suffix
array. Only suffixes whose first ``min_repeat`` words occur again in the same
text enter the array (all others have no repeat to report). They are sorted by
prefix doubling; the longest-common-prefix array of neighbours gives the LCP
intervals, i.e. the maximal repeated substrings. Their spans are united: a text
is rejected if the union covers more than ``max_covered_percent`` of its words
or one repeat is longer than ``max_longest_percent`` of them.

Every text is scanned whole, where it lies: no shuffle.

Defined results: a null text counts as no words (all counts 0, base_failed);
equal rows give equal rows; an empty table gives none; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged

# Base rules of the contract.
MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
REPEAT_WINDOW = 3
# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
# Limits of the suffix-array rule.
MIN_REPEAT = 12
MAX_COVERED_PERCENT = 30
MAX_LONGEST_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_DOC_SALT = np.uint64(0x8CB92BA72F3D8DD7)

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, n_covered_words bigint, longest_repeat bigint, "
          "n_maximal_repeats bigint")


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def _repeated(w: ragged.Words, k: int) -> np.ndarray:
    """First words of the k-word windows found again in the same text."""
    h, at = ragged.windows(w, k)
    h = ragged.mix64(h + w.doc[at].astype(np.uint64) * _DOC_SALT)
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return at[:0]
    i = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    return at[twice[i] == h]


def _covered(at: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Words under the union of spans ``[at, at + size)``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, at, 1)
    np.add.at(d, at + size, -1)
    return np.cumsum(d[:-1]) > 0


@dataclass
class SuffixArray:
    """Suffixes with a repeat: word positions in suffix order and LCP with the one before (0 at a text's first)."""
    order: np.ndarray
    lcp: np.ndarray


def suffix_array(w: ragged.Words, k: int) -> SuffixArray:
    """Suffix and LCP arrays of the repeated suffixes of all texts of a block."""
    at = _repeated(w, k)
    if not len(at):
        return SuffixArray(at, at)
    # every word of a repeat and the word after it, so that neighbours compare up to their first difference
    total = len(w.hash)
    use = np.flatnonzero(_covered(at, np.minimum(k + 1, total - at), total))
    n = len(use)
    where = np.full(total, -1, np.int64)
    where[use] = np.arange(n)
    # levels[l][i]: rank of the first 2^l words of the suffix at use[i]; equal rank, equal words of one text
    _, rank = np.unique(ragged.mix64(w.hash[use] + w.doc[use].astype(np.uint64) * _DOC_SALT), return_inverse=True)
    levels = [rank]
    while True:
        nxt = use + (1 << (len(levels) - 1))
        j = where[np.minimum(nxt, total - 1)]
        known = (nxt < total) & (j >= 0)
        second = np.where(known & (w.doc[use] == w.doc[use[j]]), rank[j], n + np.arange(n))
        key = rank * (2 * n) + second
        order = np.argsort(key, kind="stable")  # runs that are in order already cost little
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == n - 1:
            break
        levels.append(rank)
    order = at[np.argsort(rank[where[at]])]
    a, b = order[1:], order[:-1]
    lcp = np.zeros(len(a), np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        i, j = np.minimum(a + lcp, total - 1), np.minimum(b + lcp, total - 1)
        ok = (a + lcp < total) & (b + lcp < total) & (where[i] >= 0) & (where[j] >= 0)
        ok &= (w.doc[i] == w.doc[a]) & (w.doc[j] == w.doc[b]) & (levels[depth][where[i]] == levels[depth][where[j]])
        lcp += np.where(ok, 1 << depth, 0)
    return SuffixArray(order, np.concatenate([[0], np.where(lcp >= k, lcp, 0)]))


def lcp_intervals(sa: SuffixArray, w: ragged.Words) -> list[tuple[int, int, int]]:
    """Maximal repeats as ``(lcp, lo, hi)``: suffixes order[lo:hi] share lcp words, no more
    to the right for all of them, and are not all preceded by one same word."""
    out, stack = [], []  # stack of (lcp, lo)
    left = np.where((sa.order > 0) & (w.doc[sa.order - 1] == w.doc[sa.order]), w.hash[sa.order - 1], np.uint64(0))
    first = w.first[w.doc[sa.order]] == sa.order
    varies = np.concatenate([[0], np.cumsum((left[1:] != left[:-1]) | first[1:] | first[:-1])])
    for i, depth in enumerate([*sa.lcp[1:].tolist(), 0]):
        lo = i
        while stack and stack[-1][0] > depth:
            size, lo = stack.pop()
            if varies[i] > varies[lo]:
                out.append((size, lo, i + 1))
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, lo))
    return out


def _line_repeats(text: bytes) -> int:
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(b" \t\n\v\f\r"):
            seen.add(line)
    return again


def measure(buf: np.ndarray, offs: np.ndarray, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """All counts for the texts of one block."""
    w = ragged.words(buf, offs)
    n_docs = len(offs) - 1
    raw = buf.tobytes()
    at = _repeated(w, REPEAT_WINDOW)
    sa = suffix_array(w, min_repeat)
    longest = np.zeros(n_docs, np.int64)
    repeats = np.zeros(n_docs, np.int64)
    covered = np.zeros(n_docs, np.int64)
    if len(sa.order):
        # the longest repeat from each suffix on is shared with a neighbour; a repeat that is always preceded by
        # one same word lies inside the repeat that has that word too, so these spans have the union of all
        reach = np.maximum(sa.lcp, np.append(sa.lcp[1:], 0))
        covered = _sums(_covered(sa.order, reach, len(w.hash)), w.first)
        np.maximum.at(longest, w.doc[sa.order], reach)
        heads = np.array([lo for _, lo, _ in lcp_intervals(sa, w)], np.int64)
        repeats = np.bincount(w.doc[sa.order[heads]], minlength=n_docs)
    return {"n_words": w.count(), "word_chars": _sums(((buf & 0xC0) != 0x80) & ~ragged.SEPARATORS[buf], offs),
            "n_symbols": _sums(_SYMBOL[buf], offs),
            "n_dup_lines": np.array([_line_repeats(raw[a:b]) for a, b in zip(offs[:-1], offs[1:])], np.int64),
            "n_repeat_words": _sums(_covered(at, REPEAT_WINDOW, len(w.hash)), w.first),
            "n_covered_words": covered, "longest_repeat": longest, "n_maximal_repeats": repeats}


def _judged(buf: np.ndarray, offs: np.ndarray, min_repeat: int, max_covered_percent: int,
            max_longest_percent: int) -> dict[str, np.ndarray]:
    m = measure(buf, offs, min_repeat)
    n = m["n_words"]
    m["base_failed"] = (n < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_WORDS_PERCENT * n)
    m["kept"] = ~(m["base_failed"] | (100 * m["n_covered_words"] > max_covered_percent * n)
                  | (100 * m["longest_repeat"] > max_longest_percent * n))
    return m


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_repeat: int = MIN_REPEAT,
            max_covered_percent: int = MAX_COVERED_PERCENT, max_longest_percent: int = MAX_LONGEST_PERCENT) -> DataFrame:
    """Per row: the base counts, base_failed, kept, and the suffix-array measures."""
    def task(batches):
        for part, buf, offs in ragged.blocks(batches, "text"):
            m = _judged(buf, offs, min_repeat, max_covered_percent, max_longest_percent)
            names = [f.split()[0] for f in SCHEMA.split(", ")[1:]]
            yield pa.RecordBatch.from_arrays([part.column(0)] + [pa.array(m[c]) for c in names], ["doc_id", *names])
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(task, SCHEMA))


def quality_filter(docs: DataFrame, text_col: str = "text", *, min_repeat: int = MIN_REPEAT,
                   max_covered_percent: int = MAX_COVERED_PERCENT,
                   max_longest_percent: int = MAX_LONGEST_PERCENT) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    def task(batches):
        for part, buf, offs in ragged.blocks(batches, text_col):
            yield part.filter(pa.array(_judged(buf, offs, min_repeat, max_covered_percent, max_longest_percent)["kept"]))
    return docs.mapInArrow(task, docs.schema)
