"""Benchmark decontamination by greedy string tiling (operator 5).

Words are compared lower-cased and without punctuation. Shared seeds (windows
of ``MIN_MATCH`` words, compared by running hashes) join texts to benchmark
items; a pair whose distinct seeds could not cover enough of the item is ruled
out before any match is formed. For each pair left the longest non-overlapping
matches are marked again and again until none of ``MIN_MATCH`` words is left. A text is
contaminated by an item if its tiles cover ``MIN_COVERAGE_PERCENT`` of the
item's words, in whatever order they come, so reordered passages count.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words (a stated
query set); every text is held against every block, and only a block, never
the corpus, is on the driver. Documents are never shuffled.

Defined results: null and empty texts and items match nothing; an item of
fewer than ``MIN_MATCH`` words is one seed by itself; repeated rows give
repeated results; rows with a null id are carried with it; other columns are
not read.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged

MIN_MATCH = 5
MIN_COVERAGE_PERCENT = 50
# Words of benchmark text per block; a block and its seeds are about 40 bytes a word.
BLOCK_WORDS = 1_000_000

# Postings of seeds looked at together.
PORTION = 1 << 21

SCHEMA = ("doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, coverage_percent bigint, "
          "n_tiles bigint, longest_tile bigint, doc_words bigint")


def tiles(runs: list[tuple[int, int, int]], item_words: int, text_words: int, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from maximal matches ``(start in item, start in text, size)``.

    Returns tiles, none overlapping another on either side: the longest match first (then the first in item
    and text); a match that is partly marked by then goes on as its free stretches.
    """
    heap = [(-n, a, b) for a, b, n in runs]
    heapq.heapify(heap)
    item, text = np.zeros(item_words, bool), np.zeros(text_words, bool)
    free, out = item_words, []
    while heap and free >= k:
        n, a, b = heapq.heappop(heap)
        n = -n
        marked = item[a:a + n] | text[b:b + n]
        if not marked.any():
            item[a:a + n] = text[b:b + n] = True
            free -= n
            out.append((a, b, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[1], marked.view(np.int8), [1]])))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i >= k:
                heapq.heappush(heap, (i - j, a + i, b + i))
    return out


def _prefix(words: np.ndarray) -> np.ndarray:
    """Sums ``H`` so that ``(H[i+n] - H[i]) * base^j == (G[j+n] - G[j]) * base^i`` for n equal words."""
    p = ragged.powers(len(words) + 1)
    return np.concatenate([[np.uint64(0)], np.cumsum(ragged.mix64(words) * p[:len(words)], dtype=np.uint64)])


def maximal_matches(item: np.ndarray, text: np.ndarray, item_seeds: np.ndarray, text_seeds: np.ndarray,
                    at: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """All matches of k words or more that cannot be extended: ``(start in item, start in text, size)``.

    ``item`` and ``text`` are word hashes, ``item_seeds`` the window hashes of the item, ``text_seeds`` those of
    the text at ``at``. Only windows whose preceding words differ are paired, so a text and an item that repeat
    one phrase over and over give a match per start of a run, not one per pair of places.
    """
    none = np.uint64(0)
    before_item = np.concatenate([[none], ragged.mix64(item[:len(item_seeds) - 1]) | np.uint64(1)])
    before_text = np.where(at > 0, ragged.mix64(text[np.maximum(at, 1) - 1]) | np.uint64(1), none)
    order = np.lexsort((before_text, text_seeds))
    seeds, before, at = text_seeds[order], before_text[order], at[order]
    # one number for a seed and the word before it
    both, item_both = ragged.mix64(seeds) + before, ragged.mix64(item_seeds) + before_item
    lo, hi = np.searchsorted(seeds, item_seeds), np.searchsorted(seeds, item_seeds, "right")
    some = np.flatnonzero(hi > lo)
    starts, heads = [], []
    for a, x, y in zip(some.tolist(), lo[some].tolist(), hi[some].tolist()):
        if before_item[a] == none:  # nothing before it in the item: every place in the text is a start
            starts.append(at[x:y])
        else:
            same = both[x:y] == item_both[a]
            if same.all():
                continue
            starts.append(at[x:y][~same])
        heads.append(np.full(len(starts[-1]), a))
    if not starts:
        return []
    a, b = np.concatenate(heads), np.concatenate(starts)
    room = np.minimum(len(item) - a, len(text) - b)
    h, g, p = _prefix(item), _prefix(text), ragged.powers(max(len(item), len(text)) + 1)
    size = np.full(len(a), k, np.int64)
    step = 1 << max(int(room.max()).bit_length() - 1, 0)
    while step:
        ok = size + step <= room
        i, j, n = a[ok], b[ok], size[ok] + step
        ok[ok] = (h[i + n] - h[i]) * p[j] == (g[j + n] - g[j]) * p[i]
        size += np.where(ok, step, 0)
        step >>= 1
    return list(zip(a.tolist(), b.tolist(), size.tolist()))


class Seeds:
    """Seed windows of a benchmark block, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str], k: int):
        buf, offs = ragged.utf8(ragged.texts_of(pa.array(texts, pa.large_string())))
        w = ragged.words(buf, offs, lower=True, punctuation=False)
        h, at = ragged.windows(w, k)
        count = w.count()
        # an item of c < k words is one window of c words
        self.short = []
        for c in sorted(set(count[(count > 0) & (count < k)].tolist())):
            hs, first = ragged.windows(w, c)
            own = np.flatnonzero(count[w.doc[first]] == c)
            by = np.argsort(hs[own], kind="stable")
            self.short.append((c, hs[own][by], w.doc[first][own][by]))
        # items as they stand: word hashes and window hashes, by item
        self.word, self.first = w.hash, w.first
        self.window, self.first_window = h, np.searchsorted(at, w.first)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.at = h[order], w.doc[at][order], (at - w.first[w.doc[at]])[order]
        self.ids, self.words, self.k = ids, count, k
        self.distinct = np.unique(self.hash)

    def hopeful(self, doc: np.ndarray, h: np.ndarray, least_percent: int):
        """Pairs ``(text, item)`` whose shared seeds could cover enough of the item.

        ``(doc, h)`` are the distinct seeds of each text, sorted. The seeds' windows in the item, united, bound
        what tiles can cover, so pairs are ruled out exactly and before any place in a text is looked at. Texts
        are taken in portions of bounded postings.
        """
        lo, hi = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, "right")
        load = np.concatenate([[0], np.cumsum(hi - lo)])
        heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        ends = np.append(heads[1:], len(doc))
        t = 0
        while t < len(heads):
            u = max(int(np.searchsorted(load[ends], load[heads[t]] + PORTION, "right")), t + 1)
            x, y = heads[t], ends[u - 1]
            n = hi[x:y] - lo[x:y]
            seed = np.repeat(lo[x:y] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            d, item, at = np.repeat(doc[x:y], n), self.item[seed], self.at[seed]
            order = np.lexsort((at, item, d))
            d, item, at = d[order], item[order], at[order]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (item[1:] != item[:-1])])
            reach = np.append(np.where(new[1:], self.k, np.minimum(at[1:] - at[:-1], self.k)), self.k)
            first = np.flatnonzero(new)
            bound = np.add.reduceat(reach, first)
            good = first[100 * bound >= least_percent * self.words[item[first]]]
            yield from zip(d[good].tolist(), item[good].tolist())
            t = u

    def matches(self, w: ragged.Words, least_percent: int):
        """``(text, item, covered, tiles, longest)`` of the pairs that reach the coverage."""
        h, at = ragged.windows(w, self.k)
        if len(self.distinct) and len(h):
            i = np.minimum(np.searchsorted(self.distinct, h), len(self.distinct) - 1)
            hit = np.flatnonzero(self.distinct[i] == h)
            h, at = h[hit], at[hit]
            doc = w.doc[at]
            if len(doc):
                order = np.lexsort((h, doc))
                sd, sh = doc[order], h[order]
                once = np.concatenate([[True], (sd[1:] != sd[:-1]) | (sh[1:] != sh[:-1])])
                for d, item in self.hopeful(sd[once], sh[once], least_percent):
                    x, y = np.searchsorted(doc, d), np.searchsorted(doc, d, "right")
                    text = w.hash[w.first[d]:w.first[d + 1]]
                    words = self.word[self.first[item]:self.first[item + 1]]
                    runs = maximal_matches(words, text, self.window[self.first_window[item]:self.first_window[item + 1]],
                                           h[x:y], at[x:y] - w.first[d], self.k)
                    found = tiles(runs, len(words), len(text), self.k)
                    covered = sum(n for _, _, n in found)
                    if 100 * covered >= least_percent * len(words):
                        yield d, item, covered, len(found), max(n for _, _, n in found)
        for c, short, items in self.short:
            h, at = ragged.windows(w, c)
            i = np.minimum(np.searchsorted(short, h), len(short) - 1)
            hit = np.flatnonzero(short[i] == h)
            for d, x in sorted(set(zip(w.doc[at[hit]].tolist(), h[hit].tolist()))):
                for item in items[np.searchsorted(short, np.uint64(x)):np.searchsorted(short, np.uint64(x), "right")].tolist():
                    yield d, item, c, 1, c


def _seed_blocks(benchmark: DataFrame, item_col: str, text_col: str, min_match: int, block_words: int):
    """Broadcast seeds of the benchmark, block by block; a block has a bounded number of words."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    # half the bytes bound the words of a text
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    n_blocks = int(size // block_words) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for b in range(n_blocks):
        rows = items.where(block == b).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(
            Seeds([r.item_id for r in rows], [r.text for r in rows], min_match))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", *, min_match: int = MIN_MATCH,
                 min_coverage_percent: int = MIN_COVERAGE_PERCENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per text and item it is contaminated by."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    results = []
    for seeds in _seed_blocks(benchmark, item_col, item_text_col, min_match, block_words):
        def task(batches, seeds=seeds):
            s = seeds.value
            for part, buf, offs in ragged.blocks(batches, "text"):
                w = ragged.words(buf, offs, lower=True, punctuation=False)
                ids, count = part.column(0).to_pylist(), w.count()
                out = [(ids[d], s.ids[i], int(s.words[i]), c, 100 * c // int(s.words[i]), n, longest, int(count[d]))
                       for d, i, c, n, longest in s.matches(w, min_coverage_percent)]
                cols = list(zip(*out)) or [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 [f.split()[0] for f in SCHEMA.split(", ")])
        results.append(docs.mapInArrow(task, SCHEMA))
    return reduce(DataFrame.union, results)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", *, min_match: int = MIN_MATCH,
                      min_coverage_percent: int = MIN_COVERAGE_PERCENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    for seeds in _seed_blocks(benchmark, item_col, item_text_col, min_match, block_words):
        def task(batches, seeds=seeds):
            for part, buf, offs in ragged.blocks(batches, text_col):
                keep = np.ones(part.num_rows, bool)
                w = ragged.words(buf, offs, lower=True, punctuation=False)
                keep[[d for d, *_ in seeds.value.matches(w, min_coverage_percent)]] = False
                yield part.filter(pa.array(keep))
        docs = docs.mapInArrow(task, docs.schema)
    return docs
