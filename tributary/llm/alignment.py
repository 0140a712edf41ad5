"""Cross-tokenizer alignment by lockstep vectorised merging (operator 12).

A text is encoded twice: ``space + text`` by a byte-level BPE (A), the text by
a sentencepiece model that adds the space itself (B). Where the bytes of both
token sequences spell ``space + text``, offsets at which an A and a B token end
cut them into groups.

1. All texts of a block lie in flat arrays of token end offsets. One state
   vector holds an A and a B pointer per lane; a step compares the ends under
   all pointers at once, emits links and cuts where they meet, advances the
   pointer whose token ends first, and drops the lanes that are through. A text
   of more than ``LANE_BYTES`` takes several lanes: a lane owns the ends inside
   its stretch of bytes and starts at the first token that ends there, so a
   very long text takes no more steps than a short one.
2. Two tokens that end together have one's bytes as a suffix of the other's, so
   the pairs of ids that can ever be linked follow from the two vocabularies
   (``Pairs``, some 300,000). Links are kept as numbers of such pairs and
   counted corpus-wide as arrays of that fixed size: what is collected and
   broadcast is bounded by the vocabularies, not by the corpus.
3. A second pass over the written links (no texts) adds up the counts.

Defined results: null and empty texts, and texts whose tokens do not spell them
(the space piece in the text itself), have zeros and an empty digest; repeated
rows count as often as they occur; a null id is carried along; an empty table
gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged
from tributary.llm.store import written

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
# Bytes of text a lane of the state vector owns.
LANE_BYTES = 1024
# Bytes of text per block: the token arrays of a block are about ten times as large.
BLOCK_BYTES = 2 << 20
# White-space runs of this length go to the tokenizer library itself: the faster encoder's pattern nests with the run.
LONG_BLANK = re.compile(r"\s{1000}")
# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"


def _byte_symbols() -> dict[str, int]:
    """The byte each symbol of a byte-level vocabulary stands for: printable bytes stand for themselves,
    the others take the code points from 256 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTable:
    """Bytes of every id of a vocabulary, as one buffer."""

    def __init__(self, of_id: dict[int, bytes]):
        n = max(of_id) + 1
        self.of_id = of_id
        self.size = np.zeros(n, np.int64)
        for i, b in of_id.items():
            self.size[i] = len(b)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.data = np.frombuffer(b"".join(of_id.get(i, b"") for i in range(n)), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.arange(total) + np.repeat(self.start[ids] - ends + size, size)]


class EncoderA:
    """Byte-level BPE: the tokenizer library's ids, by a faster encoder of the same ranks where it can."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = _byte_symbols()
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bytes = ByteTable({i: bytes(symbols[c] for c in t) for t, i in vocab.items()})
        self.path, self._library, self._fast = path, None, None
        merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        # ids that rise with the merges are ranks
        if plain and [vocab.get(m.replace(" ", "")) for m in merged] == list(range(256, 256 + len(merged))):
            import tiktoken
            self._fast = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, special_tokens={},
                                           mergeable_ranks={b: i for i, b in self.bytes.of_id.items()})

    def library(self):
        if self._library is None:
            import os
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each task its core
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = True
        return self._library

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._fast.encode_ordinary(t) if self._fast and not LONG_BLANK.search(t)
                else self.library().encode(t, add_special_tokens=False).ids for t in texts]


class EncoderB:
    """Sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = ByteTable({
            i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pairs:
    """All pairs of an A and a B id one of which ends with the other: number, and B id, of each."""

    def __init__(self, a: ByteTable, b: ByteTable):
        self.base = len(b.size)

        def ends(one: ByteTable, other: ByteTable) -> Iterator[tuple[int, int]]:
            by: dict[bytes, list[int]] = {}
            for i, s in other.of_id.items():
                by.setdefault(s, []).append(i)
            for i, s in one.of_id.items():
                for cut in range(len(s)):
                    for j in by.get(s[cut:], ()):
                        yield i, j
        keys = {i * self.base + j for i, j in ends(a, b)} | {i * self.base + j for j, i in ends(b, a)}
        self.keys = np.array(sorted(keys), np.int64)
        self.b = self.keys % self.base

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        if not np.array_equal(self.keys[at], key):
            raise ValueError("tokens that end together must share their last bytes")
        return at


class Model:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = EncoderA(path_a), EncoderB(path_b)
        self.pairs = Pairs(self.a.bytes, self.b.bytes)


@lru_cache(maxsize=2)
def model(path_a: str, path_b: str) -> Model:
    return Model(path_a, path_b)


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, last_a: np.ndarray,
             first_b: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token pairs that end together, as indexes into both arrays, in no order.

    Lane i merges ``end_a[first_a[i]:last_a[i]]`` with ``end_b[first_b[i]:last_b[i]]``, both rising.
    """
    a, b = first_a.copy(), first_b.copy()
    live = (a < last_a) & (b < last_b)
    a, b, to_a, to_b = a[live], b[live], last_a[live], last_b[live]
    links_a, links_b = [], []
    while len(a):
        x, y = end_a[a], end_b[b]
        met = x == y
        links_a.append(a[met])
        links_b.append(b[met])
        a += x <= y
        b += y <= x
        live = (a < to_a) & (b < to_b)
        if not live.all():  # finished lanes leave the state vector
            a, b, to_a, to_b = a[live], b[live], to_a[live], to_b[live]
    none = np.zeros(0, np.int64)
    return (np.concatenate(links_a) if links_a else none), (np.concatenate(links_b) if links_b else none)


def _lanes(size: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches ``(text, from, to]`` of at most ``lane`` bytes of texts of the given sizes."""
    count = -(-size // lane)
    text = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, k * lane, np.minimum((k + 1) * lane, size[text])


def _spelled(table: ByteTable, ids: np.ndarray, cut: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts the tokens ``ids[cut[d]:cut[d+1]]`` spell: ``buf[offs[d]:offs[d+1]]``."""
    total = np.concatenate([[0], np.cumsum(table.size[ids])])[cut]
    same = np.diff(total) == np.diff(offs)
    said = table.spell(ids)
    if np.array_equal(np.diff(total), np.diff(offs)):
        wrong = np.concatenate([[0], np.cumsum(said != buf)])
        return np.diff(wrong[offs]) == 0
    for d in np.flatnonzero(same):
        same[d] = np.array_equal(said[total[d]:total[d + 1]], buf[offs[d]:offs[d + 1]])
    return same


_DIGITS = 10 ** np.arange(7, -1, -1, dtype=np.int64)


def _signatures(ids: np.ndarray, sep: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """Per text the decimal ids ``ids[cut[d]:cut[d+1]]``, each followed by its separator, but the last."""
    cells = np.empty((len(ids), len(_DIGITS) + 1), np.uint8)
    cells[:, :-1] = (ids[:, None] // _DIGITS) % 10 + ord("0")
    cells[:, -1] = sep
    keep = np.ones(cells.shape, bool)
    keep[:, :-2] = ids[:, None] >= _DIGITS[:-1]
    flat = cells[keep].tobytes()
    ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])[cut].tolist()
    return [flat[lo:max(hi - 1, lo)] for lo, hi in zip(ends[:-1], ends[1:])]


def align(m: Model, texts: list[str], lane: int = LANE_BYTES):
    """Per text ``n_a, n_b, n_groups`` and the signature, and all links ``(text, A id, B id)`` in order."""
    n = len(texts)
    spaced = [" " + t for t in texts]
    ids_a, ids_b = ([np.array(x, np.int64) for x in got] for got in (m.a.encode(spaced), m.b.encode(texts)))
    buf, offs = ragged.utf8(pa.array(spaced, pa.large_string()))
    flat_a, flat_b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (ids_a, ids_b))
    cut_a, cut_b = (np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64) for got in (ids_a, ids_b))
    good = np.array([bool(t) for t in texts], bool)
    good &= _spelled(m.a.bytes, flat_a, cut_a, buf, offs)
    good &= _spelled(m.b.bytes, flat_b, cut_b, buf, offs)

    # tokens of the texts that count, and the offset in the block where each ends
    def kept(flat, cut, table):
        size = np.where(good, np.diff(cut), 0)
        flat = flat[np.repeat(good, np.diff(cut))]
        return flat, np.concatenate([[0], np.cumsum(size)]), np.cumsum(table.size[flat])
    flat_a, cut_a, end_a = kept(flat_a, cut_a, m.a.bytes)
    flat_b, cut_b, end_b = kept(flat_b, cut_b, m.b.bytes)
    size = np.where(good, np.diff(offs), 0)
    start = np.cumsum(size) - size
    text, lo, hi = _lanes(size, lane)
    lo, hi = lo + start[text], hi + start[text]
    link_a, link_b = lockstep(end_a, end_b, np.searchsorted(end_a, lo, "right"), np.searchsorted(end_a, hi, "right"),
                              np.searchsorted(end_b, lo, "right"), np.searchsorted(end_b, hi, "right"))
    link_a.sort()  # ends rise, so the k-th A token that meets belongs to the k-th B token
    link_b.sort()

    # group of each token; A tokens of a group come before its B tokens
    group_a, group_b = np.searchsorted(link_a, np.arange(len(flat_a))), np.searchsorted(link_b, np.arange(len(flat_b)))
    place_a = np.arange(len(flat_a)) + np.concatenate([[0], link_b + 1])[group_a]
    place_b = np.arange(len(flat_b)) + (link_a + 1)[group_b]
    ids, sep = np.empty(len(flat_a) + len(flat_b), np.int64), np.full(len(flat_a) + len(flat_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = flat_a, flat_b
    sep[place_a[link_a]], sep[place_b[link_b]] = ord("|"), ord(";")
    links_of = np.searchsorted(link_a, cut_a)
    return (np.diff(cut_a), np.diff(cut_b), np.diff(links_of), _signatures(ids, sep, cut_a + cut_b), good,
            np.repeat(np.arange(n), np.diff(links_of)), flat_a[link_a], flat_b[link_b])


_ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<int>"


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the token and group counts, the digest of the groups, and its links as numbers of ``Pairs``."""
    def task(batches):
        m = model(path_a, path_b)
        for part, _, _ in ragged.blocks(batches, "text", BLOCK_BYTES):
            n_a, n_b, groups, said, good, text, a, b = align(m, ragged.texts_of(part.column(1)).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_a), pa.array(n_b), pa.array(groups),
                 pa.array([hashlib.sha256(s).hexdigest() if ok else "" for s, ok in zip(said, good)], pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(m.pairs.number(a, b), pa.int32()))],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(task, _ALIGNED))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])


def pair_counts(rows: DataFrame, n_pairs: int) -> DataFrame:
    """Corpus-wide links of each pair: ``(pair, n)``, one array a task before the shuffle."""
    def task(batches):
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            values, _ = _flat(batch.column(0))
            total += np.bincount(values, minlength=n_pairs)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "n"])
    return rows.select("links").mapInArrow(task, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Both files must lie at
    their paths on every executor."""
    rows = written(aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    pairs = model(path_a, path_b).pairs
    # at most one row per pair of the vocabularies, whatever the size of the corpus
    found = pair_counts(rows, len(pairs.keys)).toArrow()
    counts = np.zeros(len(pairs.keys), np.int64)
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    top = np.zeros(pairs.base, np.int64)
    np.maximum.at(top, pairs.b, counts)
    tables = rows.sparkSession.sparkContext.broadcast((counts, counts == top[pairs.b]))

    def task(batches):
        counts, best = tables.value
        for batch in batches:
            values, offsets = _flat(batch.column(5))
            n_best, total = (np.diff(np.concatenate([[0], np.cumsum(x[values])])[offsets]) for x in (best, counts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(np.diff(offsets)), pa.array(n_best.astype(np.int64)),
                 pa.array(total), batch.column(4)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return rows.mapInArrow(task, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                 "n_best bigint, count_sum bigint, groups_sha256 string")
