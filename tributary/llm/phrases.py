"""Phrase collocation mining by stripes (operator 11).

A stripe is an associative counter: prefix -> {continuation: occurrences}. The
empty prefix's stripe counts single words. The stripe of a pair of words counts
what follows it, up to the longest phrase: each occurrence of the pair is in it
once, so the stripe holds the frequencies of all phrases that begin with the
pair. Tasks fill stripes over blocks of text and stripes of one prefix are merged
elementwise.

1. What can be frequent is found first, by 64-bit hashes only: words, then
   pairs of such words. A phrase of ``least`` occurrences consists of such
   pairs, so none is lost. Tasks know them by bitmaps of fixed size (``BITS``):
   what is collected and broadcast is bounded, and a false hit only counts a
   phrase in vain.
2. Stripes with their words, for what is left. A continuation ends where a pair
   is not frequent. Only these counts decide, so results are exact at any size
   of the bitmaps.
3. A task hands on the stripes of one language in at most ``GROUPS`` rows, by a
   hash of their prefix; equal groups meet, and the phrases are told apart after
   their stripes are merged. Shuffled rows follow the hand-overs, not the
   phrases in them. What a group counts beyond ``MERGE_ENTRIES`` is handed on
   unfinished and summed by Spark.
4. Every cut of a candidate looks up both parts; the lowest score stays. The
   products are DECIMAL(38, 0): exact while 1000 * a * n is under 10^38.
5. A phrase lies inside a longer candidate of (almost) its frequency only if a
   candidate one word longer has it too, since frequencies fall with length:
   one maximum over both ends of the next longer phrases decides.
6. The first ``top`` of a language come from the first ``top`` of each of its
   salted parts, so no task sorts a whole language.

Defined results: a null text is empty; a null lang is ``und`` (together with
rows whose lang is ``und``); ids are not read; repeated rows count as often as
they occur; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm import ragged
from tributary.llm.store import written

LEAST = 100
TOP = 2000
LONGEST = 5
UNKNOWN = "und"
# Bits of each bitmap (a power of two), 8 MB: fixed, so broadcasts are too.
BITS = 1 << 26
# Bytes of text whose stripes a task fills before it hands them on.
BLOCK_BYTES = 1 << 20
# Entries a task sums before it hands them on.
MERGE_ENTRIES = 1 << 20
# Entries of whole groups whose phrases are told apart at once, at least.
FLUSH_ENTRIES = 1 << 17
# Groups of the prefixes of a language (a power of two); all stripes of a group meet in one task.
GROUPS = 1 << 11
# Parts of a language whose first phrases are found apart, at most.
PARTS = 256

# A-Z folded, tabs as blanks, and the characters that end a piece as \x0A.
_FOLD = ragged._LOWER.copy()
_FOLD[0x09] = 0x20
_FOLD[[ord(c) for c in ".,;:!?\x0A\x0B\x0C\x0D"]] = 0x0A

# floor(1000 * a * n / (l * r)) over DECIMAL(38, 0)
SCORE = ("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) "
         "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")

_STRIPES = "lang string, part int, phrases array<string>, counts array<bigint>"
_COUNTED = "lang string, k int, phrase string, n bigint"


class Block:
    """Words of a block of texts with their pieces, salted hashes and a compact spelling."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, salt: np.ndarray):
        buf = _FOLD[buf]
        w = ragged.words(buf, offs)
        self.n = len(w.hash)
        lines = np.cumsum(buf == 0x0A)
        line = lines[w.start] if self.n else w.start
        new = np.ones(self.n, bool)
        new[1:] = (w.doc[1:] != w.doc[:-1]) | (line[1:] != line[:-1])
        self.doc, self.salt = w.doc, salt
        hashes = ragged.mix64(w.hash ^ salt[w.doc])
        # words of one piece, for windows that never cross pieces
        self.words = ragged.Words(w.start, w.size, np.cumsum(new), hashes, w.first)
        # every word followed by one blank
        self.at = np.concatenate([[0], np.cumsum(w.size + 1)])
        self.spelled = np.full(int(self.at[-1]), 0x20, np.uint8)
        if self.n:
            body = buf[~ragged.SEPARATORS[buf]]
            self.spelled[np.arange(len(body)) + np.repeat(np.arange(self.n), w.size)] = body

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.words.hash, np.arange(self.n)) if k == 1 else ragged.windows(self.words, k)

    def phrases(self, first: np.ndarray, k: int) -> pa.Array:
        """The k words from each of the given ones on, joined by blanks."""
        lo, hi = self.at[first], self.at[first + k] - 1 if k else self.at[first]
        size = hi - lo
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.spelled[np.arange(total) + np.repeat(lo - ends + size, size)]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def _hit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _blocks(batches):
    """Blocks of a partition with the language of each of their texts."""
    for part, buf, offs in ragged.blocks(batches, "text", BLOCK_BYTES):
        langs = part.column(1).cast(pa.string())
        names = langs.dictionary_encode()
        of = np.array([_salt(x) for x in names.dictionary.to_pylist()], np.uint64)
        block = Block(buf, offs, of[names.indices.to_numpy(zero_copy_only=False)])
        if block.n:
            yield block, langs


def _known(block: Block, bitmaps: list) -> list[np.ndarray]:
    """Per level k from 1 on: which words start k words all of whose parts the bitmaps of words, pairs ... know."""
    levels = []
    for k, bitmap in enumerate(bitmaps, 1):
        h, at = block.windows(k)
        if levels:
            some = levels[-1][at] & levels[-1][at + 1]
            h, at = h[some], at[some]
        known = np.zeros(block.n, bool)
        known[at[_hit(bitmap.value, h)]] = True
        levels.append(known)
    return levels


def _possible(block: Block, levels: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, first word)`` of the phrases of k words all of whose parts are known."""
    h, at = block.windows(k)
    if levels:
        step = min(k, len(levels))
        some = np.logical_and.reduce([levels[step - 1][at + j] for j in range(k - step + 1)])
        h, at = h[some], at[some]
    return h, at


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h)
    h, n = h[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[heads], np.add.reduceat(n, heads)


def _frequent(docs: DataFrame, k: int, bitmaps: list, least: int, bits: int):
    """Broadcast bitmap of the hashes of all phrases of k words with ``least`` occurrences or more."""
    def task(batches):
        parts, size = [], 0

        def batch(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])
        for block, _ in _blocks(batches):
            h, _ = _possible(block, _known(block, bitmaps), k)
            if len(h):
                parts.append(np.unique(h, return_counts=True))
                size += len(parts[-1][0])
            if size > MERGE_ENTRIES:  # summed in the task as long as that saves entries
                parts = [_merge(parts)]
                size = len(parts[0][0])
                if size > MERGE_ENTRIES // 2:
                    yield batch(*parts[0])
                    parts, size = [], 0
        if parts:
            yield batch(*_merge(parts))
    counts = docs.mapInArrow(task, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = (counts.select((F.col("h").bitwiseAND(F.lit(bits - 1)) + 1).alias("bit"))
                  .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
                  .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))).toArrow()
    out = np.zeros(bits // 8, np.uint8)  # 4,096 bytes of it a row
    for bucket, piece in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(piece, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(out)


def _sizes(levels: list[np.ndarray], longest: int) -> np.ndarray:
    """Per word: words of the longest phrase from it on, up to ``longest``, whose words and pairs are known."""
    size = levels[0].astype(np.int64)
    pairs = alive = levels[1]
    for j in range(1, longest):
        size += alive
        alive = alive & np.concatenate([pairs[j:], np.zeros(min(j, len(pairs)), bool)])
    return size


class Stripes:
    """Stripes a task fills: entries by phrase hash, with their words."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, block: Block, langs: pa.Array, h: np.ndarray, at: np.ndarray, k: int) -> None:
        """The block's phrases of k words with hashes ``h`` and first words ``at``."""
        h, first, n = np.unique(h, return_index=True, return_counts=True)
        at = at[first]
        prefix, starts = block.windows(min(k, 2))
        key = prefix[np.searchsorted(starts, at)]
        self._put(h, key, n, langs.take(pa.array(block.doc[at])), block.phrases(at, k))

    def add_totals(self, block: Block, langs: pa.Array) -> None:
        """All words of each language, as a null phrase."""
        salts, first, of = np.unique(block.salt, return_index=True, return_inverse=True)
        n = np.bincount(of[block.doc], minlength=len(salts))
        h = ragged.mix64(salts + np.uint64(1))
        self._put(h, h, n, langs.take(pa.array(first)), pa.nulls(len(salts), pa.string()))

    def _put(self, h, key, n, lang, phrase) -> None:
        if len(h):
            self.parts.append((h, key, n, lang, phrase))
            self.size += len(h)

    def merge(self) -> None:
        """Sum what has been added elementwise."""
        columns, self.parts = [list(x) for x in zip(*self.parts)], []  # one after the other, to hold little at once
        h, first, of = np.unique(np.concatenate(columns.pop(0)), return_index=True, return_inverse=True)
        key = np.concatenate(columns.pop(0))[first]
        n = np.bincount(of, np.concatenate(columns.pop(0))).astype(np.int64)  # exact: a task has fewer than 2^53 words
        words = [pa.concat_arrays(columns.pop(0)).take(pa.array(first)) for _ in range(2)]
        self.parts = [(h, key, n, *words)]
        self.size = len(h)

    def take(self) -> pa.RecordBatch:
        """One row per language and group of prefixes; empties the task's stripes."""
        self.merge()
        (_, key, n, lang, phrase), self.parts, self.size = self.parts[0], [], 0
        part = (key & np.uint64(GROUPS - 1)).astype(np.int32)
        of = lang.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((key, part, of))
        part, of = part[order], of[order]
        heads = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (of[1:] != of[:-1])]))
        offsets, at = pa.array(np.append(heads, len(part)), pa.int32()), pa.array(order)
        return pa.RecordBatch.from_arrays(
            [lang.take(pa.array(order[heads])), pa.array(part[heads]), pa.ListArray.from_arrays(offsets, phrase.take(at)),
             pa.ListArray.from_arrays(offsets, pa.array(n[order]))], ["lang", "part", "phrases", "counts"])


def _stripes(docs: DataFrame, longest: int, bitmaps: list) -> DataFrame:
    """Stripes of all phrases that can be frequent, merged per task; a null phrase counts all words."""
    def task(batches):
        own = Stripes()
        for block, langs in _blocks(batches):
            levels = _known(block, bitmaps)
            size = _sizes(levels, longest)
            own.add(block, langs, *_possible(block, levels, 1), 1)
            for k in range(2, longest + 1):
                h, at = block.windows(k)
                whole = size[at] == k
                own.add(block, langs, h[whole], at[whole], k)
            own.add_totals(block, langs)
            if own.size > MERGE_ENTRIES:
                own.merge()
                if own.size > MERGE_ENTRIES // 2:
                    yield own.take()
        if own.parts:
            yield own.take()
        pa.default_memory_pool().release_unused()  # workers are used again
    return docs.mapInArrow(task, _STRIPES)


def _summed(entries: pa.Table) -> pa.Table:
    """One row per lang and phrase."""
    out = entries.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return out.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])


def _shorter(entries: pa.Table) -> pa.Table:
    """Entries of two words or more without their last word."""
    buf, offs = ragged.utf8(ragged.texts_of(entries["phrase"]))
    blanks = np.flatnonzero(buf == 0x20)
    lo, size = offs[:-1], blanks[np.searchsorted(blanks, offs[1:]) - 1] - offs[:-1]
    ends = np.cumsum(size)
    data = buf[np.arange(size.sum()) + np.repeat(lo - ends + size, size)]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    phrase = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data))
    return entries.set_column(1, "phrase", phrase.cast(pa.string()))


def _counted(entries: pa.Table, longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Merged stripes told apart: phrases of 1 to ``longest`` words and their occurrences, of ``least`` or more."""
    def batches(rows: pa.Table, k: int):
        k = pa.array(np.full(len(rows), k, np.int32))
        yield from pa.table([rows["lang"], k, rows["phrase"], rows["n"]], ["lang", "k", "phrase", "n"]).to_batches()
    own = _summed(entries)
    words = pc.add(pc.count_substring(own["phrase"], " "), 1)
    yield from batches(own.filter(pc.is_null(words)), 0)
    yield from batches(own.filter(pc.and_(pc.equal(words, 1), pc.greater_equal(own["n"], least))), 1)
    level = own.slice(0, 0)
    for k in range(longest, 1, -1):  # what begins with a phrase is an occurrence of it
        level = _summed(pa.concat_tables([own.filter(pc.equal(words, k)), _shorter(level)]))
        yield from batches(level.filter(pc.greater_equal(level["n"], least)), k)


def _merged(stripes: DataFrame, longest: int, least: int) -> DataFrame:
    """``(lang, k, phrase, n)`` of the stripes merged elementwise; k is 0 for the words of a language. Only
    a group handed on unfinished has phrases in several rows, and some of less than ``least``."""
    def table(pending):
        return pa.table({name: pa.concat_arrays(x) for name, x in zip(("lang", "phrase", "n"), zip(*pending))})

    def task(batches):
        pending, size, last, partial = [], 0, None, False
        for batch in batches:
            lang, part, phrases, counts = (batch.column(c) for c in ("lang", "part", "phrases", "counts"))
            names = lang.cast(pa.string()).dictionary_encode()
            of, names = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            group = part.to_numpy()
            cut = np.flatnonzero((group[1:] != group[:-1]) | (of[1:] != of[:-1])) + 1
            for lo, hi in zip([0, *cut], [*cut, len(group)]):
                if lo == hi:
                    continue
                key = (names[of[lo]], int(group[lo]))
                if key != last and (partial or size > FLUSH_ENTRIES):
                    if pending:
                        yield from _counted(table(pending), longest, 0 if partial else least)
                    pending, size, partial = [], 0, False
                last = key
                n = counts.slice(lo, hi - lo).flatten()
                pending.append((pa.array([key[0]], pa.string()).take(pa.array(np.zeros(len(n), np.int32))),
                                phrases.slice(lo, hi - lo).flatten().cast(pa.string()), n))
                size += len(n)
                if size > MERGE_ENTRIES:
                    merged = _summed(table(pending))
                    pending, size = [tuple(merged[c].combine_chunks() for c in ("lang", "phrase", "n"))], len(merged)
                    if size > MERGE_ENTRIES // 2:
                        yield from _counted(merged, longest, 0)
                        pending, size, partial = [], 0, True
        if pending:
            yield from _counted(table(pending), longest, 0 if partial else least)
        pending.clear()
        pa.default_memory_pool().release_unused()  # workers are used again
    return stripes.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(task, _COUNTED)


def _first_of(phrases: DataFrame, top: int, parts: int) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = (phrases.withColumn("part", part)
                   .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
                   .where(F.col("rank") <= top).drop("rank", "part"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
                .where(F.col("rank") <= top))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST,
                     longest: int = LONGEST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, phrase, prefix, next, a)`` of all phrases of one to ``longest`` words with ``least`` occurrences
    or more, and ``(lang, n)``, the words of each language."""
    docs = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    bitmaps = []
    for k in (1, 2):
        bitmaps.append(_frequent(docs, k, bitmaps, least, bits))
    entries = (_merged(_stripes(docs, longest, bitmaps), longest, least)
               .groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
               .where((F.col("n") >= least) | F.col("phrase").isNull()))
    entries = written(entries, "stripes")
    totals = entries.where("phrase is null").select("lang", "n")
    return (entries.where("phrase is not null")
                   .select("lang", "k", "phrase", F.expr("substring_index(phrase, ' ', k - 1)").alias("prefix"),
                           F.expr("substring_index(phrase, ' ', -1)").alias("next"), F.col("n").alias("a")), totals)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, top: int = TOP,
                 longest: int = LONGEST, percent: int = 100, bits: int = BITS) -> DataFrame:
    """Per language its first ``top`` phrases: lang, rank, phrase, a, l, r, n, score. Candidates inside a longer
    one of ``percent`` of their occurrences or more are dropped."""
    phrases, totals = frequent_phrases(docs, text_col, lang_col, least=least, longest=longest, bits=bits)
    # phrases one word longer, by the phrase they extend to the right or to the left
    wider = phrases.where("k > 2")
    tail = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    around = (wider.select("lang", F.col("prefix").alias("phrase"), "a")
                   .union(wider.select("lang", tail.alias("phrase"), "a"))
                   .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
    candidates = (phrases.where("k > 1").join(around, ["lang", "phrase"], "left")
                         .where(f"around is null or 100 * around < {percent} * a").select("lang", "phrase", "a"))
    words = F.split("phrase", " ")
    cuts = (candidates.withColumn("j", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
                      .withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("j")), " "))
                      .withColumn("right", F.expr("substring(phrase, length(left) + 2)")))
    counts = phrases.select("lang", "phrase", "a")
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
                .join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
                .join(totals, "lang"))
    scored = (cuts.withColumn("score", F.expr(SCORE))
                  .groupBy("lang", "phrase", "a", "n")
                  .agg(F.min(F.struct("score", "j", "l", "r")).alias("c"))
                  .select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score"))
    parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS)
    return _first_of(scored, top, parts).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
