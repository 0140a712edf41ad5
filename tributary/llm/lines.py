"""Substring dedup by line or paragraph hashing (operator 9).

A text is cut into units: its lines, and inside a line its sentences (a
sentence ends at ``.``, ``!`` or ``?`` before white space), so that a passage
spliced into a longer line is found too. Units are normalised (A-Z folded,
white space runs as one space, ends trimmed) and hashed to 128 bits. Digests
are grouped over all texts; the occurrence of smallest rank (doc_id, text,
place) stays and all others go. Results carry the removed units' original
offsets in code points.

Every non-empty unit takes part. A unit of ``MIN_WORDS`` words or more is held
by itself. A shorter one ("Yes, of course.") is no sign of copying alone, so it
is held with its neighbours: with as many following units as make ``MIN_WORDS``
words, and with as many preceding ones. It goes if either of these passages
occurred before. A text that has fewer words in all is one passage.

Digests meet in a map-side combined minimum, and only digests seen twice are
joined back, the others are left out by a bitmap of fixed size; a line that a third of all texts hold is one row per task there,
and its occurrences are narrow rows that adaptive execution can split.

Defined results: one row per input row; null and empty texts have no units; a
null id ranks after all others; equal rows rank alike, and each keeps what the
other keeps; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged
from tributary.llm.store import written

MIN_WORDS = 8
# A unit ends at a newline, or at the white space after the end of a sentence.
SEPARATOR = "\n"
SENTENCE_END = re.compile(r"([.!?])[ \t\x0b\x0c\r]")

# Bits of the bitmap of repeated digests, 8 MB: fixed, so what is collected and broadcast is too.
BITS = 1 << 26

_UNITS = ("doc_id bigint, text_key bigint, n_units bigint, "
          "units array<struct<d1:bigint,d2:bigint,first:int,start:int,end:int>>")
_FLAT = "row bigint, doc_id bigint, text_key bigint, d1 bigint, d2 bigint, first int, start int, end int"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _text_key(text: str) -> int:
    """Orders different texts that share an id: the first 15 hex digits of the MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def units(text: str, sentences: bool = True, min_words: int = MIN_WORDS) -> tuple[int, list[tuple[bytes, int, int, int]]]:
    """How many units are not empty, and for each passage that decides about a unit ``(digest, first, start, end)``:
    the passage's first unit and the unit's place."""
    found, at = [], 0
    if sentences:  # same length, so offsets hold
        text = SENTENCE_END.sub(r"\1\n", text)
    for i, unit in enumerate(text.split(SEPARATOR)):
        words = unit.encode().translate(_FOLD).split()
        if words:
            found.append((words, i, at, at + len(unit)))
        at += len(unit) + 1
    before = [0, *accumulate(len(w) for w, *_ in found)]
    out = []
    for n, (words, i, start, end) in enumerate(found):
        if len(words) >= min_words:
            passages = [(i, words)]
        elif before[-1] < min_words:
            passages = [(found[0][1], [w for u, *_ in found for w in u])]
        else:
            passages = []
            for step in (1, -1):  # with what follows, with what precedes
                run, m, first = list(words), n + step, i
                while len(run) < min_words and 0 <= m < len(found):
                    run = run + found[m][0] if step == 1 else found[m][0] + run
                    first = min(first, found[m][1])
                    m += step
                if len(run) >= min_words:
                    passages.append((first, run))
        out += [(_digest(p), first, start, end) for first, p in passages]
    return len(found), out


def _cut(docs: DataFrame, sentences: bool, min_words: int) -> DataFrame:
    def task(batches):
        for batch in batches:
            texts = ragged.texts_of(batch.column(1)).to_pylist()
            counts, found = zip(*(units(t, sentences, min_words) for t in texts)) if texts else ((), ())
            flat = list(zip(*(u for f in found for u in f))) or [[]] * 4
            halves = np.frombuffer(b"".join(flat[0]), np.int64).reshape(-1, 2)
            struct = pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), *(pa.array(c, pa.int32()) for c in flat[1:])],
                                                ["d1", "d2", "first", "start", "end"])
            offsets = pa.array([0, *accumulate(len(f) for f in found)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_text_key(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
                                              pa.ListArray.from_arrays(offsets, struct)], ["doc_id", "text_key", "n_units", "units"])
    return docs.mapInArrow(task, _UNITS)


def _seen_again(cut: DataFrame, again: DataFrame, bits: int) -> DataFrame:
    """Passages whose digest may be among the repeated ones: a bitmap leaves out nearly all others before they move."""
    rows = (again.select((F.col("d1").bitwiseAND(F.lit(bits - 1)) + 1).alias("bit"))
                 .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
                 .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))).toArrow()
    bitmap = np.zeros(bits // 8, np.uint8)  # 4,096 bytes of it a row
    for bucket, piece in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        bitmap[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(piece, np.uint8)
    known = cut.sparkSession.sparkContext.broadcast(bitmap)

    def task(batches):
        for batch in batches:
            units = batch.column(3)
            d1, d2, first, start, end = (np.asarray(c) for c in units.flatten().flatten())
            bit = d1 & (bits - 1)
            hit = (known.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            of = pa.array(np.repeat(np.arange(batch.num_rows), units.value_lengths().to_numpy())[hit])
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in range(3)),
                                              *(pa.array(c[hit]) for c in (d1, d2, first, start, end))], [f.split()[0] for f in _FLAT.split(", ")])
    return cut.select("row", "doc_id", "text_key", "units").mapInArrow(task, _FLAT)


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sentences: bool = True,
                   min_words: int = MIN_WORDS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, n_units, n_removed, removed_chars, removed (``start:end`` by start, comma-joined)."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # written once: a row keeps its number from here on
    cut = written(_cut(docs, sentences, min_words).withColumn("row", F.monotonically_increasing_id()), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "first")
    flat = cut.select("doc_id", "text_key", F.explode("units").alias("u")).select("doc_id", "text_key", "u.d1", "u.d2", "u.first")
    first = written(flat.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("keep")).where("n > 1"), "repeated")
    gone = _seen_again(cut, first, bits).join(first, ["d1", "d2"]).where(rank > F.col("keep"))
    spans = F.array_sort(F.collect_set(F.struct("start", "end")))
    rows = cut.select("row", "doc_id", "n_units").join(gone.groupBy("row").agg(spans.alias("spans")), "row", "left")
    return rows.select(
        "doc_id", "n_units", F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.expr("coalesce(aggregate(spans, 0L, (a, s) -> a + cast(s.end - s.start as bigint)), 0L)").alias("removed_chars"),
        F.expr("coalesce(array_join(transform(spans, s -> concat(s.start, ':', s.end)), ','), '')").alias("removed"))


def without(text: str, removed: str) -> str:
    """The text without the removed spans and the separator after each."""
    out, at = [], 0
    for span in filter(None, removed.split(",")):
        a, b = map(int, span.split(":"))
        out.append(text[at:a])
        at = min(b + 1, len(text))
    return "".join(out) + text[at:]
