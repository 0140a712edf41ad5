"""Exact long-substring removal with run-length indexes (operator 3).

Every byte under a ``LENGTH``-byte string that also starts anywhere else is
removed; strings are judged on the input. No index of the whole corpus is
built in one place; equal strings are first brought together:

1. Every ``LENGTH``-byte window of a text chooses an anchor, the ``GRAM``-byte
   string of smallest hash in it. Equal windows choose equal anchors at equal
   offsets. A run of windows with one anchor is an occurrence of the anchor:
   about one per 137 bytes. Windows that occur twice in one text are marked on
   the spot, and only the first of them goes on.
2. Anchors that occur once are dropped. Occurrences with equal spans (two
   window hashes cover a span) are marked by counting; one of each stays.
3. Where an anchor has different spans, their bytes are fetched and the spans
   of many anchors are put into blocks of bounded size, each anchor in one
   block. A run-compressed BWT with sampled run ends per block gives the
   matching statistics, and matches of ``LENGTH`` bytes or more are marked.
4. An anchor with more than ``GROUP`` different spans is not put into one
   block: its windows are cut into slots and grouped by the bytes all windows
   of a slot share, in narrower and narrower slots. At width one a group holds
   one span only, so this ends, with rows in proportion to the spans.
5. Marks of a text are united and its bytes cut. Equal whole texts are one
   class throughout: two of them of ``LENGTH`` bytes are removed whole.

Hashes have 64 bits, whole texts are compared by SHA-256.

Defined results: a null text is empty; a text shorter than ``LENGTH`` keeps
all bytes; repeated rows are copies of each other; a null id is carried along;
an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged
from tributary.llm.rindex import repeated_spans
from tributary.llm.store import written

LENGTH = 400
GRAM = 128
# Different spans of one anchor that may lie in one index block.
GROUP = 2000
# Bytes of spans per index block.
INDEX_BYTES = 1 << 19
# Slot widths for anchors with more spans than that.
WIDTHS = (64, 8, 1)

_BYTE = ragged.mix64(np.arange(7, 263, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
_SALT = np.uint64(0x589965CC75374CC3)
_LONG = np.uint64(0x1D8E4E27C47D124F)

_ANCHORED = ("doc_id bigint, digest binary, n_bytes bigint, local array<struct<s:int,e:int>>, "
             "anchors array<struct<h:bigint,seg:bigint,start:int,width:int,rel:int>>")
_SPANS = "key bigint, digest binary, rep bigint, start int, width int, rel int, single boolean, bytes binary"
_MARKS = "digest binary, rep bigint, s int, e int"


def _join_hash(a: np.ndarray, la: int, b: np.ndarray, lb: int) -> np.ndarray:
    """Hashes of ``la + lb`` bytes at each position from those of ``la`` and ``lb`` bytes."""
    m = max(len(a) - lb, 0)
    return a[:m] * ragged.powers(lb + 1)[lb] + b[la:la + m]


def _hashes(buf: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Polynomial hashes of every substring of the given sizes."""
    by = {1: _BYTE[buf]}
    p = 1
    while 2 * p <= max(sizes):
        by[2 * p] = _join_hash(by[p], p, by[p], p)
        p *= 2
    out = {}
    for size in sizes:
        acc, have = None, 0
        for bit in sorted((b for b in by if size & b), reverse=True):
            acc = by[bit] if acc is None else _join_hash(acc, have, by[bit], bit)
            have += bit
        out[size] = acc
    return out


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _struct_lists(counts: np.ndarray, names: list[str], columns: list[pa.Array]) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names))


def anchors(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Of the texts of a block: windows found twice in a text, as ``(text, s, e)`` arrays, and the
    anchor occurrences as ``(text, h, seg, start, width, rel)`` arrays."""
    n_docs = len(offs) - 1
    count = np.maximum(np.diff(offs) - length + 1, 0)
    total = int(count.sum())
    empty = np.zeros(0, np.int64)
    if not total:
        return (empty,) * 3, (empty,) * 6
    doc = np.repeat(np.arange(n_docs), count)
    at = np.arange(total) + np.repeat(offs[:-1] - np.cumsum(count) + count, count)
    h = _hashes(buf, [gram, length])
    win = ragged.mix64(h[length][at])
    grams = ragged.mix64(h[gram])
    bits = np.uint64(max(len(buf).bit_length(), 1))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    key = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_slide_min(key, length - gram + 1)[at] & mask).astype(np.int64)

    own = ragged.mix64(win + doc.astype(np.uint64) * _SALT)
    s = np.sort(own)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    keep = np.ones(total, bool)
    local = (empty,) * 3
    if len(twice):
        i = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        hits = np.flatnonzero(twice[i] == own)
        _, first = np.unique(own[hits], return_index=True)
        keep[hits] = False
        keep[hits[first]] = True
        cut = np.flatnonzero((hits[1:] != hits[:-1] + 1) | (doc[hits[1:]] != doc[hits[:-1]])) + 1
        a, b = hits[np.concatenate([[0], cut])], hits[np.concatenate([cut - 1, [len(hits) - 1]])]
        local = (doc[a], at[a] - offs[doc[a]], at[b] - offs[doc[b]] + length)
    k = np.flatnonzero(keep)
    cut = np.flatnonzero((anchor[k[1:]] != anchor[k[:-1]]) | (k[1:] != k[:-1] + 1) | (doc[k[1:]] != doc[k[:-1]])) + 1
    lo, hi = k[np.concatenate([[0], cut])], k[np.concatenate([cut - 1, [len(k) - 1]])]
    width, rel, start = hi - lo + 1, anchor[lo] - at[lo], at[lo] - offs[doc[lo]]
    # the first and the last window cover the whole span: equal hashes, equal spans
    seg = ragged.mix64(win[lo] + ragged.mix64(win[hi] + width.astype(np.uint64) * _LONG + rel.astype(np.uint64)))
    return local, (doc[lo], grams[anchor[lo]].view(np.int64), seg.view(np.int64), start, width, rel)


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def task(batches):
        for part, buf, offs in ragged.blocks(batches, "text", ragged.BLOCK_BYTES // 4):
            n = part.num_rows
            raw = buf.tobytes()
            digest = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offs[:-1], offs[1:])]
            (ld, ls, le), (ad, h, seg, start, width, rel) = anchors(buf, offs, length, gram)
            i32 = pa.int32()
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(digest, pa.binary()), pa.array(np.diff(offs)),
                _struct_lists(np.bincount(ld, minlength=n), ["s", "e"], [pa.array(ls, i32), pa.array(le, i32)]),
                _struct_lists(np.bincount(ad, minlength=n), ["h", "seg", "start", "width", "rel"],
                              [pa.array(h), pa.array(seg), pa.array(start, i32), pa.array(width, i32), pa.array(rel, i32)]),
            ], ["doc_id", "digest", "n_bytes", "local", "anchors"])
    return docs.select("doc_id", "text").mapInArrow(task, _ANCHORED)


def _with_text(docs: DataFrame, per_text: DataFrame) -> DataFrame:
    """Rows of ``per_text`` (digest, rep, ...) with the text; equal texts of other ids stay away."""
    t = docs.withColumn("_d", F.unhex(F.sha2("text", 256)))
    p = per_text.hint("shuffle_hash")
    return t.join(p, t["doc_id"].eqNullSafe(p["rep"]) & (t["_d"] == p["digest"])).drop("doc_id", "_d")


def _spans(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted occurrences."""
    per_text = wanted.groupBy("digest", "rep").agg(
        F.collect_list(F.struct("h", "start", "width", "rel", "single")).alias("want"))

    def task(batches):
        for batch in batches:
            for text, digest, rep, want in zip(*(batch.column(c).to_pylist() for c in ("text", "digest", "rep", "want"))):
                raw = text.encode()
                cols = [list(c) for c in zip(*((w["h"], digest, rep, w["start"], w["width"], w["rel"], w["single"],
                                                raw[w["start"]:w["start"] + w["width"] - 1 + length]) for w in want))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f) for c, f in zip(cols, _span_types())], [f.split()[0] for f in _SPANS.split(", ")])
    return _with_text(docs, per_text).select("text", "digest", "rep", "want").mapInArrow(task, _SPANS)


def _span_types() -> list[pa.DataType]:
    return [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]


def _indexed(spans: DataFrame, length: int) -> DataFrame:
    """Marks from run-length indexes over blocks of whole groups (rows of one key)."""
    def task(batches):
        rows, size, last = [], 0, None

        def flush():
            found = [(rows[i][1], rows[i][2], rows[i][3] + a, rows[i][3] + b)
                     for i, a, b in repeated_spans([r[5] for r in rows], length) if rows[i][4]]
            cols = list(zip(*found)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
                                              ["digest", "rep", "s", "e"])
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "rep", "start", "single", "bytes"))):
                if size > INDEX_BYTES and row[0] != last:
                    yield flush()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
                last = row[0]
        if rows:
            yield flush()
    # dealt by a hash of its own: the planner drops a repartition by the key of the join before it, and
    # adaptive execution may then broadcast or split that join and leave one key in several tasks
    return (spans.select("key", "digest", "rep", "start", "single", "bytes")
                 .repartition(F.xxhash64("key")).sortWithinPartitions("key").mapInArrow(task, _MARKS))


def _slots(spans: DataFrame, width: int, length: int) -> DataFrame:
    """Each span cut into slots of windows; the new key covers the bytes all windows of a slot share."""
    def task(batches):
        for batch in batches:
            out = []
            for key, digest, rep, start, n, rel, single, raw in zip(*(c.to_pylist() for c in batch.columns)):
                slot = -rel // width
                while slot * width < n - rel:
                    lo, hi = max(slot * width, -rel), min(slot * width + width, n - rel) - 1
                    core = raw[slot * width + width - 1 + rel:slot * width + rel + length]
                    new = hashlib.blake2b(core, digest_size=8, salt=(slot & 0xFFFF).to_bytes(2, "big"),
                                          person=key.to_bytes(8, "big", signed=True)).digest()
                    out.append((int.from_bytes(new, "big", signed=True), digest, rep, start + lo + rel, hi - lo + 1,
                                -lo, single, raw[lo + rel:hi + rel + length]))
                    slot += 1
            cols = list(zip(*out)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _span_types())],
                                             [f.split()[0] for f in _SPANS.split(", ")])
    return spans.select(*[f.split()[0] for f in _SPANS.split(", ")]).mapInArrow(task, _SPANS)


def _marks_of(rows: DataFrame, length: int) -> DataFrame:
    return rows.select("digest", "rep", F.col("start").alias("s"),
                       (F.col("start") + F.col("width") + (length - 1)).cast("int").alias("e"))


def _cut(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Per marked text: removed bytes, maximal removed runs and the hash of what is left."""
    per_text = marks.groupBy("digest", "rep").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("marks"))

    def task(batches):
        for batch in batches:
            out = []
            for text, digest, rep, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "digest", "rep", "marks"))):
                raw, kept, at, removed, runs, end = text.encode(), hashlib.sha256(), 0, 0, 0, -1
                for m in spans:
                    if m["s"] > end:  # a new run; runs that touch are one
                        runs += 1
                        kept.update(raw[at:m["s"]])
                        end = m["s"]
                    if m["e"] > end:
                        removed += m["e"] - end
                        end = at = m["e"]
                kept.update(raw[at:])
                out.append((digest, rep, removed, runs, kept.hexdigest()))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                ["digest", "rep", "n_removed", "n_spans", "kept_sha256"])
    return (_with_text(docs, per_text).select("text", "digest", "rep", "marks")
            .mapInArrow(task, "digest binary, rep bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH,
                   gram: int = GRAM, group: int = GROUP, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    first = written(_anchored(docs, length, gram), "anchored")
    classes = first.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"))
    c = classes.withColumnRenamed("digest", "_d")
    reps = first.join(c, (F.col("digest") == F.col("_d")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    occ = reps.select("digest", "rep", (F.col("copies") == 1).alias("alone"), F.explode("anchors").alias("a")) \
              .select("digest", "rep", "alone", "a.*")
    again = occ.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("s0"), F.max("seg").alias("s1")) \
               .where("n > 1").select("h", (F.col("s0") != F.col("s1")).alias("mixed"))
    active = written(occ.join(again, "h"), "repeated-anchors")
    segs = active.groupBy("h", "seg").agg(F.count(F.lit(1)).alias("n"), F.max("mixed").alias("mixed"),
                                          F.min(F.struct("digest", "rep", "start", "width", "rel", "alone")).alias("r"))
    equal = active.where("alone").join(segs.where("n > 1").select("h", "seg"), ["h", "seg"], "left_semi")
    one = segs.where("mixed").select("h", "r.*", ((F.col("n") == 1) & F.col("r.alone")).alias("single"))
    spans = written(_spans(docs, one, length), "spans")
    marks = [_marks_of(equal, length),
             first.join(classes.where("copies = 1").select("digest", "rep"), "digest")
                  .where("size(local) > 0").select("digest", "rep", F.explode("local").alias("m")).select("digest", "rep", "m.*")]
    sizes = spans.groupBy("key").agg(F.count(F.lit(1)).alias("in_group"))
    sized = spans.join(sizes, "key")
    marks.append(_indexed(sized.where(F.col("in_group") <= group), length))
    hot = sized.where(F.col("in_group") > group).drop("in_group")
    for width in widths:
        if not hot.limit(1).count():
            break
        cut = written(_slots(hot, width, length), "slots")
        spans_of = cut.withColumn("span", F.xxhash64("rel", "width", "bytes"))
        per = spans_of.groupBy("key", "span").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "rep", "start")).alias("r"))
        groups = per.groupBy("key").agg(F.count(F.lit(1)).alias("in_group"))
        marks.append(_marks_of(spans_of.where("single").join(per.where("n > 1").select("key", "span"), ["key", "span"], "left_semi"), length))
        rep = per.join(groups.where("in_group > 1"), "key").select("key", "span", "n", "in_group", "r.digest", "r.rep", "r.start")
        left = spans_of.join(rep.select("key", "span", "n", "in_group", F.col("digest").alias("d2"), F.col("rep").alias("r2"),
                                        F.col("start").alias("s2")), ["key", "span"])
        left = left.where((F.col("digest") == F.col("d2")) & F.col("rep").eqNullSafe(F.col("r2")) & (F.col("start") == F.col("s2")))
        left = written(left.withColumn("single", F.col("single") & (F.col("n") == 1))
                           .select(*[f.split()[0] for f in _SPANS.split(", ")], "in_group"), "slot-groups")
        marks.append(_indexed(left.where(F.col("in_group") <= group), length))
        hot = left.where(F.col("in_group") > group).drop("in_group")
    every = marks[0]
    for m in marks[1:]:
        every = every.union(m)
    cut = written(_cut(docs, every), "cut").withColumnsRenamed({"digest": "_d", "rep": "_r"})
    rows = first.select("doc_id", "digest", "n_bytes").join(classes.select("digest", "copies"), "digest")
    rows = rows.join(cut, (F.col("digest") == F.col("_d")) & F.col("doc_id").eqNullSafe(F.col("_r")), "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return rows.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
         .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"))
