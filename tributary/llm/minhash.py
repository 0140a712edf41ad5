"""Near-duplicates by circulant MinHash, banding and exact Jaccard (operator 1).

1. Every text becomes its set of distinct word shingles (64-bit hashes). A
   first permutation ``sigma`` scatters the shingles over 2^32 slots; a second
   one, ``pi``, is used circularly shifted: coordinate k of the signature is
   ``min pi(sigma(s) + k)``. Two permutations give all coordinates.
2. Texts with equal shingle sets form a class (128-bit digest of the sorted
   set), reduced map-side to one representative, so a group of copies holding
   a third of all rows is one row from here on.
3. Bands of the signature are grouped. Shingles that no other member has can
   be in no intersection, and histograms of shingle hashes bound how far two
   sets differ: pairs and members below the threshold are ruled out exactly. A band group
   of few members gives its pairs; a larger one is worked in rounds: first the
   least edited member, then many times as many each round, lead and are
   compared with every member outside their component, then leave. A round's pairs grow with the group, not with its square, and
   after the last round every pair of a group has been compared or is known
   to be connected already, so no link between components is lost.
4. Each pair is confirmed on the full shingle sets:
   ``100 * intersection >= percent * union``.
5. Connected components by min-label propagation with pointer jumping on the
   link table; nothing of it reaches the driver but row counts.

With ``bands=25`` of ``rows=5`` a pair at similarity 0.85 shares no band with
probability (1 - 0.85^5)^25 = 4e-7, and 7e-5 at 0.8.

Defined results: null or empty texts and texts without words have no shingles,
are linked with nothing and are their own component. Repeated rows stay rows
and share a class. A null ``doc_id`` never names a component unless the whole
component has no id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged
from tributary.llm.store import written

SHINGLE_WORDS = 5
BANDS = 25
ROWS = 5
PERCENT = 85
# Band groups up to this size are compared at once, larger ones in rounds of leaders.
SMALL_GROUP = 32
# Classes of the shingle histograms that bound the difference of two sets.
HISTOGRAM = 128
# Leaders of a larger band group in its second round (the first has one), and how many times as many in later ones.
LEADERS = 256
GROWTH = 8

_SIG_SCHEMA = "doc_id bigint, n_shingles bigint, fp binary, bands array<bigint>"


def _shingles(buf, offs, k: int):
    """Per text of a block: the sorted distinct shingle hashes."""
    w = ragged.words(buf, offs, lower=True)
    sh, at = ragged.windows(w, k)
    cut = np.searchsorted(at, w.first)  # windows of text d: sh[cut[d]:cut[d+1]]
    for d, c in enumerate(w.count()):
        if c >= k:
            yield np.unique(sh[cut[d]:cut[d + 1]])
        elif c:
            yield np.array([ragged.sequence_hash(w.hash[w.first[d]:w.first[d + 1]])], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _pi(x: np.ndarray, tmp: np.ndarray) -> None:
    """The circulated permutation: an in-place bijection of 32-bit integers."""
    np.multiply(x, np.uint32(0x85EBCA6B), out=x)
    np.right_shift(x, np.uint32(15), out=tmp)
    np.bitwise_xor(x, tmp, out=x)
    np.multiply(x, np.uint32(0xC2B2AE35), out=x)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant signatures, one row per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    sig = np.empty((len(sets), size), np.uint32)
    # sigma: the top half of the mixed shingle hash, i.e. a random placement
    sigma = (ragged.mix64(flat) >> np.uint64(32)).astype(np.uint32)
    step = 1 << 15
    # pieces of bounded size keep the working set in cache; a set cut by a piece border is merged by min
    sig.fill(np.iinfo(np.uint32).max)
    for lo in range(0, len(flat), step):
        x = sigma[lo:lo + step]
        first = int(np.searchsorted(starts, lo, "right")) - 1
        last = int(np.searchsorted(starts, lo + len(x), "left"))
        cuts = np.maximum(starts[first:last] - lo, 0)
        t, tmp = np.empty_like(x), np.empty_like(x)
        part = np.empty((size, last - first), np.uint32)
        for k in range(size):
            np.add(x, np.uint32(k), out=t)
            _pi(t, tmp)
            part[k] = np.minimum.reduceat(t, cuts)
        np.minimum(sig[first:last], part.T, out=sig[first:last])
    return sig


def _band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            acc = ragged.mix64(acc ^ sig[:, b * rows + r].astype(np.uint64)) + np.uint64(r + 1)
        out[:, b] = ragged.mix64(acc)
    return out.view(np.int64)


def _fingerprint(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sign(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, n_shingles, fp, bands)`` per row; fp is null without shingles."""
    def task(batches):
        for part, buf, offs in ragged.blocks(batches, "text"):
            sets = list(_shingles(buf, offs, k))
            some = [i for i, s in enumerate(sets) if len(s)]
            fps = [None] * len(sets)
            band = [None] * len(sets)
            if some:
                h = _band_hashes(signatures([sets[i] for i in some], bands * rows), bands, rows)
                for row, i in enumerate(some):
                    fps[i] = _fingerprint(sets[i])
                    band[i] = h[row]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(fps, pa.binary()),
                 pa.array(band, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "fp", "bands"])
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .mapInArrow(task, _SIG_SCHEMA))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(fp, shingles, hist)`` of the wanted representatives, from their texts; hist counts the
    shingles by ``HISTOGRAM`` classes of their hash."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    w = wanted.select(F.col("rep").alias("_rep"), "fp")
    rows = rows.join(w, rows["doc_id"].eqNullSafe(w["_rep"])).select("fp", "text")

    def task(batches):
        for part, buf, offs in ragged.blocks(batches, "text"):
            fps = part.column(0).to_pylist()
            found = [(fp, s) for fp, s in zip(fps, _shingles(buf, offs, k)) if len(s) and _fingerprint(s) == fp]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in found], pa.binary()),
                 pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64())),
                 pa.array([np.bincount((s % np.uint64(HISTOGRAM)).astype(np.int64), minlength=HISTOGRAM).astype(np.int32)
                           for _, s in found], pa.list_(pa.int32()))], ["fp", "shingles", "hist"])
    return rows.mapInArrow(task, "fp binary, shingles array<bigint>, hist array<int>")


def _first() -> F.Column:
    return F.min(F.struct((F.col("n") - F.col("m")).alias("edits"), "fp")).alias("first")


def _bound(n: str, m: str, n2: str, m2: str, percent: int) -> str:
    """SQL test that two sets can be similar: their intersection is at most the smaller ``m``, the
    shingles a set shares with any other. It rules out pairs exactly, before any set moves."""
    return f"100 * least({m}, {m2}) >= {percent} * ({n} + {n2} - least({m}, {m2}))"


def _near(hist: str, hist2: str, n: str, n2: str, percent: int) -> str:
    """SQL test that two sets can be similar: they differ in at least the sum of the differences of their
    histograms. Exact like the other bound, and tighter for members edited in different places."""
    apart = f"aggregate(zip_with({hist}, {hist2}, (x, y) -> abs(x - y)), 0, (s, d) -> s + d)"
    return f"{100 - percent} * ({n} + {n2}) >= {100 + percent} * {apart}"


def _feasible(slots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Band group members ``(h, fp, n, m, c, first)`` that can have a partner; m counts the shingles
    that are not a member's alone, c the members of the group, first is its least edited one."""
    alone = (sets.select("fp", F.explode("shingles").alias("s")).groupBy("s")
                 .agg(F.count(F.lit(1)).alias("df"), F.min("fp").alias("fp")).where("df = 1")
                 .groupBy("fp").agg(F.count(F.lit(1)).alias("alone")))
    members = (slots.join(alone, "fp", "left").withColumn("m", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
                    .where(100 * F.col("m") >= percent * F.col("n")))
    per = members.groupBy("h").agg(F.count(F.lit(1)).alias("c"), _first()).where("c > 1")
    return members.join(per, "h")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets meet the threshold."""
    pairs = pairs.distinct()
    a = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(b, "b").join(a, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.where(100 * common >= percent * union).select("a", "b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, label)`` with the smallest node of each component; links are ``(a, b)``.

    Each step takes the smallest label around a node, then jumps to the label
    of that label, so long chains halve. The only thing counted on the driver
    is how many labels changed.
    """
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                    "edges", True)
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")) \
                  .select("node", F.least("node", "m").alias("label"))
    labels = written(labels, "labels", True)
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                     .agg(F.min("label").alias("m")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = written(step, "labels", True)
        changed = step.where(F.col("old") != F.col("label")).limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    shingle_words: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS,
                    percent: int = PERCENT, small_group: int = SMALL_GROUP) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, class_id (hex digest of the shingle set)."""
    signed = written(sign(docs, id_col, text_col, shingle_words, bands, rows), "minhash")
    reps = (signed.where("fp is not null").groupBy("fp")
                  .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    reps = written(reps, "classes", True)
    slots = reps.select("fp", "n", F.explode("bands").alias("h"))
    shared = slots.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    slots = written(slots.join(shared, "h"), "band-groups", True)
    sets = written(_sets(docs, reps.join(slots.select("fp").distinct(), "fp", "left_semi"), id_col, text_col,
                         shingle_words), "sets")
    groups = written(_feasible(slots, sets, percent), "open-groups", True)

    # small band groups: their pairs
    pairs = (groups.where(F.col("c") <= small_group).groupBy("h")
                   .agg(F.sort_array(F.collect_list(F.struct("fp", "n", "m"))).alias("members")).select("members").distinct()
                   .select(F.explode(F.expr(
                       "flatten(transform(members, (x, i) -> transform(filter(slice(members, i + 2, size(members)), "
                       f"y -> {_bound('x.n', 'x.m', 'y.n', 'y.m', percent)}), "
                       "y -> struct(x.fp as a, y.fp as b))))")).alias("p")).select("p.*"))
    # larger ones: rounds of leaders, the least edited member first, then many times as many each round
    left = groups.where(F.col("c") > small_group).withColumn("label", F.col("fp")) \
                 .join(reps.select("fp", "bands"), "fp").join(sets.select("fp", "hist").dropDuplicates(["fp"]), "fp")
    share, links, labels = 0, None, None
    while True:
        draw = F.pmod(F.xxhash64("fp", F.lit(share)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        is_leader = (F.col("fp") == F.col("first.fp")) | (draw * F.col("c") < share)
        lead = left.where(is_leader).select("h", F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("m").alias("m_a"),
                                            F.col("label").alias("label_a"), F.col("bands").alias("bands_a"),
                                            F.col("hist").alias("hist_a"))
        # a pair that meets in several band groups is compared in the first one only
        led = (left.join(lead, "h").where("label <> label_a").where(_bound("n", "m", "n_a", "m_a", percent))
                   .where("element_at(array_intersect(bands, bands_a), 1) = h")
                   .where(_near("hist", "hist_a", "n", "n_a", percent))
                   .select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b")))
        found = written(_confirmed(pairs.union(led) if links is None else led, sets, percent), "links", True)
        if links is None or found.limit(1).count():
            links = found if links is None else links.union(found)
            labels = connected_components(links)
        now = (left.where(~is_leader).drop("label", "c", "first").join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                   .withColumn("label", F.coalesce("label", "fp")))
        per = (now.groupBy("h").agg(F.count(F.lit(1)).alias("c"), _first(), F.min("label").alias("lo"),
                                    F.max("label").alias("hi")).where("lo <> hi").drop("lo", "hi"))
        left = written(now.join(per, "h"), "open-groups", True)
        if not left.limit(1).count():
            break
        share = share * GROWTH or LEADERS

    top = reps.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
              .select("fp", "rep", F.coalesce("label", "fp").alias("label"))
    roots = top.groupBy("label").agg(F.min("rep").alias("root"))
    classes = top.join(roots, "label").select("fp", "root")
    out = signed.select("doc_id", "n_shingles", "fp").join(classes, "fp", "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), F.lower(F.hex("fp")).alias("class_id"))
