"""Sharding by balanced label propagation (operator 13).

Documents are nodes, links tie those that should share a shard, labels are
shards. ``propagate`` is the general part: any nodes with weights, any links.

1. Every node starts with the label its hash gives, so weights start even.
2. In a round, a join of links and labels counts each node's neighbours by
   label (map-side sums, so a node with very many neighbours is a few rows a
   task). A node asks for the label of most neighbours if that beats its own.
   Only a drawn half of the nodes may ask in a round, and of nodes with more
   neighbours than these have themselves as many fewer: two neighbours do not
   swap labels for ever, and members follow their hub, not the hub its members.
3. Requests are granted under quotas: a label may hold ``ceil(weight /
   shards)`` of linked weight. Where more ask than fit, the share that fits is
   granted, drawn by hash. Only the label totals (a row per shard) reach the
   driver. Rounds end when nobody asks, or after ``ROUNDS``.
4. ``seated`` turns labels into shards of exact sizes, at most one row apart:
   rows in rank order fill their label's seats, rows without links last. What
   is over a label's seats moves to the free seats of others, so first of all
   rows that tear no link. Ranks are prefix sums over buckets of bounded size;
   no task holds a shard. The rank is the slot.

Links of equal texts form two levels of stars: the members of a group are dealt
by hash to up to ``STARS`` hubs, and the hubs to one. A group that holds a third
of all rows becomes many stars, joins by hub stay even, and under the quotas it
tears between stars instead of inside them.

The law is ``rows``: shard counts are at most one apart.

Defined results: a null text is an empty one (size 1, checksum 0); repeated rows
are rows of their own; a null id is carried along; an empty table gives none;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.store import written

SHARDS = 16
LAW = "rows"
ROUNDS = 10
# Stars the members of one group are dealt to.
STARS = 1024
# Rows a rank bucket holds, about: one task ranks them.
BUCKET_ROWS = 100_000


def equal_text_links(rows: DataFrame, stars: int = STARS) -> DataFrame:
    """Links ``(a, b)`` between the rows ``(node, digest)`` of each digest: its members in up to ``stars`` stars,
    their hubs in one star. Every join is by digest and star, so a hot digest is spread."""
    rows = rows.select("node", "digest", F.pmod(F.xxhash64("node"), F.lit(stars)).cast("int").alias("star"))
    hubs = written(rows.groupBy("digest", "star").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")), "star-hubs")
    tops = hubs.groupBy("digest").agg(F.sum("c").alias("members"), F.min("hub").alias("top")).where("members > 1")
    hubs = hubs.join(tops.select("digest", "top"), "digest")
    members = rows.join(hubs.where("c > 1").select("digest", "star", "hub"), ["digest", "star"]).where("node <> hub")
    return members.select(F.col("node").alias("a"), F.col("hub").alias("b")).union(
        hubs.where("hub <> top").select(F.col("hub").alias("a"), F.col("top").alias("b")))


def _draw(salt: int) -> F.Column:
    """A number in [0, 1) from the node and the salt."""
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(nodes: DataFrame, links: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """Labels ``(node, label)`` of the linked nodes.

    ``nodes`` is ``(node, weight)`` with one row a linked node, ``links`` is ``(a, b)``; ``capacity`` bounds the
    linked weight of a label. A label whose nodes start beyond it takes none until others leave.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neighbours")
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    around = (both.join(degree.select(F.col("a").alias("b"), F.col("d").alias("d_b")), "b").groupBy("a")
                  .agg(F.count(F.lit(1)).alias("d"), F.avg("d_b").alias("d_b"))
                  .select(F.col("a").alias("node"), (F.least(F.lit(1.0), F.col("d_b") / F.col("d")) / 2).alias("chance")))
    first = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    state = written(nodes.select("node", "weight", first.alias("label")).join(around, "node"), "labels", True)
    for turn in range(rounds):
        near = (both.join(state.select(F.col("node").alias("b"), F.col("label").alias("to")), "b")
                    .groupBy("a", "to").agg(F.count(F.lit(1)).alias("n")))
        # most neighbours first; the own label wins a tie, then the smallest
        want = (near.join(state.select(F.col("node").alias("a"), "label"), "a")
                    .groupBy("a").agg(F.max(F.struct("n", (F.col("to") == F.col("label")).alias("own"), (-F.col("to")).alias("t"))).alias("w"))
                    .select(F.col("a").alias("node"), (-F.col("w.t")).alias("to")))
        asked = written(state.join(want, "node").withColumn("asks", F.col("to") != F.col("label"))
                             .withColumn("now", F.col("asks") & (_draw(2 * turn) < F.col("chance"))), "requests", True)
        if not asked.where("asks").limit(1).count():
            break
        # a row per shard
        held = {r.label: r.w for r in asked.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        wish = {r.to: r.w for r in asked.where("now").groupBy("to").agg(F.sum("weight").alias("w")).collect()}
        share = [F.lit(min(1.0, max(0, capacity - held.get(s, 0)) / wish[s]) if wish.get(s) else 0.0) for s in range(shards)]
        granted = F.col("now") & (_draw(2 * turn + 1) < F.element_at(F.array(*share), F.col("to") + 1))
        state = written(asked.select("node", "weight", F.when(granted, F.col("to")).otherwise(F.col("label")).alias("label"),
                                     "chance"), "labels", True)
    return state.select("node", "label")


def cut_links(links: DataFrame, labels: DataFrame) -> int:
    """Links whose ends have different labels."""
    one, two = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b"))
    return links.join(one, "a").join(two, "b").where("label_a <> label_b").count()


def seated(rows: DataFrame, shards: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows ``(node, label, linked, ...)`` with ``shard`` and ``slot``: every shard gets its even share of
    rows, and slots run from 0 without gaps."""
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    # linked rows first, so that what must leave a label are rows without links as far as there are any
    cell = ["label", "last", "bucket"]
    rows = rows.withColumn("last", (~F.col("linked")).cast("int")).withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))
    counts = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("c"))
    # the cells of one label: two a bucket of rows
    counts = counts.withColumn("before", F.sum("c").over(Window.partitionBy("label").orderBy("last", "bucket")) - F.col("c")) \
                   .drop("c")
    ranked = (rows.withColumn("_i", F.row_number().over(Window.partitionBy(*cell).orderBy("node")) - 1)
                  .join(counts, cell).withColumn("rank", F.col("before") + F.col("_i")).drop("_i", "before", "last", "bucket"))
    held = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per shard
    seats = [total // shards + (s < total % shards) for s in range(shards)]
    over = [max(0, held.get(s, 0) - seats[s]) for s in range(shards)]
    free = [max(0, seats[s] - held.get(s, 0)) for s in range(shards)]
    at = F.col("label") + 1
    seats_of, over_before = F.element_at(F.array(*map(F.lit, seats)), at), F.element_at(
        F.array(*(F.lit(sum(over[:s])) for s in range(shards))), at)
    # the p-th row that must move takes the p-th free seat
    p = F.when(F.col("rank") >= seats_of, over_before + F.col("rank") - seats_of)
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for s in reversed(range(shards)):
        if free[s]:
            here = F.col("p") >= sum(free[:s])
            taken = seats[s] - free[s] - sum(free[:s])
            # the highest shard whose free seats start at or before p
            shard = F.when(here & (F.col("p") < sum(free[:s + 1])), F.lit(s)).otherwise(shard)
            slot = F.when(here & (F.col("p") < sum(free[:s + 1])), F.col("p") + taken).otherwise(slot)
    moved = ranked.withColumn("p", p)
    return (moved.withColumn("shard", F.coalesce(F.when(F.col("p").isNull(), F.col("label")), shard).cast("int"))
                 .withColumn("slot", F.coalesce(F.when(F.col("p").isNull(), F.col("rank")), slot).cast("bigint"))
                 .drop("p", "rank"))


def balanced_shards(rows: DataFrame, links: DataFrame, shards: int = SHARDS, *, rounds: int = ROUNDS,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` (``node``, unique, and other columns) with ``shard`` and ``slot``; ``links`` is ``(a, b)`` over nodes."""
    linked = written(links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
                     .withColumn("weight", F.lit(1).cast("bigint")), "linked", True)
    capacity = -(-rows.count() // shards)
    labels = propagate(linked, links, shards, capacity, rounds).withColumnRenamed("label", "_label")
    out = rows.join(labels, "node", "left").withColumn("linked", F.col("_label").isNotNull()).withColumn(
        "label", F.coalesce("_label", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")))
    return seated(written(out.drop("_label"), "labelled"), shards, bucket_rows).drop("label", "linked")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS,
                    rounds: int = ROUNDS, stars: int = STARS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"))
    # written once: from here on every row, repeated ones too, has a number of its own
    rows = written(rows.withColumn("node", F.monotonically_increasing_id()), "shard-rows")
    links = written(equal_text_links(rows, stars), "links", True)
    out = balanced_shards(rows.drop("digest"), links, shards, rounds=rounds, bucket_rows=bucket_rows)
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
