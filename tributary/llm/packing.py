"""Conflict-constrained best-fit packing (operator 4).

Texts become pieces of at most ``CAPACITY`` words. Pieces are dealt to shards
of about ``SHARD`` rows by a hash of their content and place, never by source
or cluster, so a hot source spreads over all shards. A shard packs its pieces
largest first. Open bins are kept ordered by residual room; each carries a
bitmap of the sources and one of the duplicate clusters it holds. The search
starts at the tightest bin with room and goes on to its successors until one
has neither the piece's source nor its cluster; without any, a bin is opened.

No piece is dropped and no bin holds two pieces of one source or one cluster
of duplicates, so a source with a third of all rows needs as many bins as it
has rows. Only ids and sizes are shuffled, not texts.

Defined results: null and empty texts have no words and are packed as pieces of
size 0; a null source or id is a value like any other; repeated rows are
pieces of one cluster; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import ragged

CAPACITY = 4096
# Pieces a shard holds on average; a shard is packed in one task.
SHARD = 4096

_SIZED = "doc_id bigint, source string, cluster bigint, n_words bigint, place bigint"
PACKED = "doc_id bigint, piece int, start_word bigint, n_words bigint, bin_id bigint, slot int, source string, cluster bigint"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """Bin of each piece, in the given order; sources and clusters are bit numbers."""
    room: list[tuple[int, int]] = []  # (residual, bin), ascending
    has_source: list[int] = []
    has_cluster: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source, 1 << cluster
        for i in range(bisect_left(room, (size, -1)), len(room)):
            left, b = room[i]
            if not (has_source[b] & s or has_cluster[b] & c):
                del room[i]
                break
        else:
            left, b = capacity, len(has_source)
            has_source.append(0)
            has_cluster.append(0)
        has_source[b] |= s
        has_cluster[b] |= c
        insort(room, (left - size, b))
        out.append(b)
    return out


def _sized(docs: DataFrame) -> DataFrame:
    """Words, duplicate cluster (hash of the lower-cased word sequence) and place of every text."""
    def task(batches):
        row = 0
        for part, buf, offs in ragged.blocks(batches, "text"):
            w = ragged.words(buf, offs, lower=True)
            n = part.num_rows
            pos = np.arange(len(w.hash)) - w.first[w.doc]
            total = np.concatenate([[np.uint64(0)], np.cumsum(ragged.mix64(w.hash + ragged.mix64(pos.astype(np.uint64))),
                                                              dtype=np.uint64)])
            cluster = ragged.mix64(total[w.first[1:]] - total[w.first[:-1]]).view(np.int64)
            place = np.arange(row, row + n)
            row += n
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), pa.array(cluster),
                                              pa.array(w.count()), pa.array(place)],
                                             [f.split()[0] for f in _SIZED.split(", ")])
    return docs.select("doc_id", "source", "text").mapInArrow(task, _SIZED)


def _numbers(values: pd.Series) -> list[int]:
    return pd.factorize(values, use_na_sentinel=False)[0].tolist()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
         capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Per piece: doc_id, piece, start_word, n_words, bin_id, slot, source, cluster."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).cast("string").alias("text"))
    shards = docs.count() // shard + 1
    piece = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n_words") / capacity).cast("int") - 1, F.lit(0))))
    pieces = (_sized(docs).select("*", piece.alias("piece"))
              .withColumn("start_word", F.col("piece").cast("bigint") * capacity)
              .withColumn("n_words", F.least(F.col("n_words") - F.col("start_word"), F.lit(capacity)).cast("bigint"))
              .withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "piece", "place"), F.lit(shards)))
              .drop("place"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "doc_id", "cluster", "piece"], ascending=[False, True, True, True],
                              kind="stable", na_position="last")
        b = best_fit(pdf["n_words"].tolist(), _numbers(pdf["source"]), _numbers(pdf["cluster"]), capacity)
        pdf["bin_id"] = np.array(b, np.int64) + (pdf["shard"].to_numpy(np.int64) << 32)
        pdf["slot"] = pdf.groupby("bin_id").cumcount().astype("int32")
        return pdf[[f.split()[0] for f in PACKED.split(", ")]]
    return pieces.groupBy("shard").applyInPandas(packed, PACKED)
