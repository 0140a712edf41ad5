"""Bulk requests of an index sink: documents packed by bytes and actions (O2).

A request is a body of lines in the bulk form of search engines: an action line
and, unless it deletes, the document. Documents are dealt to shards by their
key, so all versions of a document meet in one shard, and are packed there in
order: a request is closed when the next document would pass ``max_bytes`` or
``max_actions``. Only a document larger than ``max_bytes`` is a request over it,
by itself. Shards are packed side by side, each row by row as it is read, so a
task holds one open request at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of a request unless set.
MAX_BYTES = 5 * 1024 * 1024
MAX_ACTIONS = 1000
DEFAULT_SHARDS = 16

REQUESTS = "shard int, request bigint, n_actions bigint, n_bytes bigint, body string"


def action_lines(apply_deletes: bool = True) -> Column:
    """The lines of one document: ``index`` replaces it whole, ``delete`` removes it."""
    target = F.struct(F.col("index_name").alias("_index"), F.col("doc_id").alias("_id"))
    index = F.concat(F.to_json(F.struct(target.alias("index"))), F.lit("\n"), F.col("doc"), F.lit("\n"))
    if not apply_deletes:
        return index
    return F.when(F.col("is_delete"), F.concat(F.to_json(F.struct(target.alias("delete"))), F.lit("\n"))).otherwise(index)


class _Packer:
    """The open request of a shard; ``add`` gives the requests that are closed by further rows."""

    def __init__(self, max_bytes: int, max_actions: int):
        self.max_bytes, self.max_actions = max_bytes, max_actions
        self.shard, self.number, self.bodies, self.actions, self.bytes = None, 0, [], 0, 0

    def close(self) -> list[tuple]:
        if not self.actions:
            return []
        out = [(self.shard, self.number, self.actions, self.bytes, "".join(self.bodies))]
        self.number, self.bodies, self.actions, self.bytes = self.number + 1, [], 0, 0
        return out

    def add(self, shard: int, sizes: np.ndarray, lines: pa.Array) -> list[tuple]:
        out = []
        if shard != self.shard:
            out += self.close()
            self.shard, self.number = shard, 0
        total = np.concatenate([[0], np.cumsum(sizes)])
        at, n = 0, len(sizes)
        while at < n:  # as many rows at once as fit
            fits = int(np.searchsorted(total, total[at] + self.max_bytes - self.bytes, "right")) - 1 - at
            fits = min(fits, self.max_actions - self.actions, n - at)
            if fits <= 0:
                if self.actions:
                    out += self.close()
                    continue
                fits = 1  # a document beyond the limit
            self.bodies += lines[at:at + fits].to_pylist()
            self.actions += fits
            self.bytes += int(total[at + fits] - total[at])
            at += fits
        return out


def bulk_requests(docs: DataFrame, max_bytes: int = MAX_BYTES, max_actions: int = MAX_ACTIONS, *, shards: int = DEFAULT_SHARDS,
                  shard: Column | None = None, order: Sequence[str] = ("event_time", "seq"),
                  apply_deletes: bool = True) -> DataFrame:
    """``(shard, request, n_actions, n_bytes, body)`` over routed documents; requests of a shard are numbered from 0.

    ``shard`` replaces the hash of index and id; it must keep the versions of a document together. Rows
    that agree in ``order`` follow each other by their lines.
    """
    if max_bytes < 1 or max_actions < 1 or shards < 1:
        raise ValueError("limits of bulk requests must be positive")
    shard = F.pmod(F.xxhash64("index_name", "doc_id"), F.lit(shards)) if shard is None else shard
    rows = docs.select(shard.cast("int").alias("_shard"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                       action_lines(apply_deletes).alias("_lines"))
    rows = (rows.where(F.col("_lines").isNotNull()).withColumn("_size", F.octet_length("_lines").cast("bigint"))
                .repartition(F.col("_shard")).sortWithinPartitions("_shard", *[f"_o{i}" for i in range(len(order))], "_lines"))

    def task(batches):
        packer = _Packer(max_bytes, max_actions)

        def rows_of(found):
            cols = list(zip(*found))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in REQUESTS.split(", ")])
        for batch in batches:
            of, sizes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b > a and (found := packer.add(int(of[a]), sizes[a:b], batch.column(2)[a:b])):
                    yield rows_of(found)
        if found := packer.close():
            yield rows_of(found)
    return rows.select("_shard", "_size", "_lines").mapInArrow(task, REQUESTS)
