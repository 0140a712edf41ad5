"""Latest document per (index, document id): the index upsert as a table.

Versions are ordered by event time, then arrival time, then commit number,
then source file and position in it. The original job knew arrival only; here
two versions with one event time fall back to it. The document text breaks
what is left, so the winner is deterministic.

``reduce_documents`` is a ``max`` aggregation, which Spark runs with a
map-side partial step, so a document id holding a third of all rows is
combined inside each input task before the shuffle.

The state table is a levelled store of immutable runs::

    <path>/data/part=<name>/index_name=<index>/*.parquet              deltas: one reduced batch each
    <path>/data/part=<name>/bucket=<b>/index_name=<index>/*.parquet   merged runs, a hash bucket each
    <path>/filter/part=<name>/bucket=<b>/*.parquet                    Bloom filters of merged runs
    <path>/log/<number>.json                                          commits

A batch is reduced and written as a new delta of its own size; nothing that
exists is touched. One new log file then names the deltas and runs that make
the state, with their rows and key ranges, and the batches in them. Readers use
the newest log file, so a run that dies before its commit leaves the state as
it was, and a replayed batch is known by its id and adds nothing.

Merging keeps reads cheap and its own cost low. ``compact_every`` deltas become
one run per hash bucket; in a bucket, ``compact_every`` runs of like size (equal
logarithm of their rows) become one. A row is therefore rewritten once per
tier, a number that grows with the logarithm of the batches. What an append
merges is bounded by a budget that follows the batch: merges of large tiers wait
their turn, bucket by bucket, in later appends.

A lookup by document id opens only what can hold the id: the deltas and the
runs of its bucket whose key range covers it and whose Bloom filter has all its
bits. A filter is a Parquet table of 4,096-byte segments, so a test reads a few
segments however large the run is.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc", "is_delete", "operation", "event_time", "arrival_time", "source", "seq")
VERSION_ORDER = ("event_time", "arrival_time", "commit_no", "source", "seq")
PART_SCHEMA = ("doc_id string, doc string, is_delete boolean, operation string, event_time timestamp, "
               "arrival_time timestamp, source string, seq bigint, commit_no bigint, n_versions bigint, "
               "part string, index_name string")
# Deltas, or runs of like size in one bucket, that are merged.
DEFAULT_COMPACT_EVERY = 8
# Hash buckets of a state that sets none; a bucket of the whole state is merged by a few tasks.
DEFAULT_BUCKETS = 16
# Rows an append may merge, in rows of a full set of its deltas.
MERGE_BUDGET = 4
# Bloom filters: bits per row and bits tested per key (a false hit in about 1 of 100 tests).
FILTER_BITS, FILTER_TESTS = 10, 4
SEGMENT_BITS = 8 * 4096


def _with_defaults(docs: DataFrame) -> DataFrame:
    """The version columns, with nulls for those a source does not give."""
    types = dict(f.strip().split(" ") for f in PART_SCHEMA.split(","))
    missing = {c: F.lit(None).cast(types[c]) for c in (*DOCUMENT_COLUMNS, "commit_no") if c not in docs.columns}
    if "n_versions" not in docs.columns:
        missing["n_versions"] = F.lit(1).cast("long")
    return docs.withColumns(missing) if missing else docs


def reduce_documents(docs: DataFrame, order: Sequence[str] = VERSION_ORDER) -> DataFrame:
    """One row per ``(index_name, doc_id)``: the latest version, tombstones kept."""
    docs = _with_defaults(docs)
    columns = (*DOCUMENT_COLUMNS, "commit_no")
    # one struct both ranks and carries a version, so its document is sorted and shuffled once
    version = F.struct(*dict.fromkeys((*order, "doc", *columns)))
    return (docs.select("index_name", "doc_id", version.alias("_v"), "n_versions")
                .groupBy("index_name", "doc_id")
                .agg(F.max("_v").alias("_w"), F.sum("n_versions").alias("n_versions"))
                .select("index_name", "doc_id", *[f"_w.{c}" for c in columns], "n_versions"))


def latest_documents(docs: DataFrame, apply_deletes: bool = True,
                     order: Sequence[str] = VERSION_ORDER) -> DataFrame:
    """Current documents. With ``apply_deletes`` a row whose latest version is a
    delete disappears; without it the delete is indexed like any other
    version (the original behaviour)."""
    state = reduce_documents(docs, order)
    return state.where(~F.col("is_delete")) if apply_deletes else state


class StateStore:
    """A document state table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS):
        """``buckets`` counts when the state is new; later it is read from the commit."""
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    # --- commit log ---------------------------------------------------------------------

    def _log_numbers(self) -> list[int]:
        folder = self._path(f"{self.path}/log")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read_log(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/log/{number}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def snapshot(self) -> dict:
        """Newest commit: ``number``, ``parts``, ``runs``, ``buckets`` and per source the last batch in the state."""
        numbers = self._log_numbers()
        empty = {"number": 0, "parts": [], "runs": [], "buckets": self.buckets, "batches": {}, "rows_rewritten": 0}
        return empty | (self._read_log(numbers[-1]) if numbers else {})

    def _publish(self, now: dict, runs: list[dict], rewritten: int = 0, **changes) -> dict:
        entry = now | changes | {"number": now["number"] + 1, "runs": runs, "parts": sorted({r["part"] for r in runs}),
                                 "rows_rewritten": now["rows_rewritten"] + rewritten}
        self._commit(entry)
        return entry

    def _commit(self, entry: dict) -> None:
        """Publish a log file under its number; fails if another writer took it."""
        target = f"{self.path}/log/{entry['number']}.json"
        temporary = self._path(f"{self.path}/log/_{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        try:
            out.write(json.dumps(entry).encode())
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            temporary.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()).toUri(),
            self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        qualified = [p.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory())
                     for p in (temporary, self._path(target))]
        context.rename(*qualified, none)  # an atomic move that refuses an existing target

    # --- runs ---------------------------------------------------------------------------

    def _bucket(self, buckets: int) -> F.Column:
        return F.pmod(F.xxhash64("index_name", "doc_id"), F.lit(buckets)).cast("int").alias("bucket")

    def _write_part(self, reduced: DataFrame, name: str, buckets: int = 0) -> list[dict]:
        """Write a delta, or with ``buckets`` a part of one run per bucket; gives the runs as written."""
        part = f"{name}-{uuid.uuid4().hex[:12]}"
        columns = [f.strip().split(" ")[0] for f in PART_SCHEMA.split(",")][:-2]
        folders = ["bucket", "index_name"] if buckets else ["index_name"]
        out = reduced.select("index_name", *columns, *([self._bucket(buckets)] if buckets else []))
        if buckets:
            # few folders a part, many documents a folder: split by what adaptive execution measures; sorted, so
            # that row groups of a file have narrow key ranges. A delta is written as it was reduced, without
            # another shuffle: its files are small and soon merged
            out = out.hint("rebalance", *map(F.col, folders)).sortWithinPartitions(*folders, "doc_id")
        out.write.partitionBy(*folders).parquet(f"{self.path}/data/part={part}")
        written = self._files([f"part={part}"], bool(buckets))
        keys = written.groupBy("bucket").agg(  # a row per bucket
            F.count(F.lit(1)).alias("rows"), F.min(F.struct("index_name", "doc_id")).alias("lo"),
            F.max(F.struct("index_name", "doc_id")).alias("hi")).collect()
        return sorted(({"part": part, "bucket": r["bucket"], "rows": r["rows"], "lo": list(r["lo"]), "hi": list(r["hi"])}
                       for r in keys), key=lambda r: r["bucket"] or 0)

    def _scan(self, runs: list[dict]) -> DataFrame:
        """All rows of the runs, with their bucket (null for deltas)."""
        deltas = [f"part={r['part']}" for r in runs if r["bucket"] is None]
        merged = [f"part={r['part']}/bucket={r['bucket']}" for r in runs if r["bucket"] is not None]
        frames = [self._files(folders, bucketed) for folders, bucketed in ((deltas, False), (merged, True)) if folders]
        if not frames:
            return self.spark.createDataFrame([], PART_SCHEMA + ", bucket int").drop("part")
        return reduce(DataFrame.unionByName, frames)

    def _files(self, folders: list[str], bucketed: bool) -> DataFrame:
        df = (self.spark.read.schema(PART_SCHEMA + (", bucket int" if bucketed else "")).option("basePath", f"{self.path}/data")
                  .parquet(*[f"{self.path}/data/{f}" for f in folders])).drop("part")
        return df if bucketed else df.withColumn("bucket", F.lit(None).cast("int"))

    def _write_filter(self, runs: list[dict]) -> None:
        """Bloom filters of the runs of one part; their size in bits goes into the runs."""
        bits = max(SEGMENT_BITS, 1 << math.ceil(math.log2(FILTER_BITS * max(r["rows"] for r in runs))))
        bit = F.explode(F.array(*[self._filter_bit(i, F.lit(bits)) for i in range(FILTER_TESTS)]))
        (self._scan(runs).select("bucket", bit.alias("bit"))
             .groupBy("bucket", F.expr("bitmap_bucket_number(bit)").alias("segment"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
             .hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "segment")
             .write.partitionBy("bucket").parquet(f"{self.path}/filter/part={runs[0]['part']}"))
        for r in runs:
            r["filter_bits"] = bits

    @staticmethod
    def _filter_bit(test: int, bits: F.Column) -> F.Column:
        """Place of a key's bit, counted from 1."""
        return F.pmod(F.xxhash64(F.lit(test), "doc_id", "index_name"), bits) + 1

    def versions(self, snapshot: dict | None = None) -> DataFrame:
        """All versions the state is made of: one row per document and run."""
        return self._scan((snapshot or self.snapshot())["runs"]).drop("bucket")

    # --- operations ---------------------------------------------------------------------

    def append(self, docs: DataFrame, source: str, batch_id: int, compact_every: int = DEFAULT_COMPACT_EVERY,
               merge_rows: int | None = None) -> bool:
        """Add one batch of routed documents; False if it is in the state already.

        Work and bytes written follow the batch, not the state. ``source``
        names a stream of batches whose ids only rise. ``merge_rows`` bounds
        the rows merged afterwards (the smallest merge that is due always runs).
        """
        now = self.snapshot()
        if batch_id <= now["batches"].get(source, -1):
            return False
        number = now["number"] + 1
        runs = self._write_part(reduce_documents(docs.withColumn("commit_no", F.lit(number).cast("long"))), f"delta-{number}")
        now = self._publish(now, now["runs"] + runs, batches={**now["batches"], source: batch_id})
        if compact_every > 1:
            deltas = [r["rows"] for r in now["runs"] if r["bucket"] is None]
            budget = MERGE_BUDGET * compact_every * max(deltas, default=0) if merge_rows is None else merge_rows
            self.merge_due(compact_every, budget)
        return True

    def due(self, fan_in: int, snapshot: dict | None = None) -> list[list[dict]]:
        """Sets of runs to merge, smallest first: all deltas, or runs of like size of one bucket."""
        runs = (snapshot or self.snapshot())["runs"]
        groups: dict[tuple, list[dict]] = {}
        for r in runs:
            # like size: an equal logarithm of the rows; deltas have all buckets in them
            tier = None if r["bucket"] is None else int(math.log(max(r["rows"], 1), fan_in) + 1e-9)
            groups.setdefault((r["bucket"], tier), []).append(r)
        return sorted((g for g in groups.values() if len(g) >= fan_in), key=lambda g: sum(r["rows"] for r in g))

    def merge_due(self, fan_in: int, budget: int | None = None) -> int:
        """Merge what is due within ``budget`` rows (all if ``None``), in one job; gives the rows read."""
        now = self.snapshot()
        chosen, rows = [], 0
        for group in self.due(fan_in, now):
            size = sum(r["rows"] for r in group)
            if chosen and budget is not None and rows + size > budget:
                break
            chosen += group
            rows += size
        if chosen:
            self._merge(now, chosen, "run")
        return rows

    def _merge(self, now: dict, chosen: list[dict], name: str) -> None:
        merged = self._write_part(reduce_documents(self._scan(chosen)), f"{name}-{now['number'] + 1}", now["buckets"])
        if merged:
            self._write_filter(merged)
        left = [r for r in now["runs"] if r not in chosen]
        self._publish(now, left + merged, sum(r["rows"] for r in merged))

    def compact(self) -> None:
        """Reduce all runs to one per bucket; what readers see does not change."""
        now = self.snapshot()
        if len(now["parts"]) > 1:
            self._merge(now, now["runs"], "base")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete parts, and buckets of parts, that none of the ``keep`` newest commits names. Run it while nothing writes."""
        used = {(r["part"], r["bucket"]) for n in self._log_numbers()[-keep:] for r in self._read_log(n)["runs"]}
        parts, gone = {p for p, _ in used}, []
        for tree in ("data", "filter"):
            folder = self._path(f"{self.path}/{tree}")
            for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
                name = status.getPath().getName().removeprefix("part=")
                if name not in parts:
                    self._fs.delete(status.getPath(), True)
                    gone += [name] if tree == "data" else []
                    continue
                for inner in self._fs.listStatus(status.getPath()):
                    bucket = inner.getPath().getName().removeprefix("bucket=")
                    if bucket.isdigit() and (name, int(bucket)) not in used:
                        self._fs.delete(inner.getPath(), True)
                        gone += [f"{name}/bucket={bucket}"] if tree == "data" else []
        return gone

    def read(self, index_name: str | None = None, apply_deletes: bool = True) -> DataFrame:
        """Documents of one index (all when ``None``): a partition-pruned scan, then one reduction; after a
        full compaction no two runs share a key and the scan is the answer."""
        now = self.snapshot()
        df = self.versions(now)
        if index_name is not None:
            df = df.where(F.col("index_name") == F.lit(index_name))
        buckets = [r["bucket"] for r in now["runs"]]
        if None not in buckets and len(set(buckets)) == len(buckets):
            out = df.select("index_name", "doc_id", *DOCUMENT_COLUMNS, "commit_no", "n_versions")
            return out.where(~F.col("is_delete")) if apply_deletes else out
        return latest_documents(df, apply_deletes)

    def runs_for(self, index_name: str, doc_ids: Sequence[str]) -> list[dict]:
        """The runs that can hold any of the documents."""
        now = self.snapshot()
        keys = self.spark.createDataFrame([(index_name, d) for d in doc_ids], "index_name string, doc_id string")
        sizes = sorted({r["filter_bits"] for r in now["runs"] if r.get("filter_bits")})
        places = keys.select("doc_id", self._bucket(now["buckets"]), *[
            F.array(*[self._filter_bit(i, F.lit(n)) for i in range(FILTER_TESTS)]).alias(f"bits_{n}") for n in sizes]).collect()
        found, tests = [], []
        for n, r in enumerate(now["runs"]):
            ids = [k for k in places if r["bucket"] in (None, k["bucket"]) and r["lo"] <= [index_name, k["doc_id"]] <= r["hi"]]
            if not r.get("filter_bits"):
                found += [n] if ids else []
                continue
            tests += [(n, r, k["doc_id"], bit) for k in ids for bit in k[f"bits_{r['filter_bits']}"]]
        if tests:  # the segments these bits lie in, and nothing else of the filters
            wanted = sorted({(r["part"], r["bucket"], (bit - 1) // SEGMENT_BITS + 1) for _, r, _, bit in tests})
            folders = sorted({f"{self.path}/filter/part={p}/bucket={b}" for p, b, _ in wanted})
            rows = (self.spark.read.schema("segment bigint, bits binary, part string, bucket int")
                        .option("basePath", f"{self.path}/filter").parquet(*folders)
                        .where(F.col("segment").isin(sorted({s for _, _, s in wanted}))))
            bits = [(r["part"], r["bucket"], (bit - 1) // SEGMENT_BITS + 1, (bit - 1) % SEGMENT_BITS, n, doc_id)
                    for n, r, doc_id, bit in tests]
            asked = self.spark.createDataFrame(bits, "part string, bucket int, segment bigint, place int, n int, doc_id string")
            # bit i of a segment is bit i % 8 of its byte i / 8
            byte = F.conv(F.hex(F.expr("substring(bits, cast(place div 8 as int) + 1, 1)")), 16, 10).cast("int")
            hit = F.expr("cast(pow(2, place % 8) as int)").bitwiseAND(byte) != 0
            held = (asked.join(rows, ["part", "bucket", "segment"], "left")
                         .groupBy("n", "doc_id").agg(F.min(F.coalesce(hit, F.lit(False))).alias("all"))
                         .where("all").select("n").distinct().collect())
            found += [r["n"] for r in held]
        return [now["runs"][n] for n in sorted(found)]

    def lookup(self, index_name: str, doc_ids: Sequence[str], apply_deletes: bool = True) -> DataFrame:
        """The named documents, read from the runs that can hold them only (see :meth:`runs_for`)."""
        rows = self._scan(self.runs_for(index_name, doc_ids)).drop("bucket")
        return latest_documents(rows.where((F.col("index_name") == F.lit(index_name)) & F.col("doc_id").isin(list(doc_ids))),
                                apply_deletes)


def read_index(spark: SparkSession, state_path: str, index_name: str | None = None,
               apply_deletes: bool = True, doc_ids: Sequence[str] | None = None) -> DataFrame:
    """Documents of the state table at ``state_path`` (see :class:`StateStore`); with ``doc_ids`` those of one
    index, from the few runs that can hold them."""
    store = StateStore(spark, state_path)
    if doc_ids is not None:
        if index_name is None:
            raise ValueError("a lookup by document id needs index_name")
        return store.lookup(index_name, doc_ids, apply_deletes)
    return store.read(index_name, apply_deletes)
