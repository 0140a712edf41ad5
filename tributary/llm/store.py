"""Written intermediate tables in the shared folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.session import scratch_path


# Files of a compact table per core of the cluster, at most.
FILES_PER_CORE = 4


def written(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write once, read back: cuts the lineage and survives lost executors.

    ``compact`` merges the last stage's partitions, never splits them, to a few
    per core of the cluster: for narrow tables that loops read again and again.

    The folder is a fresh one under the session's checkpoint folder and stays
    until that folder is cleaned, since the returned plan reads it lazily.
    """
    spark = df.sparkSession
    if compact:
        df = df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(name: str, df: DataFrame) -> str:
    """The name, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
