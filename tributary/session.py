"""Session settings the operators rely on, and the shared folder for side tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every entry point applies. They are session-scoped SQL
# confs, so they can be set on a session someone else built.
RUNTIME_CONF = {
    # Event times are instants; render and bucket them in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Envelope keys must win over row columns of the same name in documents,
    # and duplicate JSON keys keep the last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tributary", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests, benches and local runs.

    On a cluster, ``master`` stays ``None`` and the submitter's settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is used as is. Only when it is unset (local runs and
    tests) a private folder is made and registered, so lineage cuts and side
    tables always land where every executor can read them.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every executor shares "
                               "(HDFS or an object store); lineage cuts and side tables are written there")
        # local runs and tests only: a private folder on this machine
        root = tempfile.mkdtemp(prefix="tributary-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` URIs (used by tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return path if os.path.isabs(path) else None
