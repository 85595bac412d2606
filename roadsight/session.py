"""Session construction and the shared working folder.

Intermediate tables (exports, round trips, lineage cuts) go to the folder the
cluster names in ``spark.checkpoint.dir``.  A machine-local folder is only
created when that setting is absent *and* the master is local (tests, laptop).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "roadsight", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count then stays whatever the cluster configured.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context).  Only when neither is set and the master is local is a private
    folder created and registered, as tests need.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the server reads the conf
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if root:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster")
    root = tempfile.mkdtemp(prefix="roadsight-ckpt-")
    sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    root = checkpoint_root(spark)
    leaf = "-".join(list(parts) + [uuid.uuid4().hex[:12]])
    if "://" in root:
        return f"{root}/roadsight/{leaf}"
    return os.path.join(root, "roadsight", leaf)


def materialize(df):
    """Cut a lineage that several consumers share: a reliable, eager
    ``checkpoint()`` into the shared checkpoint folder (the checkpointed data
    keeps its hash partitioning, so a following join or window on the same
    keys does not shuffle it again)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_sizing(input_bytes: int, total_cores: int,
                   target_bytes: int = 256 << 20) -> dict[str, str]:
    """Scan and shuffle sizing for one job over ``input_bytes`` of Parquet.

    Scan splits of ~256 MB; shuffle partitions sized so a wide shuffle of the
    whole input lands near the same size per reducer (at least two waves of the
    cores), with AQE coalescing the small aggregate exchanges and splitting
    skewed ones.  E.g. 100 TB on 8,000 cores -> about 373,000 partitions before
    AQE coalescing; pass the result to ``get_session(extra=...)``.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
