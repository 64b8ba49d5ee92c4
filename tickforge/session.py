"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: instants are UTC, ANSI casts are strict (so
# ``try_cast`` is the only lenient path), and AQE may re-plan joins at runtime
# (coalescing small shuffles, splitting skewed partitions, demoting shuffled
# joins to broadcast once the real size is known).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A join deals its sides out by all of its keys; keep_buckets() changes that for a session.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of any width reach Python workers in batches of bounded memory.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.ui.enabled": "false",
    # Checkpoint files go when nothing refers to their rows any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tickforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def keep_buckets(spark: SparkSession) -> None:
    """Let joins on more columns than a table is bucketed by read it in its buckets instead of
    shuffling it.  For sessions that read bucketed candles; it holds for every join of the session
    whose side is already dealt out by some of the keys, so leave it off where such keys are skewed."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged files.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Only when it is unset -- local tests -- a private temp
    folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):     # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local "
                               "temp folder is only used in local mode")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickforge-ckpt-"))
        return sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "staging", f"{name}-{uuid.uuid4().hex[:12]}")
    return path
