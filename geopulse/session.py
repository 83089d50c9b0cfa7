"""Session helpers: recommended configuration and shared scratch space.

Scratch space (stream checkpoints, replay landing zones, lake output written
by the registered queries) always lives under the cluster's shared
``spark.checkpoint.dir``.  A directory of our own is set only when the session
has none, as happens in local tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library is written for.  Shuffle partitions are
# left to the caller (cluster size); AQE coalesces small ones at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # each micro-batch checkpoints only the state changes, not full snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "geopulse", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's recommended settings."""
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Time columns are wall-clock UTC throughout; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def isolated_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same application with settings of its own.

    It starts with those of ``spark``, which keeps its own: what a streaming query needs
    (partition count, state store) does not change what other queries run under."""
    child = spark.newSession()
    for k, v in {**dict(spark.conf.getAll), **settings}.items():
        if child.conf.isModifiable(k):
            child.conf.set(k, v)
    return child


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set to a fresh local folder only when the session has none (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="geopulse-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001
            pass
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect session
        return int(spark.conf.get("spark.default.parallelism", str(fallback)))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused sub-folder of the checkpoint root for one run."""
    root = checkpoint_root(spark)
    return root.rstrip("/") + f"/geopulse/{label}-{uuid.uuid4().hex[:12]}"

