"""Session construction and shared-folder helpers.

Library code never creates its own session: every entry point takes a
``SparkSession``.  ``build_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE sizes post-shuffle partitions from runtime statistics toward this
    # target and splits skewed ones, so one setting holds from sf0.1 to 100 TB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # no broadcast from plan-time size estimates (a compressed file size says
    # little about the in-memory size): a side is broadcast only behind a
    # counted bound (operators.joins) or when AQE has *measured* its shuffle
    # output below the runtime threshold; everything else sort-merge joins
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; the
    # typed CSV projection (29 decimal casts + timestamp parse + reject rule)
    # fused with its filter exceeds that, so fall back to per-operator
    # codegen there instead of running one interpreted method
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "foehn",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - no classic context (e.g. Spark Connect)
        return None


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.  Only when the session names none
    (local runs, tests) a fresh scratch folder is created and set."""
    root = checkpoint_root(spark)
    if root is None:
        sc = _context(spark)
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("name a shared folder in spark.checkpoint.dir: executors can't see a local one")
        root = tempfile.mkdtemp(prefix="foehn-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - static in some deployments
            pass
    sc = _context(spark)
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (never machine-local
    on a cluster, because the folder comes from the session)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "foehn", f"{name}-{uuid.uuid4().hex[:12]}")
