"""Session defaults and the shared scratch folder.

Scratch tables (cut lineage, staged merges, JSON round trips) live under the
cluster's ``spark.checkpoint.dir``, read from the session.  A folder of our
own is set only where the session has none, as in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # created_at is timestamp_ntz, but dates cut from ISO strings and the load
    # stamp are easiest to read in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next operator (the W3 window) then
    # needs its own shuffle: one event's copies may hold a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # REBALANCE before writes: AQE splits big output partitions and merges small ones.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Independent assets run as concurrent jobs; share executors between them.
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, app: str = "forgelake", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a fresh local one only when a local session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current and not (spark.conf.get("spark.master", None) or "local").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
    if not current:
        # Core configs cannot change at runtime; the context's checkpoint dir can.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="forgelake-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the scratch root (never reused, never cleared in place)."""
    return f"{scratch_root(spark)}/forgelake-{uuid.uuid4().hex[:12]}/{name}"
