"""Session helpers: scale-aware defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only where the deployer has not set a value already.
SCALE_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Partition overwrite mode is passed per write (dynamic for trip_data and the
# live tables), never changed session-wide.


def build_session(master: str | None = None, app_name: str = "tripdemand",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library's defaults.

    Local runs (tests, bench) pass ``master``; on a cluster the deployer's
    ``spark-submit`` settings win and only unset keys get a default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


# Cluster-only defaults (a non-local master), again only where unset: start
# shuffles wide and let AQE coalesce to ~128 MB partitions, so the partial
# aggregates of a 100 TB scan never spill into a few huge reducers; read
# 256 MB splits to halve the task count of the text scans.
CLUSTER_DEFAULTS = {
    # key: (values meaning "left at Spark's default", our value)
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": ((None, ""), "4096"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": (("64MB", "67108864b", "67108864"),
                                                        str(128 * 1024 * 1024)),
    "spark.sql.files.maxPartitionBytes": (("128MB", "134217728b", "134217728"),
                                          str(256 * 1024 * 1024)),
}


def context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (no JVM context)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect: sparkContext is not available
        return None


def session_key(spark: SparkSession) -> tuple:
    """Identifies a live session, for per-session caches of lazy DataFrames."""
    sc = context(spark)
    return (sc.applicationId if sc is not None else spark.conf.get("spark.app.id", ""), id(spark))


def apply_defaults(spark: SparkSession) -> None:
    for key, value in SCALE_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    sc = context(spark)
    if sc is not None and not sc.master.startswith("local"):
        submitted = sc.getConf()
        for key, (untouched, value) in CLUSTER_DEFAULTS.items():
            if not submitted.contains(key) and spark.conf.get(key, None) in untouched:
                spark.conf.set(key, value)
    # UTC unless the deployer chose a zone: date_format / hour on timestamps
    # must not shift with the machine's zone (a DST gap would move trips
    # between blocks).
    if sc is None or not sc.getConf().contains("spark.sql.session.timeZone"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables, stream checkpoints and lineage cuts.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set -- local tests -- a fresh
    local folder is created and registered as the checkpoint dir.
    """
    sc = context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current and sc is not None:
            current = sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
        else:
            spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used path under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
