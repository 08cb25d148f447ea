"""Session helpers: the settings the engine relies on, and the shared store root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans.  ANSI must stay on: the decimal forms in
# functions/money.py rely on overflow raising instead of silently becoming NULL.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerloom", extra: dict | None = None) -> SparkSession:
    """A session for tests, benches and local runs (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # A store has many small leaves here: listing them is quicker on the driver than as a job.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "10000")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def attached_session(app_name: str = "ledgerloom") -> SparkSession:
    """The session that the launcher configured: master, memory and partitions are its business.

    Raises when a setting that results depend on is off.
    """
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: the decimal forms rely on overflow being an error")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (read from the session).

    On a cluster the operator sets it to a shared file system (HDFS, a mounted
    volume) and an unset value is an error: a machine-local folder would lose
    data with its executor.  Only a local master (tests, a laptop) gets a fresh
    folder of its own, registered with the context so that
    ``DataFrame.checkpoint()`` uses the same place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for the table store")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/ledgerloom/{label}-{uuid.uuid4().hex[:12]}"
