"""Session construction and the shared scratch / checkpoint folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
read it from the running session and only pick our own folder when it is
unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Bounds under which a derived side (one row per stock, or per stock and day)
# is broadcast.  They are checked against the materialised row count and the
# measured bytes, never assumed; a session can change them.
BROADCAST_MAX_ROWS = 10_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
BROADCAST_ROWS_CONF = "tradewatch.broadcast.maxRows"
BROADCAST_BYTES_CONF = "tradewatch.broadcast.maxBytes"


def broadcast_max_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_MAX_ROWS)))


def broadcast_max_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(BROADCAST_MAX_BYTES)))


def build_session(master: str = "local[8]", partitions: int = 8, app: str = "tradewatch") -> SparkSession:
    """Session with the settings the plans are written for."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # let the JIT compile large generated methods (wide CASE / parsing
        # expressions) instead of interpreting them
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Runtime SQL settings the plans rely on (safe to call on any session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder: the cluster's checkpoint dir.

    Falls back to a fresh local folder only when the session names none and
    runs in local mode (tests); that folder is also installed as the
    checkpoint dir.  On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not shared by executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS / object store)")
        configured = tempfile.mkdtemp(prefix="tw-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared folder (not created)."""
    root = shared_dir(spark)
    return os.path.join(root, "tradewatch", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize_counted(df: DataFrame, name: str = "materialized") -> tuple[DataFrame, int]:
    """Write ``df`` as a Parquet table in the shared folder; return it read back and its row count.

    One job: the count is observed on the write itself.  Cuts lineage (later
    stages never recompute it, even after an executor loss).  A reliable
    ``checkpoint()`` would compute the plan twice (once for the action, once
    for writing the checkpoint) unless cached first.
    """
    table, rows, _ = materialize_measured(df, name, F.lit(0))
    return table, rows


def materialize_measured(df: DataFrame, name: str, measure: Column) -> tuple[DataFrame, int, int]:
    """``materialize_counted`` that also sums ``measure`` over the rows, on the same write."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    figures = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(measure), F.lit(0)).alias("measure")]
    df.observe(obs, *figures).write.mode("overwrite").parquet(path)
    # the schema is known: reading back skips footer-based schema discovery
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"]), int(obs.get["measure"])
