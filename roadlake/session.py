"""Session helpers.

The library never creates or stops the caller's session; ``local_session`` is
for tests, the bench and the entry point only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "roadlake") -> SparkSession:
    """A local session configured like the cluster defaults we rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Read from the session; only when nothing is configured on a local master
    (as in tests) is a private folder set, since on a cluster each machine
    would see its own.  On a Spark Connect session (no ``sparkContext``) the
    server's ``spark.checkpoint.dir`` is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return spark.conf.get(_CHECKPOINT_KEY, None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir to one that all executors see")
        configured = tempfile.mkdtemp(prefix="roadlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH = f"roadlake_scratch_{uuid.uuid4().hex[:12]}"


def scratch_schema(spark: SparkSession) -> str:
    """This process's schema of scratch tables; its files are in the shared folder."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_SCRATCH} LOCATION '{scratch_path(spark, 'tables')}'")
    return _SCRATCH


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables made so far; frames that read them end here."""
    spark.sql(f"DROP SCHEMA IF EXISTS {_SCRATCH} CASCADE")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read that.

    Used where one frame feeds several passes: each later pass reads just its
    own columns of the stored copy, filters reach its files, and a lost
    executor costs a re-read, not a recomputation.  ``drop_scratch`` deletes
    the copies.
    """
    spark = df.sparkSession
    table = f"{scratch_schema(spark)}.t_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").saveAsTable(table)
    return spark.table(table)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder.

    Used for written intermediate tables (Bronze, Silver snapshots, ...) in the
    registered queries, so every run writes to its own folder and reruns after
    a lost executor never see a half-written sibling.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir on the cluster")
    return f"{base}/roadlake/{name}-{uuid.uuid4().hex[:12]}"


def sf_table(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
