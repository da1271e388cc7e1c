"""Parquet stores: Bronze by day, and plain overwrite/read-back.

Bronze is partitioned by ``bronze_date`` (``bronze_date=YYYY-MM-DD`` folders),
so a read of one day prunes every other folder, and rewriting one day uses
dynamic partition overwrite instead of replacing the whole store.  Writes
are whole-file commits through Spark's output committer: a lost executor's
task is retried and no half-written file becomes visible.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.sources import versions

BRONZE_PARTITION = "bronze_date"


def published(spark: SparkSession, path: str) -> tuple[str, str, dict] | None:
    """(folder, table, manifest) if ``path`` is a table of a folder published by versions, else None."""
    root, _, name = path.rstrip("/").rpartition("/")
    manifest = versions.latest(spark, root) if root else None
    return (root, name, manifest) if manifest and name in manifest["tables"] else None


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_bronze(df: DataFrame, path: str, partition_col: str = BRONZE_PARTITION) -> str:
    """Write (or rewrite) the Bronze days present in ``df``; other days are kept."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col)
     .parquet(path))
    return path


def read_bronze(spark: SparkSession, path: str, day: str | date | None = None,
                partition_col: str = BRONZE_PARTITION) -> DataFrame:
    """All of Bronze, or one day of it (partition-pruned).

    The days' schemas are merged: a column that some days lack is NULL there.
    Of a published table it is the newest version.
    """
    if found := published(spark, path):
        root, name, manifest = found
        return versions.read_table(spark, root, name, manifest, None if day is None else str(day))
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if day is not None:
        df = df.filter(F.col(partition_col) == F.lit(str(day)).cast("date"))
    return df


def loaded_days(spark: SparkSession, path: str, partition_col: str = BRONZE_PARTITION) -> DataFrame:
    """Days already in a day-partitioned store (one row per day), from its file listing alone; a folder without files has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if partition_col not in files.columns and files.select("path").isEmpty():
        return spark.createDataFrame([], f"{partition_col} date")
    return files.select(F.col(partition_col).cast("date").alias(partition_col)).distinct()


def existing_days(spark: SparkSession, path: str, partition_col: str = BRONZE_PARTITION) -> list[str]:
    """The same as sorted text; a store that does not exist yet has none."""
    if found := published(spark, path):
        return sorted(found[2]["tables"][found[1]]["days"])
    try:
        return sorted(str(r[0]) for r in loaded_days(spark, path, partition_col).collect())  # one row per day
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
