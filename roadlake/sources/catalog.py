"""Catalog tables: reset a schema, append to and scan tables, snapshot them.

Tables are parquet tables with an explicit location, so column pruning and
predicate pushdown reach the files, and any Spark catalog can hold them.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def reset_schema(spark: SparkSession, schema: str, tables: Iterable[str], location: str | None = None) -> None:
    """Create the schema if absent and drop the given tables (data of managed tables goes with them)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{where}")
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{t}`")


def location_of(spark: SparkSession, table: str) -> str | None:
    """Where an existing table's files are; None for no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Location").collect()
    return rows[0].data_type if rows else None


def check_location(spark: SparkSession, table: str, path: str) -> None:
    """Refuse a table that exists and is stored anywhere but in ``path``."""
    known = location_of(spark, table)
    if known is None:
        return
    probe = f"{table.rstrip('`')}_{uuid.uuid4().hex[:8]}" + "`" * table.endswith("`")
    spark.sql(f"CREATE TABLE {probe} (x INT) USING parquet LOCATION '{path}'")  # how the catalog spells the path
    here = location_of(spark, probe)
    spark.sql(f"DROP TABLE {probe}")
    if here.rstrip("/") != known.rstrip("/"):
        raise ValueError(f"{table} is stored in {known}, not in {here}: use another schema name")


def register_parquet(spark: SparkSession, table: str, path: str) -> None:
    """Define ``table`` over the day-partitioned parquet files in ``path``, with the columns and days they have now."""
    check_location(spark, table, path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay
    spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.recoverPartitions(table)


def register_days(spark: SparkSession, table: str, path: str, schema, folders: Mapping[str, str],
                  partition_col: str = "bronze_date") -> None:
    """Define ``table`` over day folders that lie anywhere; ``path`` is where the table says it is stored."""
    check_location(spark, table, path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{partition_col}`) LOCATION '{path}'")
    if folders:
        parts = " ".join(f"PARTITION (`{partition_col}` = DATE'{d}') LOCATION '{f}'" for d, f in sorted(folders.items()))
        spark.sql(f"ALTER TABLE {table} ADD {parts}")


def append_table(df: DataFrame, table: str, path: str | None = None) -> str:
    """Append rows to a catalog table (created on first use); duplicates are kept."""
    writer = df.write.mode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> str:
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def table_scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def table_listing(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema (namespace, tableName); session temp views are left out."""
    return spark.sql(f"SHOW TABLES IN `{schema}`").filter(~F.col("isTemporary")).drop("isTemporary")


def snapshot_tables(spark: SparkSession, tables: Mapping[str, str | DataFrame], root: str) -> dict[str, str]:
    """Copy each catalog table (or frame) to ``root/<name>`` as parquet.

    One failing table does not stop the others; the result maps each name to
    its path, or to ``"error: ..."``.
    """
    done: dict[str, str] = {}
    for name, table in tables.items():
        target = f"{root.rstrip('/')}/{name}"
        try:
            (table if isinstance(table, DataFrame) else spark.table(table)).write.mode("overwrite").parquet(target)
            done[name] = target
        except Exception as exc:  # noqa: BLE001 - per-table isolation is the contract
            log.error("snapshot of %s failed: %s", table, exc)
            done[name] = f"error: {exc}"
    return done
