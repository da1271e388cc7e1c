"""Table profiling: row counts, NULL counts, schema listing, samples.

A NULL profile is *one* aggregation per table (a ``count_if`` per column,
then an ``unpivot`` to rows), not one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.columns import c


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
                   for name, df in tables.items()])


def _column_stats(name: str, df: DataFrame) -> DataFrame:
    """One row per column: table_name, position, column_name, data_type, null_count, n_rows.

    A single aggregation builds one struct per column; ``unpivot`` turns
    them into rows.
    """
    slots = [f"c{i}" for i in range(len(df.columns))]
    per_column = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.count_if(c(f.name).isNull()).alias("null_count")).alias(slot)
        for i, (f, slot) in enumerate(zip(df.schema.fields, slots))]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *per_column)
    long = wide.unpivot("n_rows", slots, "slot", "s")
    return long.select(F.lit(name).alias("table_name"), "s.*", "n_rows")


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, null_count) for every column of every table."""
    return _union([_column_stats(n, df).select("table_name", "column_name", "null_count")
                   for n, df in tables.items()])


def schema_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Listing of tables and columns with their Spark type, position and fill.

    Rows: table_name, position (1-based), column_name, data_type, n_rows,
    non_null.  Computed in the same single pass as the NULL profile.
    """
    return _union([_column_stats(n, df).select(
        "table_name", "position", "column_name", "data_type", "n_rows",
        (F.col("n_rows") - F.col("null_count")).alias("non_null")) for n, df in tables.items()])


def sample_rows(df: DataFrame, key: str = "ID", n: int = 5) -> DataFrame:
    """First ``n`` rows by key (a top-k, not a full sort)."""
    return df.orderBy(c(key)).limit(n)
