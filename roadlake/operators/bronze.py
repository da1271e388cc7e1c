"""Bronze: clean headers, stamp the batch date, accumulate batches.

The Bronze store keeps one folder per Bronze day (``bronze_date``).  Days
before the last hold their own batch; the last day holds *every* batch, each
row keeping its own ``situation_date``.  Building that is one pass with an
``explode`` over at most two dates per row, not a union that reads the feed
twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.names import clean_column_name


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all awkward headers in one projection."""
    return df.toDF(*[clean_column_name(n) for n in df.columns])


def stamp_date(df: DataFrame, day: str | date, col: str = "situation_date") -> DataFrame:
    return df.withColumn(col, F.lit(str(day)).cast("date"))


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Running union by column name; strict: differing column sets fail."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=False)
    return out


def bronze_cumulative(batches: DataFrame, last_date: str | date, date_col: str = "situation_date",
                      out_col: str = "bronze_date") -> DataFrame:
    """Rows as stored per Bronze day: own day for every batch, plus the last day for all."""
    last = F.lit(str(last_date)).cast("date")
    days = F.array_distinct(F.array(F.col(date_col), last))
    return batches.withColumn(out_col, F.explode(days))


def pending_batches(batches: DataFrame, loaded_dates: DataFrame, last_date: str | date,
                    date_col: str = "situation_date") -> DataFrame:
    """Rows of batches still to write: days not loaded yet, and always the last day.

    ``loaded_dates`` lists the days already in Bronze.  After ``distinct`` it
    has one row per calendar day, a size that does not grow with the number
    of rows, so it is broadcast: the feed is never shuffled by its few batch
    dates (a hot day would otherwise land in one task).
    """
    last = F.lit(str(last_date)).cast("date")
    skip = loaded_dates.select(date_col).filter(F.col(date_col) != last).distinct()
    return batches.join(F.broadcast(skip), date_col, "left_anti")
