"""KPI answers over the Gold marts.

The marts are small (one row per group), so these are cheap; still, every
result is a distributed aggregate and top-k (``TakeOrderedAndProject``), no
driver-side pandas.  Ties at a top-k cut break on the group keys ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.columns import region_label


def _total(name: str = "accidents"):
    return F.sum("accident_count").alias(name)


def kpi_global(by_region: DataFrame) -> DataFrame:
    """Total accidents and the unweighted mean of the group means."""
    return by_region.agg(_total("total_accidents"), F.avg("avg_severity").alias("avg_severity"))


def kpi_global_weighted(by_region: DataFrame) -> DataFrame:
    """Extension: mean severity weighted by accident counts."""
    return by_region.agg(
        _total("total_accidents"),
        (F.sum(F.col("accident_count") * F.col("avg_severity")) / F.sum("accident_count"))
        .alias("weighted_avg_severity"))


def _top(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    ranked = df.groupBy(*keys).agg(_total())
    return ranked.orderBy(F.desc("accidents"), *[F.asc(x) for x in keys]).limit(k)


def kpi_top_regions(by_region: DataFrame, k: int = 5) -> DataFrame:
    return _top(by_region, ["State", "County"], k)


def kpi_top_cities(by_region: DataFrame, k: int = 5) -> DataFrame:
    """By ``City`` alone: same-named cities of different states merge."""
    return _top(by_region, ["City"], k)


def kpi_region_labels(by_region: DataFrame, k: int = 5) -> DataFrame:
    top = kpi_top_regions(by_region, k)
    return top.select(region_label(F.col("State"), F.col("County")).alias("Region"), "accidents")


def kpi_by_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.groupBy("hour").agg(_total()).orderBy("hour")


def kpi_by_severity(by_hour: DataFrame) -> DataFrame:
    return by_hour.groupBy("Severity").agg(_total()).orderBy("Severity")


def kpi_by_weather(by_weather: DataFrame, k: int = 10) -> DataFrame:
    return _top(by_weather, ["Weather_Condition"], k)


def kpi_max_hour(by_hour: DataFrame) -> DataFrame:
    """The busiest hour; on a tie the earliest hour wins."""
    return (by_hour.groupBy("hour").agg(_total())
            .orderBy(F.desc("accidents"), F.asc("hour")).limit(1)
            .select(F.col("hour").alias("max_hour"), "accidents"))
