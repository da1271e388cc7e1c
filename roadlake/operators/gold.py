"""Gold marts over silver.accidents (and one over accidents x weather).

All three published marts roll up from one base aggregate (place, severity, day
and hour), so the per-incident rows are read once.  Each mart is a single hash aggregation: partial aggregation on the map side,
one shuffle by the group keys, final aggregation.  A hot group costs nothing
extra because the partial step folds it before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions.columns import c, date_of, hour_label, hour_of, severity_int


def _measures(severity):
    return [F.count(c("ID")).alias("accident_count"), F.avg(severity).alias("avg_severity")]


def mart_by_region(accidents: DataFrame) -> DataFrame:
    """State, County, City, Severity (text), day -> count, mean severity."""
    return (accidents
            .groupBy("State", "County", "City", "Severity", date_of("Start_Time").alias("date"))
            .agg(*_measures(c("Severity").try_cast("double"))))


def mart_by_hour_severity(accidents: DataFrame) -> DataFrame:
    """``HH:00`` label x integer Severity -> count, mean severity."""
    sev = severity_int()
    return (accidents
            .select(c("ID"), hour_label(hour_of("Start_Time")).alias("hour"), sev.alias("Severity"))
            .groupBy("hour", "Severity")
            .agg(*_measures(F.col("Severity"))))


def mart_by_weather(accidents: DataFrame) -> DataFrame:
    """The published "weather" mart: grouped by ``State``, labelled ``Weather_Condition``."""
    return (accidents
            .select(c("ID"), c("State"), severity_int().alias("Severity"))
            .groupBy("State")
            .agg(*_measures(F.col("Severity")))
            .withColumnRenamed("State", "Weather_Condition"))


def mart_by_weather_condition(accidents: DataFrame, weather: DataFrame) -> DataFrame:
    """Extension: accidents joined to their weather row, grouped by the real condition.

    Both inputs come out of Silver hash-partitioned by ``ID``; the join is one
    sort-merge on ``ID`` (1:1 after dedup) followed by the usual aggregate.
    """
    joined = (accidents.select("ID", severity_int().alias("Severity"))
              .join(weather.select("ID", "Weather_Condition"), "ID"))
    return joined.groupBy("Weather_Condition").agg(*_measures(F.col("Severity")))


def base_counts(accidents: DataFrame) -> DataFrame:
    """Incidents by place, severity, day and hour: what all three marts sum up."""
    text = c("Severity").try_cast("double")
    return (accidents
            .groupBy("State", "County", "City", "Severity", date_of("Start_Time").alias("date"),
                     hour_of("Start_Time").alias("hour"))
            .agg(F.count(c("ID")).alias("n"),
                 F.sum(text).alias("severity_sum"), F.count(text).alias("severity_n"),
                 F.sum(severity_int()).alias("level_sum"), F.count(severity_int()).alias("level_n")))


def _rolled(total: str, n: str):
    count = F.sum(n)
    return [F.sum("n").alias("accident_count"),
            F.when(count > 0, F.sum(total).cast("double") / count).alias("avg_severity")]


def marts_from_base(base: DataFrame) -> dict[str, DataFrame]:
    """The three published marts, rolled up from ``base_counts``."""
    by_level = _rolled("level_sum", "level_n")
    return {
        "accidents_by_region": base.groupBy("State", "County", "City", "Severity", "date")
        .agg(*_rolled("severity_sum", "severity_n")),
        "accidents_by_hour_severity": base
        .select(hour_label(F.col("hour")).alias("hour"), severity_int().alias("Severity"), "n", "level_sum", "level_n")
        .groupBy("hour", "Severity").agg(*by_level),
        "accidents_by_weather": base.groupBy("State").agg(*by_level).withColumnRenamed("State", "Weather_Condition"),
    }


def build_gold(accidents: DataFrame) -> dict[str, DataFrame]:
    """The three published marts; pass ``marts_from_base`` a stored base to share one read."""
    return marts_from_base(base_counts(accidents))
