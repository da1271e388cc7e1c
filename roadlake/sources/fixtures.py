"""Adapter: the driver's star-schema tables presented as raw incident batches.

One incident per ``events`` row, placed through ``customer`` -> ``nation`` ->
``region``.  The derivation rules (which rows get a NULL, a duplicate key, an
out-of-domain severity, ...) are the fixture definition in FIXTURES.md; every
row of ``events`` is kept.  ``seq`` is the stable order key of the raw feed.

Scale: ``customer`` grows with the data, so it is joined by key (sort-merge,
AQE splits a hot ``user_id``); ``nation``/``region`` are fixed-size
dimensions that Spark's own size check broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import sf_table

RAW_COLUMNS = [
    "seq", "ID", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "Description",
    "City", "County", "State", "Timezone", "Weather_Timestamp", "Temperature_F_",
    "Humidity_pct_", "Pressure_in_", "Visibility_mi_", "Wind_Direction", "Wind_Speed_mph_",
    "Precipitation_in_", "Weather_Condition", "Amenity", "Bump", "Crossing", "Junction",
    "Traffic_Signal",
]


def _every(n: int, r: int = 0) -> Column:
    return (F.col("event_id") % n) == r


def _text(col: Column) -> Column:
    return col.cast("string")


def incident_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(sf_table(sf_dir, "events")).select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    customer = spark.read.parquet(sf_table(sf_dir, "customer")).select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    nation = spark.read.parquet(sf_table(sf_dir, "nation")).select(
        "n_nationkey", "n_name", "n_regionkey")
    region = spark.read.parquet(sf_table(sf_dir, "region")).select("r_regionkey", "r_name")

    place = (customer
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("c_custkey", "c_mktsegment", "n_name", "r_name"))
    ev = events.join(place, F.col("user_id") == F.col("c_custkey"))

    eid = F.col("event_id")
    ts = F.col("ts")  # timestamp_ntz: wall-clock text, no session time zone involved

    def seconds(t):
        # ISO text of a timestamp_ntz without its fraction (== date_trunc('second') as text, in any time zone)
        return F.regexp_replace(t.cast("string"), "[.][0-9]+$", "")

    value_text = _text(F.col("value"))
    none = F.lit(None).cast("string")
    return ev.select(
        eid.alias("seq"),
        F.when(_every(37, 5), none).otherwise(
            F.concat(F.lit("A-"), _text(eid - F.when(_every(10, 7), 1).otherwise(0)))).alias("ID"),
        F.when(_every(41, 7), "abc").otherwise(_text(eid % 5 + 1)).alias("Severity"),
        seconds(ts).alias("Start_Time"),
        seconds(F.when(_every(6), ts).otherwise(ts + F.expr("INTERVAL 30 MINUTES"))).alias("End_Time"),
        F.when(_every(11), none).when(_every(23, 1), "n/a").otherwise(value_text).alias("Start_Lat"),
        _text(F.lit(0) - F.col("value")).alias("Start_Lng"),
        F.col("props").alias("Description"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("City"),
        F.col("n_name").alias("County"),
        F.concat("r_name", F.lit(" "), "c_mktsegment").alias("State"),
        F.col("event_type").alias("Timezone"),
        seconds(ts).alias("Weather_Timestamp"),
        F.when(_every(13), none).otherwise(value_text).alias("Temperature_F_"),
        F.regexp_extract(F.col("props"), "([0-9]+)", 1).alias("Humidity_pct_"),
        _text(F.col("user_id")).alias("Pressure_in_"),
        _text(eid % 10).alias("Visibility_mi_"),
        F.when(_every(4, 0), " N").when(_every(4, 1), "S ").when(_every(4, 2), "East")
         .otherwise("WSW").alias("Wind_Direction"),
        _text(eid % 40).alias("Wind_Speed_mph_"),
        F.when(_every(7), none).otherwise(F.lit("0.0")).alias("Precipitation_in_"),
        F.concat(F.col("event_type"), F.lit(" ")).alias("Weather_Condition"),
        F.when(_every(17, 3), none).when(_every(2), "True").otherwise("False").alias("Amenity"),
        F.when(_every(3), "True").otherwise("False").alias("Bump"),
        F.when(_every(19), "yes").when(_every(5), "True").otherwise("False").alias("Crossing"),
        F.when(_every(4), "True").otherwise("False").alias("Junction"),
        F.when(F.col("user_id") % 2 == 0, "True").otherwise("False").alias("Traffic_Signal"),
    )
