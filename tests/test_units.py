"""Hand-made frames for the semantics the oracle pairs cannot reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake import schema as S
from roadlake.functions.names import clean_column_name
from roadlake.operators import bronze, gold, kpi, silver, split


def text_frame(spark, rows, cols):
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in cols]))


def acc_row(seq, id_, sev="2", start="2025-01-01 10:00:00", end="2025-01-01 11:00:00", lat="1.5",
            city=" Paris ", county="X", state="S", tz="UTC", desc="d"):
    return (str(seq), id_, sev, start, end, lat, "2.5", desc, city, county, state, tz)


ACC_IN = ["seq"] + S.ACCIDENT_COLUMNS


def test_clean_column_name():
    assert clean_column_name("Temperature(F)") == "Temperature_F_"
    assert clean_column_name("Humidity(%)") == "Humidity_pct_"
    assert clean_column_name("a.b") == "a_b"
    assert clean_column_name("p(%)") == "p_pct_"
    assert clean_column_name("q[1]") == "q[1]"  # detected but left alone
    assert clean_column_name("Wind Chill(F)") == "Wind_Chill_F_"
    assert clean_column_name("plain") == "plain"


def test_sanitize_columns_in_one_projection(spark):
    df = text_frame(spark, [("1", "2", "3")], ["a.b", "p(%)", "q[1]"])
    out = bronze.sanitize_columns(df)
    assert out.columns == ["a_b", "p_pct_", "q[1]"]
    assert out.collect()[0] == ("1", "2", "3")


def test_accidents_filters_and_malformed_values(spark):
    rows = [
        acc_row(1, None),                                   # NULL key
        acc_row(2, "A", sev="0"), acc_row(3, "B", sev="5"), acc_row(4, "C", sev="abc"),
        acc_row(5, "D", end="2025-01-01 10:00:00"),         # Start = End: strict order drops it
        acc_row(6, "E", lat="x"),                           # malformed latitude -> NULL -> dropped
        acc_row(7, "F", city="  LYON  ", county=" BIG County "),
    ]
    out = silver.conform_accidents(text_frame(spark, rows, ACC_IN)).collect()
    assert [r.ID for r in out] == ["F"]
    assert out[0].City == "lyon" and out[0].County == "big county"
    assert isinstance(out[0].Start_Lat, float)


def test_dedup_runs_before_null_drop(spark):
    # first row of key "A" (lowest seq) has a NULL latitude: the key disappears
    rows = [acc_row(1, "A", lat=None), acc_row(2, "A"), acc_row(3, "B"), acc_row(4, "B", city="other")]
    out = silver.conform_accidents(text_frame(spark, rows, ACC_IN)).collect()
    assert [(r.ID, r.City) for r in out] == [("B", "paris")]


def test_dedup_without_seq_is_deterministic(spark):
    rows = [("k", "b", "1"), ("k", "a", "2"), ("j", "z", None)]
    df = text_frame(spark, rows, ["ID", "x", "y"])
    out = sorted(silver.dedup_by_key(df, ["ID"]).collect())
    assert out == [("j", "z", None), ("k", "a", "2")]


def test_missing_columns_are_completed_with_contract_types(spark):
    df = text_frame(spark, [("1", "A", "True")], ["seq", "ID", "Amenity"])
    out = silver.complete_columns(df, S.ROAD_COLUMNS + ["Start_Lat", "Severity", "City"])
    types = dict(out.dtypes)
    assert types["Bump"] == "int" and types["Start_Lat"] == "float"
    assert types["Severity"] == "int" and types["City"] == "string" and types["Amenity"] == "string"
    # weather with an absent measure: NULL float, so the NULL drop removes every row
    w = silver.conform_weather(text_frame(spark, [("1", "A", "t")], ["seq", "ID", "Weather_Timestamp"]))
    assert w.count() == 0


def test_flags(spark):
    cols = ["seq", "ID"] + S.ROAD_FLAGS
    rows = [("1", "A", "True", "False", "True", "False", "True"),
            ("2", "B", "yes", "False", "True", "False", "True"),
            ("3", "C", None, "False", "True", "False", "True")]
    out = silver.conform_road(text_frame(spark, rows, cols)).collect()
    assert [tuple(r) for r in out] == [("A", 1, 0, 1, 0, 1)]
    # an integer flag column is compared as text, not failed under ANSI
    ints = spark.createDataFrame([(1, "A", 1)], "seq long, ID string, Amenity int")
    assert silver.conform_road(ints).count() == 0


def test_time_order_is_iso_text_order(spark):
    rows = [acc_row(1, "A", start="2025-01-01 09:59:59", end="2025-01-01 10:00:00"),
            acc_row(2, "B", start="2025-01-02 00:00:00", end="2025-01-01 23:59:59")]
    out = silver.filter_time_order(text_frame(spark, rows, ACC_IN))
    ts = out.select(F.col("Start_Time").cast("timestamp") < F.col("End_Time").cast("timestamp")).collect()
    assert [r.ID for r in out.collect()] == ["A"] and all(r[0] for r in ts)


def test_max_hour_tie_goes_to_earliest(spark):
    marts = spark.createDataFrame(
        [("03:00", 1, 5, 1.0), ("07:00", 2, 5, 2.0), ("01:00", 1, 2, 1.0), ("01:00", 2, 2, 2.0)],
        "hour string, Severity int, accident_count long, avg_severity double")
    assert kpi.kpi_max_hour(marts).collect()[0].max_hour == "03:00"


def test_top_k_ties_break_on_keys(spark):
    m = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1)], "City string, accident_count long")
    assert [r.City for r in kpi.kpi_top_cities(m, 2).collect()] == ["a", "b"]


def test_region_label_null_when_part_missing(spark):
    m = spark.createDataFrame([("s", None, 3), ("s", "c", 1)], "State string, County string, accident_count long")
    labels = {r.Region: r.accidents for r in kpi.kpi_region_labels(m).collect()}
    assert labels == {None: 3, "s - c": 1}


def test_marts_sum_to_silver_rows(spark):
    rows = [acc_row(i, f"A{i}", sev=str(1 + i % 4), start=f"2025-01-0{1 + i % 3} 0{i % 9}:00:00",
                    end="2025-01-09 00:00:00") for i in range(40)]
    acc = silver.conform_accidents(text_frame(spark, rows, ACC_IN))
    n = acc.count()
    for mart in (gold.mart_by_region(acc), gold.mart_by_hour_severity(acc), gold.mart_by_weather(acc)):
        assert mart.agg(F.sum("accident_count")).collect()[0][0] == n
    hours = {r.hour for r in gold.mart_by_hour_severity(acc).collect()}
    assert "00:00" in hours and all(len(h) == 5 for h in hours)


@pytest.mark.parametrize("n,expected", [(0, []), (1, [0, 0, 1]), (2, [0, 0, 2]), (3, [1, 1, 1]),
                                        (10, [3, 3, 4])])
def test_ordered_split_sizes(spark, n, expected):
    df = spark.range(n).withColumnRenamed("id", "seq")
    out = split.ordered_split(df, ["seq"], 3, "2025-01-01", num_partitions=4)
    got = {r.batch: r.n for r in out.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert [got.get(b, 0) for b in range(3)] == (expected or [0, 0, 0])
    rows = out.orderBy("seq").collect()
    assert [r.batch for r in rows] == sorted(r.batch for r in rows)  # order preserved
    if rows:
        assert rows[-1].situation_date == dt.date(2025, 1, 3)


def test_split_remainder_goes_last_on_many_partitions(spark):
    df = spark.range(0, 1001, 1, numPartitions=7).withColumnRenamed("id", "seq")
    out = split.ordered_split(df, ["seq"], 3, num_partitions=5)
    got = sorted((r.batch, r.lo, r.hi, r.n) for r in out.groupBy("batch").agg(
        F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n")).collect())
    assert got == [(0, 0, 332, 333), (1, 333, 665, 333), (2, 666, 1000, 335)]


def test_bronze_cumulative_and_pending(spark):
    df = spark.range(9).withColumnRenamed("id", "seq")
    b = split.ordered_split(df, ["seq"], 3, "2025-01-01", num_partitions=2)
    cum = bronze.bronze_cumulative(b, "2025-01-03")
    per_day = {str(r.bronze_date): r.n for r in cum.groupBy("bronze_date").agg(F.count("*").alias("n")).collect()}
    assert per_day == {"2025-01-01": 3, "2025-01-02": 3, "2025-01-03": 9}
    loaded = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 3),)], "situation_date date")
    pend = bronze.pending_batches(b, loaded, "2025-01-03")
    assert sorted({r.batch for r in pend.collect()}) == [1, 2]  # last day is never skipped


def test_union_is_by_name_and_strict(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(bronze.union_batches([a, b]).collect()) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "n int")
    with pytest.raises(Exception):
        bronze.union_batches([a, c]).collect()


def test_split_exact_when_aqe_merges_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(0, 2003, 1, numPartitions=9).withColumnRenamed("id", "seq")
        out = split.ordered_split(df, ["seq"], 3)
        got = sorted((r.batch, r.lo, r.hi, r.n) for r in out.groupBy("batch").agg(
            F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == [(0, 0, 666, 667), (1, 667, 1333, 667), (2, 1334, 2002, 669)]
