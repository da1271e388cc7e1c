"""Physical-plan guards for the scale design (explain output, no execution needed)."""

import re

import pytest
from pyspark.sql import functions as F

from roadlake import schema as S
from roadlake.operators import features, gold, silver
from roadlake.sources import store


def plan_of(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture()
def bronze_path(spark, tmp_path):
    cols = ["seq"] + list(dict.fromkeys(S.ACCIDENT_COLUMNS + S.WEATHER_COLUMNS + S.ROAD_COLUMNS))
    df = spark.range(200).select(
        F.col("id").alias("seq"),
        *[F.concat(F.lit(f"{c}-"), (F.col("id") % 7).cast("string")).alias(c) for c in cols[1:]],
        F.lit("2025-01-03").cast("date").alias("bronze_date"))
    return store.write_bronze(df, str(tmp_path / "bronze"))


def test_dedup_limits_rows_before_the_shuffle(spark, bronze_path, capsys):
    plan = plan_of(silver.conform_accidents(store.read_bronze(spark, bronze_path)), capsys)
    tree = plan.split("\n\n")[0]
    # partial WindowGroupLimit under the exchange, final one above it
    assert re.search(r"WindowGroupLimit \(\d+\)\n.*Sort \(\d+\)\n.*Exchange \(\d+\)\n.*WindowGroupLimit", tree)


def test_bronze_scan_pushes_filters_and_prunes_columns(spark, bronze_path, capsys):
    plan = plan_of(silver.conform_accidents(store.read_bronze(spark, bronze_path, "2025-01-03")), capsys)
    assert "IsNotNull(ID)" in plan
    assert re.search(r"PushedFilters: \[[^\]]*In\(Severity", plan)
    assert "PartitionFilters: [isnotnull(bronze_date" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "Weather_Condition" not in read and "Amenity" not in read and "Start_Lat" in read


def test_silver_join_chain_reuses_id_partitioning(spark, bronze_path, capsys, no_broadcast):
    rows = store.read_bronze(spark, bronze_path)
    joined = features.join_silver(silver.conform_accidents(rows), silver.conform_weather(rows),
                                  silver.conform_road(rows))
    plan = plan_of(joined, capsys)
    tree = plan.split("\n\n")[0]
    assert tree.count("SortMergeJoin LeftOuter") == 2
    # one exchange per Silver table (the dedup), none added for the joins
    assert tree.count("Exchange") == 3


def test_marts_aggregate_partially_before_shuffle(spark, bronze_path, capsys):
    acc = silver.conform_accidents(store.read_bronze(spark, bronze_path))
    for mart in (gold.mart_by_region(acc), gold.mart_by_hour_severity(acc), gold.mart_by_weather(acc)):
        plan = plan_of(mart, capsys)
        assert "partial_count" in plan and "partial_avg" in plan


def test_dedup_with_a_hot_key_holding_a_third_of_rows(spark):
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("ID"),
        *[F.lit("True").alias(f) for f in S.ROAD_FLAGS])
    out = silver.conform_road(df)
    assert out.count() == 2000 + 1
    assert out.filter(F.col("ID") == "HOT").count() == 1


def test_silver_costs_one_shuffle_a_table(spark, bronze_path, capsys):
    from roadlake.plans import jobs

    for df in jobs.conform_all(store.read_bronze(spark, bronze_path)).values():
        tree = plan_of(df, capsys).split("\n\n")[0]
        assert tree.count("Exchange") == 1 and tree.count("WindowGroupLimit") == 2


def test_marts_share_one_pass_over_incidents(spark, bronze_path, capsys):
    from roadlake.session import materialize

    acc = silver.conform_accidents(store.read_bronze(spark, bronze_path))
    base = materialize(gold.base_counts(acc))
    for mart in gold.marts_from_base(base).values():
        tree = plan_of(mart, capsys)
        assert tree.split("\n\n")[0].count("Exchange") == 1 and "partial_sum" in tree
        assert "Description" not in tree and "ID" not in re.search(r"ReadSchema: struct<([^>]*)>", tree).group(1)


def test_model_frame_is_pruned(spark, sf_small, capsys):
    from roadlake.plans import queries as Q

    frame, names, _ = features.prepare_features(Q.joined(spark, sf_small))
    plan = plan_of(frame.select("Severity"), capsys)
    assert "Description" not in frame.columns and "Scan parquet" in plan and "Start_Lng" in names


def test_day_write_reads_only_that_bronze_day(spark, bronze_path, capsys):
    from roadlake.plans import jobs

    day = jobs.conform_all(store.read_bronze(spark, bronze_path))["weather"].filter(
        F.col("bronze_date") == F.lit("2025-01-03").cast("date"))
    plan = plan_of(day, capsys)
    assert "PartitionFilters: [isnotnull(bronze_date" in plan and "= 2025-01-03)" in plan
