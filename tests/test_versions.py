"""Silver is published as one version, profiled as it is written; a streamed Bronze feeds the same Gold."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadlake.operators import profile
from roadlake.plans import jobs
from roadlake.plans import queries as Q
from roadlake.sources import csv_batches, store, versions
from roadlake.streaming.bronze_stream import ingest_available, ingest_cumulative, load_batch


@pytest.fixture()
def bronze(spark, sf_small, tmp_path):
    return store.write_bronze(Q.cumulative(spark, sf_small), str(tmp_path / "bronze"))


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_run_that_fails_leaves_the_old_version(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path / "silver")
    jobs.run_silver(spark, bronze, root, schema="atomic_s")
    old = {n: _rows(df) for n, df in jobs.silver_snapshot(spark, root).items()}
    less = store.write_bronze(store.read_bronze(spark, bronze).where("ID > 'A-5'"), str(tmp_path / "less"))
    write = versions.write_days

    def broken(df, root, name, run, days):
        if name == "weather":
            raise OSError("disk is gone")
        return write(df, root, name, run, days)

    monkeypatch.setattr(versions, "write_days", broken)
    with pytest.raises(OSError):
        jobs.run_silver(spark, less, root, schema="atomic_s")
    assert {n: _rows(df) for n, df in jobs.silver_snapshot(spark, root).items()} == old
    assert spark.table("atomic_s.accidents").where("bronze_date = '2025-01-03'").count() == len(old["accidents"])
    assert versions.latest(spark, root)["version"] == 1
    monkeypatch.setattr(versions, "write_days", write)
    jobs.run_silver(spark, less, root, schema="atomic_s")
    assert versions.latest(spark, root)["version"] == 2
    assert 0 < jobs.silver_snapshot(spark, root)["accidents"].count() < len(old["accidents"])


def test_one_day_again_and_vacuum(spark, bronze, tmp_path):
    root = str(tmp_path / "silver")
    jobs.run_silver(spark, bronze, root, schema="vac_s")
    first = _rows(store.read_bronze(spark, f"{root}/weather"))
    for _ in range(3):
        jobs.run_silver(spark, bronze, root, schema="vac_s", day="2025-01-02")
    assert _rows(store.read_bronze(spark, f"{root}/weather")) == first
    runs = versions.latest(spark, root)["tables"]["weather"]["days"]
    assert len({x["run"] for x in runs.values()}) == 2
    gone = versions.vacuum(spark, root, keep=1)
    assert len([g for g in gone if "/weather/" in g]) == 2 and len([g for g in gone if "_manifest" in g]) == 3
    assert _rows(store.read_bronze(spark, f"{root}/weather")) == first == _rows(spark.table("vac_s.weather"))


def test_profile_equals_a_scan_and_reads_no_table(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path / "silver")
    monkeypatch.setattr(versions, "DAYS_A_JOB", 2)  # two jobs a table
    jobs.run_silver(spark, bronze, root, schema="prof_s")
    got = jobs.silver_profile(spark, root)
    tables = {n: store.read_bronze(spark, f"{root}/{n}").drop("bronze_date") for n in jobs.SILVER_TABLES}
    want = profile.schema_profile(tables)
    assert _rows(got.select("table_name", "position", "column_name", "data_type", "n_rows",
                            (F.col("n_rows") - F.col("null_count")).alias("non_null"))) == _rows(want)
    assert "parquet" not in got._jdf.queryExecution().toString().lower()
    one = {r.table_name: r.n_rows for r in jobs.silver_profile(spark, root, "2025-01-02").collect()}
    assert one == {n: df.count() for n, df in jobs.silver_snapshot(spark, root, "2025-01-02").items()}


def test_nulls_are_counted_by_day(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "2025-01-01"), (None, None, "2025-01-02"), ("b", "x", "2025-01-02")], "k string, `v.w` string, d string")
    df = df.withColumn("bronze_date", F.col("d").cast("date")).drop("d")
    entry = versions.write_days(df, str(tmp_path), "t", "r1", ["2025-01-01", "2025-01-02", "2025-01-09"])
    assert {d: (x["rows"], x["nulls"]) for d, x in entry["days"].items()} == {
        "2025-01-01": (1, {"k": 0, "v.w": 1}), "2025-01-02": (2, {"k": 1, "v.w": 1})}
    versions.publish(spark, str(tmp_path), {"t": entry})
    assert store.read_bronze(spark, str(tmp_path / "t"), "2025-01-02").count() == 2
    assert store.existing_days(spark, str(tmp_path / "t")) == ["2025-01-01", "2025-01-02"]


def test_a_table_without_rows(spark, tmp_path):
    df = spark.createDataFrame([], "k string, bronze_date date")
    versions.publish(spark, str(tmp_path), {"t": versions.write_days(df, str(tmp_path), "t", "r1", ["2025-01-01"])})
    found = store.read_bronze(spark, str(tmp_path / "t"))
    assert found.columns == ["k", "bronze_date"] and found.count() == 0


def _gold(spark, bronze, tmp_path, name):
    jobs.run_silver(spark, bronze, str(tmp_path / name), schema=f"gold_{name}")
    gold = str(tmp_path / f"{name}_gold")
    jobs.build_gold(jobs.silver_snapshot(spark, str(tmp_path / name))["accidents"], gold)
    return {n: _rows(spark.read.parquet(f"{gold}/{n}")) for n in ("accidents_by_region", "accidents_by_hour_severity", "accidents_by_weather")}


def test_gold_of_streams_equals_the_feeders(spark, sf_small, tmp_path):
    b = Q.batches(spark, sf_small).drop("seq")
    csv_batches.write_daily_batches(b, str(tmp_path / "all"))
    cols = [n for n in b.columns if n not in ("batch", "situation_date")]
    jobs.run_feeder(spark, str(tmp_path / "all"), str(tmp_path / "fed"), 2025, 1)
    want = _gold(spark, str(tmp_path / "fed"), tmp_path, "feeder")
    (tmp_path / "in").mkdir()
    for day in ("02", "01", "03"):  # a late day in between
        (tmp_path / "all" / f"{day}-01-2025.csv").rename(tmp_path / "in" / f"{day}-01-2025.csv")
        ingest_cumulative(spark, str(tmp_path / "in"), cols, str(tmp_path / "grown"), str(tmp_path / "ck1"))
    days = lambda p: {str(r[0]): r[1] for r in store.read_bronze(spark, p).groupBy("bronze_date").count().collect()}
    assert days(str(tmp_path / "grown")) == days(str(tmp_path / "fed"))
    assert _gold(spark, str(tmp_path / "grown"), tmp_path, "cumulative") == want
    ingest_available(spark, str(tmp_path / "in"), cols, str(tmp_path / "own"), str(tmp_path / "ck2"))
    assert _gold(spark, str(tmp_path / "own"), tmp_path, "plain") == want


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = lambda *r: spark.createDataFrame(r, "ID string, d string").withColumn("situation_date", F.col("d").cast("date")).drop("d")
    one, two = rows(("a", "2025-01-01"), ("b", "2025-01-02")), rows(("c", "2025-01-02"), ("d", "2025-01-04"))
    load_batch(one, 0, path)
    assert load_batch(two, 1, path) == ["2025-01-02", "2025-01-04"]
    state = _rows(store.read_bronze(spark, path))
    load_batch(two, 1, path)
    load_batch(one, 0, path)
    assert _rows(store.read_bronze(spark, path)) == state
    per_day = {str(r[0]): r[1] for r in store.read_bronze(spark, path).groupBy("bronze_date").count().collect()}
    assert per_day == {"2025-01-01": 1, "2025-01-02": 2, "2025-01-04": 4}
    assert load_batch(one.limit(0), 2, path) == [] and _rows(store.read_bronze(spark, path)) == state


def test_a_store_without_a_day_yet_has_none(spark, tmp_path):
    path = tmp_path / "bronze"
    (path / "_batches").mkdir(parents=True)  # as a cumulative store's first batch finds it
    assert store.existing_days(spark, str(path)) == [] and store.loaded_days(spark, str(path)).columns == ["bronze_date"]
    spark.createDataFrame([("a",)], "ID string").write.mode("append").parquet(str(path))
    with pytest.raises(AnalysisException):  # rows without a day are no day-partitioned store
        store.existing_days(spark, str(path))
