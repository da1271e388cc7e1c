"""Sources, sinks and the end-to-end jobs, on temporary folders."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from roadlake.operators import features, gold, kpi, silver, split
from roadlake.plans import jobs
from roadlake.plans import queries as Q
from roadlake.sources import catalog, csv_batches, sinks, store
from roadlake.streaming.bronze_stream import ingest_available

#: Accidents of the small feed without ``seq``: of each key's rows the most complete one stays (499 with ``seq``).
COMPLETE = 506
CSV_HEADERS = {**Q.RAW_HEADERS, "Description": "Description"}


def test_csv_reader_quotes_newlines_and_empty(spark, tmp_path):
    p = tmp_path / "01-01-2025.csv"
    p.write_text('ID,Description,Temperature(F)\nA-1,"He said ""hi""\nnext line",\nA-2,plain,3.5\n')
    df = csv_batches.read_csv_batch(spark, str(p), with_file_date=True, multi_line=True)
    assert df.columns == ["ID", "Description", "Temperature_F_", "situation_date"]
    rows = {r.ID: r for r in df.collect()}
    assert rows["A-1"].Description == 'He said "hi"\nnext line'
    assert rows["A-1"].Temperature_F_ is None and rows["A-2"].Temperature_F_ == "3.5"
    assert rows["A-2"].situation_date == dt.date(2025, 1, 1)


def test_batches_union_by_name_and_reject_other_columns(spark, tmp_path):
    (tmp_path / "01-01-2025.csv").write_text("ID,Humidity(%)\nA,1\n")
    (tmp_path / "02-01-2025.csv").write_text("Humidity(%),ID\n2,B\n")
    (tmp_path / "03-01-2025.csv").write_text("ID,Other\nC,3\n")
    two = csv_batches.read_dated_batches(
        spark, [(str(tmp_path / "01-01-2025.csv"), "2025-01-01"), (str(tmp_path / "02-01-2025.csv"), "2025-01-02")])
    assert sorted((r.ID, r.Humidity_pct_, str(r.situation_date)) for r in two.collect()) == [
        ("A", "1", "2025-01-01"), ("B", "2", "2025-01-02")]
    with pytest.raises(Exception):
        csv_batches.read_dated_batches(
            spark, [(str(tmp_path / "01-01-2025.csv"), "2025-01-01"), (str(tmp_path / "03-01-2025.csv"), "2025-01-03")]
        ).collect()
    # one scan of several files checks each header instead of reading by position
    with pytest.raises(Exception):
        csv_batches.read_csv_batch(spark, [str(tmp_path / "01-01-2025.csv"), str(tmp_path / "02-01-2025.csv")],
                                   columns=["ID", "Humidity(%)"]).collect()


def test_feeder_reads_spark_written_batch_folders(spark, sf_small, tmp_path):
    b = split.ordered_split(Q.raw(spark, sf_small), ["seq"], 3, "2025-01-01")
    src = str(tmp_path / "data")
    headers = [CSV_HEADERS.get(n, n) for n in b.columns]
    paths = csv_batches.write_daily_batches(b.drop("seq").toDF(*[h for h in headers if h != "seq"]), src)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["01-01-2025.csv", "02-01-2025.csv", "03-01-2025.csv"]
    (tmp_path / "data" / "notes.csv").write_text("x\n1\n")
    names = sorted(r.file_name for r in csv_batches.list_csv_files(spark, src).collect())
    assert names == ["01-01-2025.csv", "02-01-2025.csv", "03-01-2025.csv", "notes.csv"]
    rep = jobs.run_feeder(spark, src, str(tmp_path / "bronze"), 2025, 1)
    assert rep.written_days == ["2025-01-01", "2025-01-02", "2025-01-03"]
    last = store.read_bronze(spark, str(tmp_path / "bronze"), "2025-01-03")
    assert last.count() == 1000 and "Temperature_F_" in last.columns
    assert silver.conform_accidents(last).count() == COMPLETE
    # one scan of several batch folders dates each row from its folder
    both = csv_batches.read_csv_batch(spark, paths[:2], with_file_date=True)
    days = {str(r.situation_date): r.n for r in both.groupBy("situation_date").agg(F.count("*").alias("n")).collect()}
    assert days == {"2025-01-01": 333, "2025-01-02": 333}


def test_discovery_from_folder(spark, tmp_path):
    for name in ["03-01-2025.csv", "01-01-2025.csv", "02-01-2025.csv", "04-01-2025.csv",
                 "15-02-2025.csv", "notes.csv", "1-1-2025.csv", "31-01-2024.csv"]:
        (tmp_path / name).write_text("ID\nA\n")
    (tmp_path / "05-01-2025.txt").write_text("x")
    picked = csv_batches.select_batches(csv_batches.list_csv_files(spark, str(tmp_path)), 2025, 1, 3)
    got = [(r.batch, r.file_name) for r in picked.orderBy("batch").collect()]
    assert got == [(0, "01-01-2025.csv"), (1, "02-01-2025.csv"), (2, "03-01-2025.csv")]


def _write_daily_csvs(spark, sf_dir, folder):
    """Three dated CSV batch folders of the small adapter feed, with raw-style headers."""
    b = split.ordered_split(Q.raw(spark, sf_dir), ["seq"], 3, "2025-01-01").drop("seq")
    csv_batches.write_daily_batches(b.toDF(*[CSV_HEADERS.get(n, n) for n in b.columns]), folder)
    return b


def test_end_to_end_jobs(spark, sf_small, tmp_path):
    src = str(tmp_path / "data")
    fed = _write_daily_csvs(spark, sf_small, src)
    bronze_path = str(tmp_path / "bronze")
    rep = jobs.run_feeder(spark, src, bronze_path, 2025, 1)
    assert rep.files == ["01-01-2025.csv", "02-01-2025.csv", "03-01-2025.csv"]
    days = {str(r.bronze_date): r.n for r in store.read_bronze(spark, bronze_path)
            .groupBy("bronze_date").agg(F.count("*").alias("n")).collect()}
    assert days == {"2025-01-01": 333, "2025-01-02": 333, "2025-01-03": fed.count()}
    assert "Temperature_F_" in store.read_bronze(spark, bronze_path).columns
    # rerun: loaded days are skipped, the last day is rewritten, nothing doubles
    rep2 = jobs.run_feeder(spark, src, bronze_path, 2025, 1)
    assert rep2.written_days == ["2025-01-03"]
    assert store.read_bronze(spark, bronze_path).count() == 333 + 333 + 1000

    schema = "silver_e2e"
    jobs.run_silver(spark, bronze_path, str(tmp_path / "silver"), schema=schema)
    assert sorted(r.tableName for r in catalog.table_listing(spark, schema).collect()) == [
        "accidents", "road_features", "weather"]
    assert store.existing_days(spark, str(tmp_path / "silver" / "accidents"))[-1] == "2025-01-03"
    snap = jobs.silver_snapshot(spark, str(tmp_path / "silver"))
    expected_acc = silver.conform_accidents(store.read_bronze(spark, bronze_path, "2025-01-03"))
    assert snap["accidents"].count() == expected_acc.count() == COMPLETE
    assert sorted(snap["accidents"].columns) == sorted(expected_acc.columns)

    gold_root = str(tmp_path / "gold")
    jobs.build_gold(snap["accidents"], gold_root)
    out = jobs.kpis(spark, gold_root)
    want = kpi.kpi_top_regions(gold.mart_by_region(silver.conform_accidents(fed))).collect()
    assert out["top_regions"].collect() == want
    assert out["global"].collect()[0].total_accidents == COMPLETE

    model_path = str(tmp_path / "model")
    tr = jobs.run_training(snap["accidents"], snap["weather"], snap["road_features"], model_path)
    assert 0.0 <= tr.accuracy <= 1.0 and tr.n_train > tr.n_test > 0
    loaded = PipelineModel.load(model_path)
    joined = features.join_silver(snap["accidents"], snap["weather"], snap["road_features"])
    scored = loaded.transform(joined.drop("Severity"))  # raw joined rows, no preparation, no answer
    assert "prediction" in scored.columns and scored.count() == tr.n_train + tr.n_test


def test_training_guard_on_empty(spark):
    from roadlake.operators import model
    empty = spark.createDataFrame([], "ID string, Severity string, Start_Time string, Wind_Direction string, "
                                      "Weather_Condition string, Start_Lat float")
    with pytest.raises(ValueError):
        model.train_model(empty)


def test_append_twice_keeps_duplicates(spark, tmp_path):
    catalog.reset_schema(spark, "s_append", ["t"], location=str(tmp_path / "wh"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    catalog.append_table(df, "s_append.t", str(tmp_path / "t"))
    catalog.append_table(df, "s_append.t", str(tmp_path / "t"))
    assert catalog.table_scan(spark, "s_append.t").count() == 4
    catalog.reset_schema(spark, "s_append", ["t"])
    assert not spark.catalog.tableExists("s_append.t")


def test_snapshot_isolates_failures(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("snap_ok")
    done = catalog.snapshot_tables(spark, {"ok": "snap_ok", "missing": "no_such_table_xyz"}, str(tmp_path))
    assert done["ok"].endswith("/ok") and done["missing"].startswith("error:")
    assert spark.read.parquet(done["ok"]).count() == 1


def test_jdbc_failure_is_reported_not_raised(spark):
    df = spark.createDataFrame([(1,)], "x int")
    err = sinks.jdbc_write(df, "jdbc:roadlake-nowhere:db", "t", {"user": "u"})
    assert err is not None and "driver" in err.lower()


def test_partition_overwrite_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "b")
    d1 = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2))], "x int, bronze_date date")
    store.write_bronze(d1, path)
    store.write_bronze(spark.createDataFrame([(9, dt.date(2025, 1, 2))], "x int, bronze_date date"), path)
    got = sorted((r.x, str(r.bronze_date)) for r in store.read_bronze(spark, path).collect())
    assert got == [(1, "2025-01-01"), (9, "2025-01-02")]
    assert [r.x for r in store.read_bronze(spark, path, "2025-01-01").collect()] == [1]


def test_streaming_ingest_sees_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "01-01-2025.csv").write_text("ID,Temperature(F)\nA,1\nB,2\n")
    (src / "02-01-2025.csv").write_text("ID,Temperature(F)\nC,3\n")
    out, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    cols = ["ID", "Temperature(F)"]
    ingest_available(spark, str(src), cols, out, ck)
    assert spark.read.parquet(out).count() == 3
    (src / "03-01-2025.csv").write_text("ID,Temperature(F)\nD,4\nE,5\n")
    ingest_available(spark, str(src), cols, out, ck)
    df = spark.read.parquet(out)
    assert df.count() == 5
    assert "Temperature_F_" in df.columns
    per_day = {str(r.situation_date): r.n for r in df.groupBy("situation_date").agg(F.count("*").alias("n")).collect()}
    assert per_day == {"2025-01-01": 2, "2025-01-02": 1, "2025-01-03": 2}
    # a daily batch written by Spark as a folder of parts is picked up too
    part = spark.createDataFrame([("F", "6"), ("G", "7"), ("H", "8")], "ID string, `Temperature(F)` string")
    part.repartition(2).write.option("header", "true").csv(str(src / "04-01-2025.csv"))
    ingest_available(spark, str(src), cols, out, ck)
    per_day = {str(r.situation_date): r.n for r in spark.read.parquet(out)
               .groupBy("situation_date").agg(F.count("*").alias("n")).collect()}
    assert per_day == {"2025-01-01": 2, "2025-01-02": 1, "2025-01-03": 2, "2025-01-04": 3}


def test_kpi_helpers_on_marts(spark):
    by_hour = spark.createDataFrame([("00:00", 1, 3, 1.0), ("00:00", 2, 1, 2.0), ("05:00", 1, 1, 1.0)],
                                    "hour string, Severity int, accident_count long, avg_severity double")
    assert [tuple(r) for r in kpi.kpi_by_hour(by_hour).collect()] == [("00:00", 4), ("05:00", 1)]
    assert [tuple(r) for r in kpi.kpi_by_severity(by_hour).collect()] == [(1, 4), (2, 1)]


def test_command_line_runs_every_job(spark, sf_small, tmp_path, capsys):
    from roadlake.plans import cli

    src = str(tmp_path / "data")
    _write_daily_csvs(spark, sf_small, src)
    lake = tmp_path / "lake"
    r = cli.main(["feeder", "--input", src, "--bronze", str(lake / "bronze"), "--year", "2025", "--month", "1"], spark)
    assert r["written_days"] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    cli.main(["silver", "--bronze", str(lake / "bronze"), "--silver", str(lake / "silver"), "--schema", "cli_s"], spark)
    cli.main(["gold", "--silver", str(lake / "silver"), "--gold", str(lake / "gold")], spark)
    k = cli.main(["kpis", "--gold", str(lake / "gold")], spark)
    assert k["global"][0]["total_accidents"] == COMPLETE and len(k["top_regions"]) == 5
    t = cli.main(["train", "--silver", str(lake / "silver"), "--model", str(lake / "model")], spark)
    assert 0 <= t["accuracy"] <= 1
    c = cli.main(["snapshot", "--silver", str(lake / "silver"), "--output", str(lake / "copy"), "--day", "2025-01-02"], spark)
    assert spark.read.parquet(c["accidents"]).count() < 333 and sorted(c) == ["accidents", "road_features", "weather"]
    e = cli.main(["explore", "--silver", str(lake / "silver")], spark)
    assert sorted(e["tables"]) == ["accidents", "road_features", "weather"]
    assert all(len(v) == 5 for v in e["samples"].values())
    capsys.readouterr()


def test_feeder_with_no_or_few_batch_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "notes.csv").write_text("ID\nA\n")
    with pytest.raises(FileNotFoundError):
        jobs.run_feeder(spark, str(src), str(tmp_path / "b0"), 2025, 1)
    empty = jobs.run_feeder(spark, str(src), str(tmp_path / "b0"), 2025, 1, allow_empty=True)
    assert empty.files == [] and empty.written_days == []
    (src / "05-01-2025.csv").write_text("ID,Temperature(F)\nA,1\nB,2\n")
    (src / "07-01-2025.csv").write_text("ID,Temperature(F)\nC,3\n")
    rep = jobs.run_feeder(spark, str(src), str(tmp_path / "b1"), 2025, 1)
    assert rep.files == ["05-01-2025.csv", "07-01-2025.csv"]
    days = {str(r.bronze_date): r.n for r in store.read_bronze(spark, str(tmp_path / "b1"))
            .groupBy("bronze_date").agg(F.count("*").alias("n")).collect()}
    assert days == {"2025-01-05": 2, "2025-01-07": 3}  # the last day holds every batch


def test_command_line_ingest_stream(spark, tmp_path, capsys):
    from roadlake.plans import cli

    src = tmp_path / "in"
    src.mkdir()
    (src / "01-01-2025.csv").write_text("ID,Humidity(%)\nA,1\nB,2\n")
    args = ["ingest", "--input", str(src), "--bronze", str(tmp_path / "bs"), "--checkpoint", str(tmp_path / "ck")]
    r = cli.main(args, spark)
    assert r["columns"] == ["ID", "Humidity(%)"]
    (src / "02-01-2025.csv").write_text("ID,Humidity(%)\nC,3\n")
    cli.main(args, spark)
    df = spark.read.parquet(str(tmp_path / "bs"))
    assert df.count() == 3 and "Humidity_pct_" in df.columns
    capsys.readouterr()
