"""Jobs must not lose or change rows silently: layouts, inputs, dedup, model, processes."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from roadlake.operators import features, gold, model, silver
from roadlake.plans import jobs
from roadlake.plans import queries as Q
from roadlake.session import ensure_checkpoint_dir, materialize
from roadlake.sources import csv_batches, store

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def bronze(spark, sf_small, tmp_path):
    return store.write_bronze(Q.cumulative(spark, sf_small), str(tmp_path / "bronze"))


def _per_day(spark, path):
    rows = store.read_bronze(spark, path).groupBy("bronze_date").agg(F.count("*").alias("n")).collect()
    return {str(r.bronze_date): r.n for r in rows}


def test_a_day_rewritten_at_another_width_loses_nothing(spark, bronze, tmp_path):
    root = str(tmp_path / "silver")
    jobs.run_silver(spark, bronze, root, schema="wide_s")
    before = _per_day(spark, f"{root}/accidents")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        jobs.run_silver(spark, bronze, root, schema="wide_again", day="2025-01-02")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert _per_day(spark, f"{root}/accidents") == before
    s = jobs.silver_snapshot(spark, root)
    assert features.join_silver(s["accidents"], s["weather"], s["road_features"]).count() == 499
    assert spark.table("wide_again.accidents").count() == sum(before.values())


def test_second_root_under_one_schema_is_refused(spark, bronze, tmp_path):
    jobs.run_silver(spark, bronze, str(tmp_path / "one"), schema="root_s")
    with pytest.raises(ValueError, match="stored in"):
        jobs.run_silver(spark, bronze, str(tmp_path / "two"), schema="root_s")
    assert not (tmp_path / "two" / "accidents").exists()
    jobs.run_silver(spark, bronze, str(tmp_path / "one") + "/", schema="root_s")


def test_full_run_drops_days_that_bronze_lost(spark, bronze, tmp_path):
    root = str(tmp_path / "silver")
    jobs.run_silver(spark, bronze, root, schema="stale_s")
    rest = str(tmp_path / "bronze2")
    store.write_bronze(store.read_bronze(spark, bronze).where("bronze_date <> '2025-01-02'"), rest)
    jobs.run_silver(spark, rest, root, schema="stale_s")
    assert sorted(_per_day(spark, f"{root}/weather")) == ["2025-01-01", "2025-01-03"]
    assert spark.table("stale_s.weather").select("bronze_date").distinct().count() == 2
    with pytest.raises(ValueError):
        jobs.run_silver(spark, rest, root, schema="stale_s", day="2025-01-02")


def test_folder_spellings(spark, tmp_path, monkeypatch):
    (tmp_path / "x").mkdir()
    data = tmp_path / "data"
    data.mkdir()
    for d in ("01", "02"):
        (data / f"{d}-01-2025.csv").write_text("ID,Humidity(%)\nA,1\n")
    base = os.path.relpath(tmp_path)
    for n, spelled in enumerate((str(data), f"{data}/", f"{base}/data", f"./{base}/data", f"{tmp_path}/x/../data", data.as_uri())):
        rep = jobs.run_feeder(spark, spelled, str(tmp_path / f"b{n}"), 2025, 1)
        assert rep.files == ["01-01-2025.csv", "02-01-2025.csv"], spelled


def test_line_breaks_go_out_and_come_back(spark, tmp_path):
    df = spark.range(100).select(
        F.concat(F.lit("A-"), "id").alias("ID"),
        F.when(F.col("id") % 10 == 0, 'two\nlines, "quoted"').otherwise("one").alias("Description"),
        F.lit("2025-01-01").cast("date").alias("situation_date"),
    )
    csv_batches.write_daily_batches(df.repartition(3), str(tmp_path / "in"), drop=())
    jobs.run_feeder(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), 2025, 1)
    back = store.read_bronze(spark, str(tmp_path / "bronze"))
    assert back.count() == 100 and back.where("Description like 'two\\nlines, \"quoted\"'").count() == 10
    with pytest.raises(ValueError, match="line break"):
        jobs.run_feeder(spark, str(tmp_path / "in"), str(tmp_path / "b2"), 2025, 1, multi_line=False)


def test_days_with_different_columns(spark, tmp_path):
    path = str(tmp_path / "b")
    for day, cols in (("2025-01-01", {"ID": "a", "x": "1"}), ("2025-01-02", {"ID": "b", "City": "Y"})):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()], F.lit(day).cast("date").alias("bronze_date"))
        store.write_bronze(df, path)
    got = {r.ID: (r.x, r.City) for r in store.read_bronze(spark, path).collect()}
    assert got == {"a": ("1", None), "b": (None, "Y")}
    assert store.read_bronze(spark, path, "2025-01-01").first().City is None


def test_missing_store_has_no_days_but_other_errors_show(spark, tmp_path):
    assert store.existing_days(spark, str(tmp_path / "none")) == []
    spark.range(1).write.parquet(str(tmp_path / "odd"))
    with pytest.raises(Exception):
        store.existing_days(spark, str(tmp_path / "odd"))


def test_dedup_without_seq_prefers_complete_rows(spark):
    rows = [("k", None, "b"), ("k", "z", "b"), ("m", None, "a"), ("m", None, None)]
    df = spark.createDataFrame(rows, "ID string, x string, y string")
    out = sorted(tuple(r) for r in silver.dedup_by_key(df, ["ID"]).collect())
    assert out == [("k", "z", "b"), ("m", None, "a")]
    assert silver.dropna_any(silver.dedup_by_key(df, ["ID"])).count() == 1


def test_split_of_one_csv_by_file_order(spark, tmp_path):
    src = tmp_path / "export.csv"
    src.write_text("ID,Note\n" + "".join(f'A-{i},"n{i}{chr(10) if i % 7 == 0 else " "}x"\n' for i in range(100)))
    paths = jobs.run_split(spark, str(src), str(tmp_path / "days"))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["01-01-2025.csv", "02-01-2025.csv", "03-01-2025.csv"]
    ids = [sorted(int(r.ID[2:]) for r in csv_batches.read_csv_batch(spark, p).collect()) for p in paths]
    assert ids == [list(range(33)), list(range(33, 66)), list(range(66, 100))]


def test_marts_from_the_shared_base_equal_the_direct_ones(spark, sf_small):
    acc = Q.accidents(spark, sf_small)
    direct = (gold.mart_by_region(acc), gold.mart_by_hour_severity(acc), gold.mart_by_weather(acc))
    for (name, mart), want in zip(gold.build_gold(acc).items(), direct, strict=True):
        assert mart.columns == want.columns, name
        assert sorted(map(str, mart.collect())) == sorted(map(str, want.collect())), name


def test_model_split_does_not_depend_on_partitions(spark, sf_small):
    frame = features.feature_frame(Q.joined(spark, sf_small))
    parts = [{r.ID for r in model.split(frame.repartition(n))[0].select("ID").collect()} for n in (1, 7)]
    n = frame.count()
    assert parts[0] == parts[1] and 0.7 * n < len(parts[0]) < 0.9 * n


def test_saved_model_scores_joined_silver_and_accuracies_agree(spark, sf_small, tmp_path):
    joined = materialize(Q.joined(spark, sf_small))
    trained = model.train_model(joined)
    path = model.save_pipeline(trained.pipeline, str(tmp_path / "m"))
    scored = PipelineModel.load(path).transform(joined.drop("Severity")).select("ID", "prediction")
    both = trained.predictions.select("ID", F.col("prediction").alias("p")).join(scored, "ID")
    assert both.count() == trained.test.count() and both.where("p <> prediction").count() == 0
    assert model.accuracy(trained.predictions).first().accuracy == pytest.approx(model.accuracy_value(trained.predictions))


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_streamed_bronze_feeds_silver(spark, sf_small, tmp_path):
    from roadlake.streaming.bronze_stream import ingest_available

    b = Q.batches(spark, sf_small).drop("seq")
    csv_batches.write_daily_batches(b, str(tmp_path / "in"))
    cols = [n for n in b.columns if n not in ("batch", "situation_date")]
    ingest_available(spark, str(tmp_path / "in"), cols, str(tmp_path / "bronze"), str(tmp_path / "ck"))
    jobs.run_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), schema="stream_s")
    days = _per_day(spark, str(tmp_path / "silver" / "accidents"))
    want = silver.conform_accidents(store.read_bronze(spark, str(tmp_path / "bronze"), "2025-01-03")).count()
    assert sorted(days) == ["2025-01-01", "2025-01-02", "2025-01-03"] and days["2025-01-03"] == want > 0


def test_commands_as_separate_processes(spark, sf_small, tmp_path):
    raw = Q.raw(spark, sf_small).orderBy("seq").drop("seq")
    raw.toDF(*[Q.RAW_HEADERS.get(n, n) if n != "Description" else n for n in raw.columns]).coalesce(1).write.option(
        "header", "true").option("escape", '"').csv(str(tmp_path / "export"))
    lake = tmp_path / "lake"
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[4] --conf spark.ui.enabled=false "
                        f"--conf spark.sql.warehouse.dir={tmp_path / 'wh'} pyspark-shell"}

    def run(*args):
        p = subprocess.run([sys.executable, "-m", "roadlake.plans.cli", *args], env=env, cwd=tmp_path,
                           capture_output=True, text=True, timeout=300)
        assert p.returncode == 0, p.stderr[-3000:]
        return json.loads(p.stdout[p.stdout.index("{"):])

    run("split", "--input", str(tmp_path / "export"), "--output", str(lake / "data"))
    fed = run("feeder", "--input", str(lake / "data"), "--bronze", str(lake / "bronze"), "--year", "2025", "--month", "1")
    assert fed["written_days"] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    run("silver", "--bronze", str(lake / "bronze"), "--silver", str(lake / "silver"))
    run("snapshot", "--silver", str(lake / "silver"), "--output", str(lake / "copy"))
    run("gold", "--silver", str(lake / "silver"), "--gold", str(lake / "gold"))
    k = run("kpis", "--gold", str(lake / "gold"))
    assert k["global"][0]["total_accidents"] == spark.read.parquet(str(lake / "copy" / "accidents")).count()
    assert len(k["top_regions"]) == 5
    assert run("train", "--silver", str(lake / "silver"), "--model", str(lake / "model"))["n_train"] > 0
