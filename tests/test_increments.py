"""Days added without double counting, marts kept by merging, the forest as a table."""

import shutil

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roadlake.operators import forest, gold, increments, model
from roadlake.plans import jobs
from roadlake.plans import queries as Q
from roadlake.sources import store


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("words", [1, 64, 4096])
def test_the_filter_loses_no_key_and_the_join_is_exact(spark, words):
    keys = spark.range(0, 3000, 2).select(F.concat(F.lit("A-"), "id").alias("ID"))
    rows = spark.range(0, 4000).select(F.concat(F.lit("A-"), "id").alias("ID"), F.col("id").alias("n")).unionByName(spark.createDataFrame([(None, -1)], "ID string, n long"))
    filters = increments.key_filter(keys, words=words).unionByName(increments.key_filter(keys.limit(0), words=words))
    marked = increments.flagged(rows, filters, words=words)
    assert marked.join(keys, "ID").where("not _maybe").count() == 0
    kept = sum(not r._maybe for r in marked.collect())
    assert kept > 2000 if words == 4096 else kept >= 0  # a filter of a fitting size spares the join most new rows
    got = {r.n for r in increments.unseen(rows, keys, filters, words=words).collect()}
    assert got == {-1, *(i for i in range(4000) if i >= 3000 or i % 2)}
    assert increments.key_filter(keys, words=words).count() <= words


@pytest.fixture()
def bronze(spark, sf_small, tmp_path):
    return store.write_bronze(Q.cumulative(spark, sf_small), str(tmp_path / "bronze"))


def _gold(spark, root):
    return {n: _rows(spark.read.parquet(f"{root}/{n}")) for n in ("accidents_by_region", "accidents_by_hour_severity", "accidents_by_weather")}


def test_one_day_again_equals_a_rebuild_and_reads_one_day(spark, bronze, tmp_path):
    state, marts = str(tmp_path / "state"), str(tmp_path / "gold")
    assert jobs.refresh_gold(spark, bronze, state, marts) == ["2025-01-01", "2025-01-02", "2025-01-03"]
    whole = _gold(spark, marts)
    direct = gold.build_gold(store.read_bronze(spark, f"{state}/accidents").drop("bronze_date"))
    assert {n: _rows(df) for n, df in direct.items()} == whole
    # the same rows for a day change nothing later; only that day is worked out
    assert jobs.refresh_gold(spark, bronze, state, marts, ["2025-01-02"]) == ["2025-01-02"]
    assert _gold(spark, marts) == whole
    # a day with other keys: later days are looked at again, earlier ones are not
    less = store.read_bronze(spark, bronze, "2025-01-02").where("ID <= 'A-5'").withColumn("Severity", F.lit("4"))
    moved = str(tmp_path / "moved")
    shutil.copytree(bronze, moved)
    store.write_bronze(less, moved)
    assert jobs.refresh_gold(spark, moved, state, marts, ["2025-01-02"]) == ["2025-01-02", "2025-01-03"]
    jobs.refresh_gold(spark, moved, str(tmp_path / "state2"), str(tmp_path / "gold2"))
    assert _gold(spark, marts) == _gold(spark, str(tmp_path / "gold2")) != whole
    plan = store.read_bronze(spark, bronze, "2025-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bronze_date" in plan and "(bronze_date#" in plan  # other days' rows are not read
    with pytest.raises(ValueError):
        jobs.refresh_gold(spark, bronze, state, marts, ["2024-12-31"])


def test_a_key_of_two_days_counts_on_the_first(spark, sf_small, tmp_path):
    raw = Q.raw(spark, sf_small).where("Severity in ('1', '2', '3', '4')")
    twice = [raw.withColumn("situation_date", F.lit(d).cast("date")).withColumn("bronze_date", F.lit(d).cast("date")) for d in ("2025-01-01", "2025-01-02")]
    path = store.write_bronze(twice[0].unionByName(twice[1]), str(tmp_path / "b"))
    jobs.refresh_gold(spark, path, str(tmp_path / "s"), str(tmp_path / "g"), words=8)
    per_day = {str(r[0]): r[1] for r in store.read_bronze(spark, str(tmp_path / "s" / "accidents")).groupBy("bronze_date").count().collect()}
    assert list(per_day) == ["2025-01-01"] and per_day["2025-01-01"] > 300


@pytest.fixture(scope="module")
def trained(spark, sf_small, tmp_path_factory):
    t = model.train_model(Q.joined(spark, sf_small))
    return t, forest.save_forest(spark, t.forest, str(tmp_path_factory.mktemp("forest") / "f")).cache()


def test_the_table_votes_as_the_forest(trained):
    t, table = trained
    both = forest.score(t.predictions, table, prediction_col="mine").withColumn("theirs", vector_to_array("rawPrediction"))
    rows = both.collect()
    assert len(rows) > 50 and all(r.mine == r.prediction and r.votes == r.theirs for r in rows)
    as_array = t.predictions.withColumn("features", vector_to_array("features")).drop("prediction")
    assert [r.prediction for r in forest.score(as_array, table).collect()] == [r.prediction for r in rows]
    none = forest.score(as_array.withColumn("features", F.lit(None).cast("array<double>")).limit(1), table).first()
    assert none.votes is None and none.prediction is None


def test_nodes_have_the_gini_and_gain_of_their_counts(trained):
    _, table = trained
    nodes = {(r.tree, r.node): r for r in table.collect()}
    gini = lambda c: 1 - sum((x / sum(c)) ** 2 for x in c)
    depth = {(t, 0): 0 for t in {t for t, _ in nodes}}
    inner = categorical = 0
    for (t, n), r in sorted(nodes.items()):
        assert r.impurity == pytest.approx(gini(r.counts)) and sum(r.shares) == pytest.approx(1)
        if r.feature == forest.LEAF:
            continue
        a, b = nodes[t, r.left], nodes[t, r.right]
        depth[t, r.left] = depth[t, r.right] = depth[t, n] + 1
        total = sum(r.counts)
        assert [x + y for x, y in zip(a.counts, b.counts)] == pytest.approx(r.counts)
        assert r.gain == pytest.approx(r.impurity - sum(sum(k.counts) / total * k.impurity for k in (a, b)), abs=1e-9)
        inner, categorical = inner + 1, categorical + (r.categories is not None)
        assert (r.threshold is None) == (r.categories is not None)
    assert len(depth) == len(nodes) and max(depth.values()) <= 5 and inner > categorical > 0 and {t for t, _ in nodes} == set(range(model.NUM_TREES))
