"""Every registered query against its DuckDB oracle, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, _rows
from roadlake.plans.oracle import oracle_queries
from roadlake.plans.queries import registry

SQL = oracle_queries()
KEYS = sorted(registry())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_small, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle_or_is_ml():
    rows_only = {k for k in KEYS if k not in SQL}
    assert rows_only == {"rf_predictions", "rf_accuracy"}
    assert set(SQL) <= set(KEYS)


@pytest.mark.parametrize("key", [k for k in KEYS if k in SQL])
def test_query_matches_oracle(spark, sf_small, duck, key):
    df = E.queries()[key](spark, sf_small)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[key])
    want = cur.fetchall()
    want_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _rows(got, df.columns, 9) == _rows(want, want_cols, 9)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["State", "County", "accidents"]
    assert 0 < df.count() <= 5


@pytest.mark.parametrize("key", ["silver_accidents", "mart_by_region", "mart_by_hour_severity", "date_parts"])
def test_results_do_not_depend_on_session_time_zone(spark, sf_small, key):
    q = E.queries()[key]
    base = sorted(map(tuple, q(spark, sf_small).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        shifted = sorted(map(tuple, q(spark, sf_small).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert shifted == base
