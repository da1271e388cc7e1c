"""Registered queries: oracles on driver tables, contracts of columns, the pipeline's stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from check_oracle import TABLES, _rows
from roadlake.llm import decontamination, queries, simhash

SQL = queries.oracle_queries()
COLUMNS = {
    "op1_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6_embedding_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op8_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op11_clustering": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    "op12_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op13_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op10_simhash": "doc_id bigint, fingerprint string, component_id bigint",
}


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, f'{t}.parquet')}')")
    return con


def test_one_query_of_each_number():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.registry()) == list(range(1, 14))
    assert set(SQL) <= set(queries.registry())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_small, name):
    df = queries.registry()[name](spark, sf_small)
    got = ", ".join(f"{c} {t}" for c, t in df.dtypes)
    assert got.startswith(COLUMNS[name])


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, sf_small, duck, name):
    df = queries.registry()[name](spark, sf_small)
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows([tuple(r) for r in df.collect()], df.columns, 9) == _rows(cur.fetchall(), names, 9)


def test_pipeline_stages(spark, sf_small, documents):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(documents([(None, None), (7001, ""), (7002, 'x token = "0123456789abcdef0123456789abcdef01234567" y')]))
    (_, quality), (_, near), (_, decontaminate), (_, secrets), (_, pack) = corpus_pipeline.STAGES
    row = lambda r: (r.doc_id, r.text)

    kept = quality(spark, docs, sf_small)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()

    one = near(spark, docs, sf_small)
    assert one.columns == docs.columns
    groups = simhash.simhash_groups(docs).select("component_id", "fingerprint").distinct().collect()
    assert one.count() == len({r.component_id if r.component_id is not None else r.fingerprint for r in groups})

    clean = decontaminate(spark, docs, sf_small)
    benchmark = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    hit = {r.doc_id for r in decontamination.decontaminate(docs, benchmark).where("n_hit > 0").collect()}
    want = [row(r) for r in docs.collect() if r.doc_id not in hit]
    assert sorted(map(str, map(row, clean.collect()))) == sorted(map(str, want)) and hit

    masked = secrets(spark, docs, sf_small)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert not masked.where("text rlike 'token = \"[0-9a-f]{40}'").count()
    assert masked.where("text like '%[SECRET]%'").count()

    packed = pack(spark, docs, sf_small)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_run(spark, sf_small):
    df = corpus_pipeline.run(spark, sf_small)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and df.count() > 0
