"""Large CSV files with line breaks in cells: many tasks, the rows of the one-task read."""

import random

import pytest

from roadlake.sources import csv_batches, quoted_csv


@pytest.fixture()
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "40"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, rows, end="\n", bom=False):
    cells = lambda r: ",".join("" if c is None else f'"{c.replace(chr(34), chr(34) * 2)}"' if set(c) & set(',"\n\r') or c == "" else c for c in r)
    path.write_bytes((("﻿" if bom else "") + end.join(map(cells, rows)) + end).encode())
    return str(path)


def feed(seed, n):
    rng = random.Random(seed)
    cell = lambda: rng.choice([None, "", "x", 'say "hi"', "a,b", "two\nlines", "\n", '"', '""\n""', "é" * 9, "w" * rng.randrange(30), "l\n" * rng.randrange(1, 40)])
    return [["id", "Temp(F)", "note"], *([str(i), cell(), cell()] for i in range(n))]


def same_as_one_task(spark, path):
    got = quoted_csv.read_quoted_csv(spark, path)
    want = csv_batches.csv_reader(spark).csv(path)
    assert got.columns == [*quoted_csv.ORDER, *want.columns]
    rows = [tuple(r)[3:] for r in got.orderBy(*quoted_csv.ORDER).collect()]
    assert rows == [tuple(r) for r in want.collect()]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_many_blocks_equal_one_task(spark, tmp_path, small_blocks, seed):
    path = write(tmp_path / "a.csv", feed(seed, 250))
    assert quoted_csv._lines(spark, path).rdd.getNumPartitions() > 8
    assert len(same_as_one_task(spark, path)) == 250
    starts = quoted_csv.block_parity(quoted_csv._lines(spark, path)).collect()
    assert {r._open for r in starts} == {True, False}


def test_a_cell_longer_than_blocks(spark, tmp_path, small_blocks):
    path = write(tmp_path / "a.csv", [["id", "note"], ["1", "line, and \"more\"\n" * 400], ["2", "y"], ["3", "\n" * 1500]])
    assert len(same_as_one_task(spark, path)) == 3


def test_windows_line_ends_and_byte_order_mark(spark, tmp_path, small_blocks):
    rows = [["id", "note"], *([str(i), "a,b" if i % 3 else "p\nq"] for i in range(120))]
    got = quoted_csv.read_quoted_csv(spark, write(tmp_path / "a.csv", rows, end="\r\n", bom=True))
    assert got.columns[3:] == ["id", "note"]
    assert [tuple(r)[3:] for r in got.orderBy(*quoted_csv.ORDER).collect()] == [tuple(r) for r in rows[1:]]


def test_odd_quotes_are_read_by_one_task(spark, tmp_path, small_blocks):
    path = tmp_path / "a.csv"
    path.write_text('id,size\n1,5" pipe\n' + '2,"a\nb"\n' * 60 + '3,x"y"z\n')
    assert len(same_as_one_task(spark, str(path))) == 62


def test_header_alone_empty_lines_and_other_headers(spark, tmp_path):
    assert same_as_one_task(spark, write(tmp_path / "a.csv", [["id", "note"]])) == []
    (tmp_path / "b.csv").write_text('id,note\n\n1,"x\ny"\n\n2,\n')
    assert same_as_one_task(spark, str(tmp_path / "b.csv")) == [("1", "x\ny"), ("2", None)]
    (tmp_path / "c.csv").write_text("id,other\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        quoted_csv.read_quoted_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "c.csv")])
    two = quoted_csv.read_quoted_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], columns=["id", "note"])
    assert two.count() == 2


def test_split_reads_one_file_by_many_tasks(spark, tmp_path, small_blocks):
    from roadlake.plans import jobs

    path = write(tmp_path / "a.csv", [["ID", "Note"], *([f"A-{i}", f"n{i}\nx" if i % 7 == 0 else "y"] for i in range(300))])
    days = jobs.run_split(spark, path, str(tmp_path / "days"))
    ids = [sorted(int(r.ID[2:]) for r in csv_batches.read_csv_batch(spark, d).collect()) for d in days]
    assert ids == [list(range(100)), list(range(100, 200)), list(range(200, 300))]
