"""A folder of day-partitioned tables, published as one version.

A run writes its days under ``_data/<table>/run=<run>/bronze_date=<day>`` and
then one manifest, ``_manifest/v=<n>``, which names for every table and day the
run that holds it.  The manifest is one file that Spark's committer moves into
place at the end; readers take the newest one, so they see all tables of the old
version or all of the new one, and a run that fails leaves nothing that is read.
A run of one day names the other days' runs again instead of copying them.

Row and NULL counts of every day are observed while it is written and stored in
the manifest, so profiles of the tables need no scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.functions.columns import c

DAY = "bronze_date"
#: Days written, and observed, by one job.
DAYS_A_JOB = 31


def latest(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest of ``root`` with its ``version``; None if nothing was published there."""
    try:
        files = spark.read.text(f"{root.rstrip('/')}/_manifest", wholetext=True)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if "v" not in files.columns:
        return None
    newest = files.orderBy(F.desc("v")).head(1)
    return json.loads(newest[0].value) | {"version": newest[0].v} if newest else None


def publish(spark: SparkSession, root: str, tables: dict, **notes) -> int:
    """Make ``tables`` the newest version; fails if another run has published meanwhile."""
    now = latest(spark, root)
    number = now["version"] + 1 if now else 1
    line = json.dumps({"tables": tables, **notes})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("error").text(
        f"{root.rstrip('/')}/_manifest/v={number}")
    return number


def new_run() -> str:
    return f"r{uuid.uuid4().hex[:12]}"


def day_folder(root: str, name: str, run: str, day: str) -> str:
    return f"{root.rstrip('/')}/_data/{name}/run={run}/{DAY}={day}"


def write_days(df: DataFrame, root: str, name: str, run: str, days: Sequence[str]) -> dict:
    """Write the given days of ``df``; returns the table's part of a manifest, without the days that have no row.

    One job for each DAYS_A_JOB days, which also counts their rows and NULLs.
    """
    columns = [n for n in df.columns if n != DAY]
    found: dict[str, dict] = {}
    for at in range(0, len(days), DAYS_A_JOB):
        some = list(days[at : at + DAYS_A_JOB])
        part = df if len(days) == 1 else df.where(F.col(DAY).isin([F.lit(d).cast("date") for d in some]))
        seen = Observation()
        here = {i: F.col(DAY) == F.lit(d).cast("date") for i, d in enumerate(some)}
        rows = [F.count_if(on).alias(f"n{i}") for i, on in here.items()]
        nulls = [F.count_if(on & c(n).isNull()).alias(f"c{i}_{j}") for i, on in here.items() for j, n in enumerate(columns)]
        (part.observe(seen, *rows, *nulls).write.mode("append").partitionBy(DAY)
         .parquet(f"{root.rstrip('/')}/_data/{name}/run={run}"))
        counts = seen.get
        for i, d in enumerate(some):
            if counts[f"n{i}"]:
                found[d] = {"run": run, "rows": counts[f"n{i}"],
                            "nulls": {n: counts[f"c{i}_{j}"] for j, n in enumerate(columns)}}
    return {"schema": df.select(*[c(n) for n in columns], DAY).schema.jsonValue(), "days": found}


def schema_of(entry: dict) -> T.StructType:
    return T.StructType.fromJson(entry["schema"])


def read_table(spark: SparkSession, root: str, name: str, manifest: dict, day: str | None = None) -> DataFrame:
    """All days of a published table, or one: only these days' folders are listed and read."""
    entry = manifest["tables"][name]
    days = {d: x["run"] for d, x in entry["days"].items() if day is None or d == str(day)}
    schema = schema_of(entry)
    if not days:
        return spark.createDataFrame([], schema)
    # the order of columns is that of the schema, whatever the folders say
    paths = [day_folder(root, name, run, d) for d, run in sorted(days.items())]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())]))
    return rows.option("basePath", f"{root.rstrip('/')}/_data/{name}").parquet(*paths).select(*[c(n) for n in schema.names])


def column_profile(spark: SparkSession, manifest: dict, day: str | None = None) -> DataFrame:
    """(table_name, position, column_name, data_type, null_count, n_rows) of the published tables, or of one day of
    them, from the counts observed when they were written: no table is read."""
    rows = []
    for name, entry in manifest["tables"].items():
        days = [x for d, x in entry["days"].items() if day is None or d == str(day)]
        total = sum(x["rows"] for x in days)
        for i, field in enumerate(f for f in schema_of(entry).fields if f.name != DAY):
            nulls = sum(x["nulls"][field.name] for x in days)
            rows.append((name, i + 1, field.name, field.dataType.simpleString(), nulls, total))
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, null_count long, n_rows long")


def vacuum(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete runs that none of the newest ``keep`` versions names, and the older manifests; returns their folders.

    For a time when no run is writing: a run's folders are named only once it has published.
    """
    base = root.rstrip("/")
    newest = latest(spark, base)
    if newest is None:
        return []
    files = spark.read.text(f"{base}/_manifest", wholetext=True).orderBy(F.desc("v")).collect()  # one row a version
    held = {(n, x["run"]) for f in files[:keep] for n, e in json.loads(f.value)["tables"].items() for x in e["days"].values()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = [f"{base}/_manifest/v={f.v}" for f in files[keep:]]
    for name in newest["tables"]:
        path = hadoop.Path(f"{base}/_data/{name}")
        fs = path.getFileSystem(conf)
        runs = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        gone += [f"{base}/_data/{name}/{r}" for r in runs if (name, r.removeprefix("run=")) not in held]
    for folder in gone:
        path = hadoop.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return gone
