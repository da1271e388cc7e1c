"""Command line for the end-to-end jobs (run with ``spark-submit`` or ``python -m``).

    python -m roadlake.plans.cli split    --input export.csv --output data --start-date 2025-01-01
    python -m roadlake.plans.cli feeder   --input data --bronze lake/bronze --year 2025 --month 1
    python -m roadlake.plans.cli silver   --bronze lake/bronze --silver lake/silver
    python -m roadlake.plans.cli snapshot --silver lake/silver --output lake/silver-copy
    python -m roadlake.plans.cli gold     --silver lake/silver --gold lake/gold [--jdbc-url URL --jdbc-prop k=v ...]
    python -m roadlake.plans.cli kpis     --gold lake/gold
    python -m roadlake.plans.cli train    --silver lake/silver --model lake/model
    python -m roadlake.plans.cli explore  --silver lake/silver
    python -m roadlake.plans.cli ingest   --input data --bronze lake/bronze-stream --checkpoint lake/ck

Every command may be a process of its own: Silver and Gold are found by folder.
The session comes from ``SparkSession.builder.getOrCreate()`` (master, memory
and the rest from ``spark-submit``); it is not stopped here.  JDBC options
come only from the command line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roadlake.operators import profile
from roadlake.plans import jobs
from roadlake.session import drop_scratch
from roadlake.sources import store, versions


def _props(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _line_option(p: argparse.ArgumentParser) -> None:
    p.add_argument("--single-line", action="store_true",
                   help="no cell holds a line break: read large files by many tasks, fail if one does")


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="roadlake")
    sub = ap.add_subparsers(dest="command", required=True)
    p = sub.add_parser("split", help="one CSV, in file order -> dated daily batches")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--batches", type=int, default=3)
    p.add_argument("--start-date", default="2025-01-01")
    _line_option(p)
    f = sub.add_parser("feeder", help="daily CSV files -> Bronze")
    f.add_argument("--input", required=True)
    f.add_argument("--bronze", required=True)
    f.add_argument("--year", type=int, required=True)
    f.add_argument("--month", type=int, required=True)
    f.add_argument("--batches", type=int, default=3)
    f.add_argument("--allow-empty", action="store_true", help="no batch of the month is no error")
    _line_option(f)
    s = sub.add_parser("silver", help="Bronze -> Silver tables")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--schema", default="silver")
    s.add_argument("--day")
    n = sub.add_parser("snapshot", help="one day of Silver -> plain parquet copies")
    n.add_argument("--silver", required=True)
    n.add_argument("--output", required=True)
    n.add_argument("--day")
    g = sub.add_parser("gold", help="Silver -> Gold marts (+ JDBC export)")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--day")
    g.add_argument("--jdbc-url")
    g.add_argument("--jdbc-prop", action="append", help="connection property k=v (repeatable)")
    g.add_argument("--jdbc-mode", default="overwrite", choices=["overwrite", "append"])
    k = sub.add_parser("kpis", help="print the KPI answers")
    k.add_argument("--gold", required=True)
    t = sub.add_parser("train", help="fit and save the severity model")
    t.add_argument("--silver", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--day")
    e = sub.add_parser("explore", help="tables, columns, NULL counts and samples of Silver")
    e.add_argument("--silver", required=True)
    e.add_argument("--day")
    i = sub.add_parser("ingest", help="stream every new daily CSV batch into Bronze, then stop")
    i.add_argument("--input", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--cumulative", action="store_true", help="the last day holds every batch, as the feeder leaves it")
    i.add_argument("--columns", help="raw header, comma separated (default: read from one batch)")
    _line_option(i)
    return ap


def _raw_header(spark: SparkSession, folder: str) -> list[str]:
    """Header of one dated daily batch (reads one file's first line)."""
    from roadlake.sources.csv_batches import file_date, list_csv_files

    dated = list_csv_files(spark, folder).filter(file_date(F.col("file_name")).isNotNull())
    first = dated.orderBy("file_name", "path").first()
    if first is None:
        raise ValueError(f"no daily CSV batch under {folder}")
    return spark.read.option("header", "true").csv(first.path).columns


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"roadlake-{args.command}").getOrCreate()
    if args.command == "split":
        result = {"batches": jobs.run_split(spark, args.input, args.output, args.batches, args.start_date,
                                            multi_line=not args.single_line)}
    elif args.command == "feeder":
        rep = jobs.run_feeder(spark, args.input, args.bronze, args.year, args.month, args.batches,
                              multi_line=not args.single_line, allow_empty=args.allow_empty)
        result = {"files": rep.files, "written_days": rep.written_days}
    elif args.command == "silver":
        result = jobs.run_silver(spark, args.bronze, args.silver, args.schema, args.day)
    elif args.command == "snapshot":
        result = jobs.run_snapshot(spark, args.silver, args.output, args.day)
    elif args.command == "gold":
        snap = jobs.silver_snapshot(spark, args.silver, args.day)
        rep = jobs.build_gold(snap["accidents"], args.gold, args.jdbc_url, _props(args.jdbc_prop),
                              args.jdbc_mode)
        result = rep.paths
    elif args.command == "kpis":
        result = {}
        for name, df in jobs.kpis(spark, args.gold).items():
            rows = [r.asDict() for r in df.collect()]  # KPI answers: at most 24 rows each
            result[name] = rows
    elif args.command == "train":
        snap = jobs.silver_snapshot(spark, args.silver, args.day)
        rep = jobs.run_training(snap["accidents"], snap["weather"], snap["road_features"], args.model)
        result = {"accuracy": rep.accuracy, "n_train": rep.n_train, "n_test": rep.n_test,
                  "features": rep.features, "model": rep.model_path}
    elif args.command == "ingest":
        from roadlake.streaming.bronze_stream import ingest_available, ingest_cumulative
        cols = args.columns.split(",") if args.columns else _raw_header(spark, args.input)
        ingest = ingest_cumulative if args.cumulative else ingest_available
        q = ingest(spark, args.input, cols, args.bronze, args.checkpoint,
                   multi_line=not args.single_line)
        done = q.recentProgress
        result = {"columns": cols, "rows": sum(p["numInputRows"] for p in done),
                  "batches": [p["batchId"] for p in done]}
    else:  # explore
        snap = jobs.silver_snapshot(spark, args.silver, args.day)
        pick = args.day or store.existing_days(spark, f"{args.silver.rstrip('/')}/accidents")[-1]
        whole = versions.latest(spark, args.silver)
        if whole and (args.day or whole.get("cumulative", True)):  # counted when the day was written
            counted = jobs.silver_profile(spark, args.silver, pick).withColumn("non_null", F.col("n_rows") - F.col("null_count"))
            columns = counted.select("table_name", "position", "column_name", "data_type", "n_rows", "non_null")
        else:
            columns = profile.schema_profile(snap)
        result = {
            "tables": sorted(snap),
            "profile": [r.asDict() for r in columns.collect()],
            "samples": {n: [r.asDict() for r in profile.sample_rows(df).collect()] for n, df in snap.items()},
        }
    drop_scratch(spark)
    print(json.dumps(result, default=str, indent=1))
    return result


def run() -> int:
    """Console-script entry: exit status 0 on success (errors raise)."""
    main(sys.argv[1:])
    return 0


if __name__ == "__main__":
    sys.exit(run())
