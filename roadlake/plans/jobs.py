"""End-to-end jobs: CSV -> Bronze -> Silver -> Gold -> KPIs, and model training.

Each job takes the caller's session and paths; none stops the session.

* ``run_split``    one CSV -> daily CSV batches, in file order
* ``run_feeder``   daily CSV files -> Bronze (one scan of all picked files)
* ``run_silver``   Bronze -> the three Silver tables, per Bronze day
* ``run_snapshot`` one day of Silver -> plain parquet copies
* ``build_gold``   Silver accidents -> the three marts (+ optional JDBC export)
* ``refresh_gold`` Bronze days -> marts kept by adding days
* ``kpis``         Gold marts -> KPI frames
* ``run_training`` Silver -> fitted pipeline, accuracy, saved model

Idempotence: every write replaces exactly the Bronze/Silver days it covers
(dynamic partition overwrite), so a rerun after a lost executor or a failed
run rewrites the same partitions instead of appending duplicates.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake import schema as schema_contract
from roadlake.operators import bronze, features, gold, increments, kpi, model, silver, split
from roadlake.session import materialize
from roadlake.sources import catalog, csv_batches, quoted_csv, sinks, store, versions

log = logging.getLogger(__name__)

SILVER_TABLES = ("accidents", "weather", "road_features")


@dataclass
class FeederReport:
    files: list[str]
    written_days: list[str]
    bronze_path: str


def run_split(spark: SparkSession, input_csv: str, output_dir: str, n_batches: int = 3,
              start_date: str = "2025-01-01", multi_line: bool = True) -> list[str]:
    """Cut one CSV, in the order of its rows, into ``n_batches`` dated daily batches.

    The file is read by many tasks either way; ``multi_line`` lets quoted cells hold line breaks.
    """
    if multi_line:
        rows, order = quoted_csv.read_quoted_csv(spark, input_csv), quoted_csv.ORDER
    else:
        csv_batches.refuse_line_breaks(spark, input_csv)
        rows, order = csv_batches.with_file_order(csv_batches.csv_reader(spark, multi_line=False).csv(input_csv))
    batches = split.ordered_split(rows, order, n_batches, start_date)
    return csv_batches.write_daily_batches(batches.drop(*order), output_dir)


def run_feeder(spark: SparkSession, input_dir: str, bronze_path: str, year: int, month: int,
               n_batches: int = 3, multi_line: bool = True, allow_empty: bool = False) -> FeederReport:
    """Load the first ``n_batches`` daily files of a month into Bronze.

    Days already in Bronze are not rewritten but still accumulate into the
    last day, which is always rewritten and holds every picked batch.  Each
    batch is read, stamped with its day and unioned by column name.  Without
    a batch of that month it raises, unless ``allow_empty``.
    """
    picked = csv_batches.select_batches(csv_batches.list_csv_files(spark, input_dir), year, month, n_batches)
    plan = picked.orderBy("batch").collect()  # at most n_batches file names
    if not plan:
        if not allow_empty:
            raise FileNotFoundError(f"no daily batch of {year}-{month:02d} in {input_dir}")
        return FeederReport([], [], bronze_path)
    last_day = plan[-1].situation_date
    existing = store.existing_days(spark, bronze_path)
    todo = [r.situation_date for r in plan
            if str(r.situation_date) not in existing or r.situation_date == last_day]
    rows = csv_batches.read_dated_batches(spark, [(r.path, r.situation_date) for r in plan], multi_line=multi_line)
    stored = bronze.bronze_cumulative(rows, last_day).filter(F.col(store.BRONZE_PARTITION).isin(todo))
    store.write_bronze(stored, bronze_path)
    return FeederReport([r.file_name for r in plan], [str(d) for d in todo], bronze_path)


def conform_all(bronze_rows: DataFrame, group_cols=(store.BRONZE_PARTITION,)) -> dict[str, DataFrame]:
    """The three Silver tables of a Bronze frame (dedup scoped by ``group_cols``).

    No cache of Bronze: each table reads only its own columns from parquet,
    which is cheaper than holding every column in memory.
    """
    group_cols = [g for g in group_cols if g in bronze_rows.columns]
    return {
        "accidents": silver.conform_accidents(bronze_rows, group_cols=group_cols),
        "weather": silver.conform_weather(bronze_rows, group_cols=group_cols),
        "road_features": silver.conform_road(bronze_rows, group_cols=group_cols),
    }


def run_silver(spark: SparkSession, bronze_path: str, silver_root: str, schema: str = "silver",
               day: str | None = None) -> dict[str, str]:
    """Conform Bronze (all days, or one) into Silver tables by Bronze day, and publish the three as one version.

    The dedup's shuffle is the only one of a table, and its tasks write the day
    folders; a job takes up to a month of days and counts their rows and NULLs
    as it writes.  Readers see the new version once all three tables are there,
    and the old one if the run fails before.  A full run's version holds just
    the days of Bronze; a run of one day takes the other days from the version
    before.  The tables are also defined in ``schema``, which must not name
    tables stored elsewhere.  Returns table -> path.
    """
    days = store.existing_days(spark, bronze_path)
    if day is not None and day not in days:
        raise ValueError(f"Bronze {bronze_path} has no day {day}")
    rows = store.read_bronze(spark, bronze_path, day)
    catalog.reset_schema(spark, schema, [])
    root = silver_root.rstrip("/")
    paths = {name: f"{root}/{name}" for name in SILVER_TABLES}
    for name, path in paths.items():
        catalog.check_location(spark, f"`{schema}`.`{name}`", path)
    before = versions.latest(spark, root) if day else None
    run = versions.new_run()
    tables = {}
    for name, df in conform_all(rows).items():
        entry = versions.write_days(df, root, name, run, [day] if day else days)
        if before and name in before["tables"]:
            kept = {d: x for d, x in before["tables"][name]["days"].items() if d != day}
            entry["days"] = kept | entry["days"]
        tables[name] = entry
    versions.publish(spark, root, tables, cumulative=_is_cumulative(spark, bronze_path, days))
    for name, entry in tables.items():
        folders = {d: versions.day_folder(root, name, x["run"], d) for d, x in entry["days"].items()}
        catalog.register_days(spark, f"`{schema}`.`{name}`", paths[name], versions.schema_of(entry), folders)
    return paths


def _is_cumulative(spark: SparkSession, bronze_path: str, days: list[str]) -> bool:
    """Whether the last Bronze day holds the other days' batches too; one day alone does."""
    last = store.read_bronze(spark, bronze_path, days[-1]) if days else None
    if last is None or len(days) == 1 or "situation_date" not in last.columns:
        return True
    return bool(last.where(F.col("situation_date") != F.col(store.BRONZE_PARTITION)).head(1))


def silver_snapshot(spark: SparkSession, silver_root: str, day: str | None = None) -> dict[str, DataFrame]:
    """Silver as the marts see it: one Bronze day (default: the latest, which holds everything).

    If the last day of Bronze holds only its own batch, as a streamed Bronze
    does, the default is all days, of each key the row that a dedup over all
    of them keeps.  Read by folder, so any process can; only the days' own
    files are read.
    """
    manifest = versions.latest(spark, silver_root)
    out = {}
    for name in SILVER_TABLES:
        path = f"{silver_root.rstrip('/')}/{name}"
        days = store.existing_days(spark, path)
        if day is None and manifest and not manifest.get("cumulative", True):
            rows = store.read_bronze(spark, path).drop(store.BRONZE_PARTITION)
            out[name] = silver.dedup_by_key(rows, [schema_contract.KEY])
            continue
        pick = day or (days[-1] if days else None)
        if pick not in days:
            raise ValueError(f"Silver {path} has no day {pick}")
        out[name] = store.read_bronze(spark, path, pick).drop(store.BRONZE_PARTITION)
    return out


def silver_profile(spark: SparkSession, silver_root: str, day: str | None = None) -> DataFrame:
    """Columns, row and NULL counts of the published Silver (or one day of it), counted when it was written."""
    manifest = versions.latest(spark, silver_root)
    if manifest is None:
        raise ValueError(f"{silver_root} holds no published Silver")
    return versions.column_profile(spark, manifest, day)


def run_snapshot(spark: SparkSession, silver_root: str, output_root: str, day: str | None = None) -> dict[str, str]:
    """Copy one day of each Silver table to ``output_root``; one failing table does not stop the others."""
    return catalog.snapshot_tables(spark, silver_snapshot(spark, silver_root, day), output_root)


@dataclass
class GoldReport:
    paths: dict[str, str] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def build_gold(accidents: DataFrame, gold_root: str, jdbc_url: str | None = None,
               jdbc_properties: dict | None = None, jdbc_mode: str = "overwrite") -> GoldReport:
    """Write the three marts; one failing mart or export does not stop the others.

    Per-incident rows are read once, into one stored aggregate that the three
    marts roll up.  Raises at the end if anything failed.
    """
    base = materialize(gold.base_counts(accidents))
    report = GoldReport()
    for name, mart in gold.marts_from_base(base).items():
        path = f"{gold_root.rstrip('/')}/{name}"
        try:
            store.write_parquet(mart, path)
            report.paths[name] = path
        except Exception as exc:  # noqa: BLE001 - isolate marts
            log.error("mart %s failed: %s", name, exc)
            report.failures[name] = str(exc)
            continue
        if jdbc_url:
            err = sinks.jdbc_write(mart.sparkSession.read.parquet(path), jdbc_url, f"gold_{name}",
                                   jdbc_properties, mode=jdbc_mode)
            if err:
                report.failures[f"jdbc:{name}"] = err
    if report.failures:
        raise RuntimeError(f"gold build incomplete: {report.failures}")
    return report


def refresh_gold(spark: SparkSession, bronze_path: str, state_root: str, gold_root: str,
                 days: list[str] | None = None, words: int = increments.WORDS) -> list[str]:
    """Keep the marts by adding days: a key counts on the first day that has it.

    Of each Bronze day ``state_root`` stores the accidents whose keys no
    earlier day has, these keys with their filter, and the mergeable counts of
    the marts.  Without ``days`` every day is worked out; otherwise these, and
    later ones only if a day's keys have changed.  The marts are then summed
    from the counts of all days; no other day's rows are read.  Returns the
    days worked out.
    """
    root = state_root.rstrip("/")
    every = store.existing_days(spark, bronze_path)
    if unknown := set(days or []) - set(every):
        raise ValueError(f"Bronze {bronze_path} has no day {sorted(unknown)}")
    done, changed = [], False
    for day in every:
        if days is not None and day not in days and not changed:
            continue
        own = store.read_bronze(spark, bronze_path, day)
        if "situation_date" in own.columns:  # the last day holds every batch
            own = own.where(F.col("situation_date") == F.col(store.BRONZE_PARTITION))
        fresh = silver.conform_accidents(own)
        if earlier := [d for d in store.existing_days(spark, f"{root}/keys") if d < day]:
            before = F.col(store.BRONZE_PARTITION) < F.lit(day).cast("date")
            keys, filters = (store.read_bronze(spark, f"{root}/{n}").where(before) for n in ("keys", "filters"))
            fresh = increments.unseen(fresh, keys, filters, words=words)
        fresh = materialize(fresh)
        old = _mark(spark, f"{root}/keys", day)
        parts = {"accidents": fresh, "keys": fresh.select(schema_contract.KEY),
                 "filters": increments.key_filter(fresh, words=words), "counts": gold.base_counts(fresh)}
        for name, df in parts.items():
            _replace_day(spark, df, f"{root}/{name}", day)
        changed = changed or old != _mark(spark, f"{root}/keys", day)
        done.append(day)
    counts = store.read_bronze(spark, f"{root}/counts").drop(store.BRONZE_PARTITION)
    for name, mart in gold.marts_from_base(counts).items():
        store.write_parquet(mart, f"{gold_root.rstrip('/')}/{name}")
    return done


def _replace_day(spark: SparkSession, df: DataFrame, path: str, day: str) -> None:
    """Put ``df`` in place of one day's folder, an empty one too."""
    df.write.mode("overwrite").parquet(f"{path}/{store.BRONZE_PARTITION}={day}")


def _mark(spark: SparkSession, path: str, day: str) -> tuple | None:
    """Number and hash sum of a day's keys."""
    if day not in store.existing_days(spark, path):
        return None
    keys = store.read_bronze(spark, path, day)
    return tuple(keys.agg(F.count("*"), F.sum(F.xxhash64(schema_contract.KEY).cast("decimal(38,0)"))).first())


def kpis(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    root = gold_root.rstrip("/")
    by_region = spark.read.parquet(f"{root}/accidents_by_region")
    by_hour = spark.read.parquet(f"{root}/accidents_by_hour_severity")
    by_weather = spark.read.parquet(f"{root}/accidents_by_weather")
    return {
        "global": kpi.kpi_global(by_region),
        "top_regions": kpi.kpi_top_regions(by_region),
        "top_cities": kpi.kpi_top_cities(by_region),
        "region_labels": kpi.kpi_region_labels(by_region),
        "by_hour": kpi.kpi_by_hour(by_hour),
        "by_severity": kpi.kpi_by_severity(by_hour),
        "by_weather": kpi.kpi_by_weather(by_weather),
        "max_hour": kpi.kpi_max_hour(by_hour),
    }


@dataclass
class TrainingReport:
    accuracy: float
    n_train: int
    n_test: int
    features: list[str]
    model_path: str | None


def run_training(accidents: DataFrame, weather: DataFrame, road: DataFrame,
                 model_path: str | None = None) -> TrainingReport:
    joined = features.join_silver(accidents, weather, road)
    trained = model.train_model(joined)
    acc = model.accuracy_value(trained.predictions)
    n_train, n_test = trained.train.count(), trained.test.count()
    if model_path:
        model.save_pipeline(trained.pipeline, model_path)
    return TrainingReport(acc, n_train, n_test, trained.features, model_path)
