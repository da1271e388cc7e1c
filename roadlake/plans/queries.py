"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame``.

Every query starts from the driver's tables through the adapter and runs over
Queries that exercise a sink write to a fresh folder under the session's
shared checkpoint folder and return the data read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake import schema as S
from roadlake.functions.columns import (
    date_of, flag_to_int, hour_label, hour_of, month_of, normalized_text, severity_int, to_float, weekday_of)
from roadlake.operators import bronze, features, forest, gold, kpi, model, profile, silver, split
from roadlake.plans import jobs
from roadlake.session import materialize, scratch_path, scratch_schema, sf_table
from roadlake.sources import catalog, csv_batches, quoted_csv, store
from roadlake.sources.fixtures import incident_frame

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the batch fixtures: three daily batches from 2025-01-01,
# and the month whose batch files discovery picks in the driver's tables.
N_BATCHES = 3
FIRST_DAY = "2025-01-01"
LAST_DAY = "2025-01-03"
DISCOVERY_YEAR, DISCOVERY_MONTH = 2024, 1

# Raw headers as a CSV export spells them (test input for the name cleaner).
RAW_HEADERS = {
    "Temperature_F_": "Temperature(F)", "Humidity_pct_": "Humidity(%)", "Pressure_in_": "Pressure(in)",
    "Visibility_mi_": "Visibility(mi)", "Wind_Speed_mph_": "Wind_Speed(mph)",
    "Precipitation_in_": "Precipitation(in)", "Weather_Condition": "Weather.Condition",
    "Start_Lat": "Start Lat", "Description": "Description[raw]",
}
DROPPED_FOR_COMPLETION = ["Timezone", "Start_Lng", "Precipitation_in_", "Bump"]
DROPNA_SUBSET = ["Severity", "Start_Lat", "Temperature_F_", "Precipitation_in_"]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incident_frame(spark, sf_dir)


def accidents(spark, sf_dir):
    return silver.conform_accidents(raw(spark, sf_dir))


def weather(spark, sf_dir):
    return silver.conform_weather(raw(spark, sf_dir))


def road(spark, sf_dir):
    return silver.conform_road(raw(spark, sf_dir))


def stored_raw(spark, sf_dir) -> DataFrame:
    """The raw feed computed once and stored, as Bronze is in the real flow, for
    queries that build several Silver tables (each then reads it, no re-join)."""
    return materialize(raw(spark, sf_dir))


def silver_tables(spark, sf_dir) -> dict[str, DataFrame]:
    r = stored_raw(spark, sf_dir)
    return {"accidents": silver.conform_accidents(r), "weather": silver.conform_weather(r),
            "road_features": silver.conform_road(r)}


def by_region(spark, sf_dir):
    return gold.mart_by_region(accidents(spark, sf_dir))


def by_hour(spark, sf_dir):
    return gold.mart_by_hour_severity(accidents(spark, sf_dir))


def by_weather(spark, sf_dir):
    return gold.mart_by_weather(accidents(spark, sf_dir))


def batches(spark, sf_dir):
    return split.ordered_split(raw(spark, sf_dir), ["seq"], N_BATCHES, FIRST_DAY)


def cumulative(spark, sf_dir):
    return bronze.bronze_cumulative(batches(spark, sf_dir), LAST_DAY)


def joined(spark, sf_dir):
    t = silver_tables(spark, sf_dir)
    return features.join_silver(t["accidents"], t["weather"], t["road_features"])


# ---------------------------------------------------------------------------
# Bronze / sources


def q_sanitize_columns(spark, sf_dir):
    r = raw(spark, sf_dir)
    awkward = r.toDF(*[RAW_HEADERS.get(n, n) for n in r.columns])
    return bronze.sanitize_columns(awkward)


def q_stamp_date(spark, sf_dir):
    return bronze.stamp_date(raw(spark, sf_dir), LAST_DAY)


def q_batch_discovery(spark, sf_dir):
    events = spark.read.parquet(sf_table(sf_dir, "events"))
    other = [F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")), F.concat("event_type", F.lit("-events.csv"))]
    names = csv_batches.batch_file_names(events)
    for name in other:  # names that discovery must pass over
        names = names.unionAll(events.select(name.alias("file_name")))
    return csv_batches.select_batches(names, DISCOVERY_YEAR, DISCOVERY_MONTH, N_BATCHES)


def q_ordered_split_file(spark, sf_dir):
    """The feed as CSV files whose cells hold line breaks, split in the order of their rows."""
    path = scratch_path(spark, "export")
    feed = raw(spark, sf_dir).withColumn("Description", F.concat("Description", F.lit('\nsaid "'), "Timezone", F.lit('"')))
    (feed.repartitionByRange("seq").sortWithinPartitions("seq")  # files in order by their names
     .write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    rows = quoted_csv.read_quoted_csv(spark, path)
    out = split.ordered_split(rows, quoted_csv.ORDER, N_BATCHES, FIRST_DAY)
    return out.select(F.col("seq").cast("long").alias("seq"), "ID", "Description", "City", "batch", "situation_date")


def q_stored_profile(spark, sf_dir):
    """Columns and counts of a published Silver, as counted when it was written."""
    root = scratch_path(spark, "silver")
    rows = store.write_bronze(cumulative(spark, sf_dir), scratch_path(spark, "bronze"))
    jobs.run_silver(spark, rows, root, schema=f"profiled_{uuid.uuid4().hex[:8]}")
    return jobs.silver_profile(spark, root, LAST_DAY).select("table_name", "column_name", "null_count", "n_rows")


def _refreshed(spark, sf_dir) -> tuple[str, str]:
    """State and Gold kept day by day."""
    rows = store.write_bronze(cumulative(spark, sf_dir), scratch_path(spark, "bronze"))
    state, marts = scratch_path(spark, "state"), scratch_path(spark, "gold")
    jobs.refresh_gold(spark, rows, state, marts)
    return state, marts


def q_silver_append_new(spark, sf_dir):
    """Daily appends in which a key counts on the first day that has it."""
    state, _ = _refreshed(spark, sf_dir)
    return store.read_bronze(spark, f"{state}/accidents")


def q_mart_by_region_merged(spark, sf_dir):
    _, marts = _refreshed(spark, sf_dir)
    return spark.read.parquet(f"{marts}/accidents_by_region")


def q_rf_table_scores(spark, sf_dir):
    """Test rows by label, and how many of them the forest's table scores as the fitted forest does."""
    trained = model.train_model(joined(spark, sf_dir))
    table = forest.save_forest(spark, trained.forest, scratch_path(spark, "forest"))
    both = forest.score(trained.predictions, table, prediction_col="by_table")
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("by_table") == F.col("prediction")).alias("n_same"))


def q_ordered_split_counts(spark, sf_dir):
    return split.batch_counts(batches(spark, sf_dir))


def q_batch_pending(spark, sf_dir):
    b = batches(spark, sf_dir)
    manifest = b.filter(F.col("batch") == 0).select("situation_date")
    return bronze.pending_batches(b, manifest, LAST_DAY)


def q_union_by_name(spark, sf_dir):
    b = batches(spark, sf_dir)
    cols = b.columns
    parts = [b.filter(F.col("batch") == 0).select(*reversed(cols)),
             b.filter(F.col("batch") == 1).select(*cols),
             b.filter(F.col("batch") == 2).select(*sorted(cols))]
    return bronze.union_batches(parts)


def q_bronze_scan(spark, sf_dir):
    path = store.write_bronze(cumulative(spark, sf_dir), scratch_path(spark, "bronze"))
    return store.read_bronze(spark, path, LAST_DAY)


def q_parquet_roundtrip(spark, sf_dir):
    path = store.write_parquet(accidents(spark, sf_dir), scratch_path(spark, "silver-accidents"))
    return spark.read.parquet(path)


def _fresh_table(spark, name: str) -> str:
    """A new name in the scratch schema, whose files are in the shared folder until ``drop_scratch``."""
    return f"{scratch_schema(spark)}.{name}_{uuid.uuid4().hex[:10]}"


def q_silver_append(spark, sf_dir):
    """Silver built per Bronze day and appended to one table (duplicates kept).

    The three daily conform steps run as one job (dedup scoped by day); their
    union is one append, the same rows three daily appends would add.
    """
    per_day = silver.conform_accidents(cumulative(spark, sf_dir), group_cols=["bronze_date"])
    table = catalog.append_table(per_day.drop("bronze_date"), _fresh_table(spark, "accidents"))
    return catalog.table_scan(spark, table)


def q_table_scan(spark, sf_dir):
    table = catalog.overwrite_table(accidents(spark, sf_dir), _fresh_table(spark, "accidents"))
    return catalog.table_scan(spark, table)


def q_silver_snapshot(spark, sf_dir):
    done = catalog.snapshot_tables(spark, silver_tables(spark, sf_dir), scratch_path(spark, "snapshot"))
    failed = {k: v for k, v in done.items() if v.startswith("error:")}
    if failed:
        raise RuntimeError(f"snapshot failed: {failed}")
    return profile.row_counts({k: spark.read.parquet(v) for k, v in done.items()})


# ---------------------------------------------------------------------------
# single-step projections and filters


def q_complete_columns(spark, sf_dir):
    thin = raw(spark, sf_dir).drop(*DROPPED_FOR_COMPLETION)
    wanted = list(dict.fromkeys(S.ACCIDENT_COLUMNS + S.WEATHER_COLUMNS + S.ROAD_COLUMNS))
    return silver.complete_columns(thin, wanted).select("seq", *wanted)


def _on_raw(fn):
    return lambda spark, sf_dir: fn(raw(spark, sf_dir))


def _on_accidents(fn):
    return lambda spark, sf_dir: fn(accidents(spark, sf_dir))


# ---------------------------------------------------------------------------
# ML


def q_index(col_names: list[str]):
    """Index table of the last of ``col_names``, fitted after the earlier ones (skip)."""
    def run(spark, sf_dir):
        df = materialize(features.narrow(joined(spark, sf_dir)).drop("_whole"))
        for name in col_names[:-1]:
            df = features.category_indexer(name).fit(df).transform(df)
        m = features.category_indexer(col_names[-1]).fit(df)
        return features.index_table(m, m.transform(df))
    return run


def q_index_label(spark, sf_dir):
    ff, _, _ = features.prepare_features(joined(spark, sf_dir))
    m = features.label_indexer().fit(ff)
    return features.index_table(m, m.transform(ff))


def q_feature_vector(spark, sf_dir):
    data, _, _, _, _ = model.labelled(joined(spark, sf_dir))
    return data.select(S.KEY, "label", features.as_array("features"))


def q_split_counts(spark, sf_dir):
    train, test = model.split(features.feature_frame(joined(spark, sf_dir)))
    return (train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n_rows")))


def q_test_labels(spark, sf_dir):
    """Rows of the test part by label."""
    _, test = model.split(features.feature_frame(joined(spark, sf_dir)))
    return test.groupBy("Severity").agg(F.count(F.lit(1)).alias("n_rows"))


def _scored(spark, sf_dir, summarize):
    return summarize(model.train_model(joined(spark, sf_dir)).predictions)


def q_rf_predictions(spark, sf_dir):
    return _scored(spark, sf_dir, model.per_label)


def q_rf_accuracy(spark, sf_dir):
    return _scored(spark, sf_dir, model.accuracy)


# ---------------------------------------------------------------------------


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # ---- Bronze, sources and sinks ----------------------------------------
    q["sanitize_columns"] = q_sanitize_columns
    q["stamp_date"] = q_stamp_date
    q["batch_discovery"] = q_batch_discovery
    q["ordered_split"] = batches
    q["silver_append_new"] = q_silver_append_new
    q["mart_by_region_merged"] = q_mart_by_region_merged
    q["rf_table_scores"] = q_rf_table_scores
    q["ordered_split_file"] = q_ordered_split_file
    q["stored_profile"] = q_stored_profile
    q["ordered_split_counts"] = q_ordered_split_counts
    q["batch_pending"] = q_batch_pending
    q["union_by_name"] = q_union_by_name
    q["bronze_cumulative"] = cumulative
    q["bronze_scan"] = q_bronze_scan
    q["parquet_roundtrip"] = q_parquet_roundtrip
    q["silver_append"] = q_silver_append
    q["table_scan"] = q_table_scan
    q["silver_snapshot"] = q_silver_snapshot

    # ---- projections, casts, filters, dedup ---------------------------------
    q["project_accidents"] = _on_raw(lambda r: r.select(*S.ACCIDENT_COLUMNS))
    q["project_weather"] = _on_raw(lambda r: r.select(*S.WEATHER_COLUMNS))
    q["project_road"] = _on_raw(lambda r: r.select(*S.ROAD_COLUMNS))
    q["complete_columns"] = q_complete_columns
    q["cast_latlng"] = _on_raw(lambda r: r.select(
        "seq", "ID", *[to_float(n).alias(n) for n in S.COORDINATES]))
    q["normalize_text"] = _on_raw(lambda r: r.select(
        "seq", "ID", *[normalized_text(n).alias(n) for n in S.ACCIDENT_TEXT + S.WEATHER_TEXT]))
    q["bool_to_int"] = _on_raw(lambda r: r.select(
        "seq", "ID", *[flag_to_int(n).alias(n) for n in S.ROAD_FLAGS]))
    q["cast_severity"] = _on_accidents(lambda a: a.select("ID", severity_int().alias("Severity")))
    q["date_part_date"] = _on_accidents(lambda a: a.select("ID", date_of().alias("date")))
    q["date_parts"] = _on_accidents(lambda a: a.select(
        "ID", hour_of().alias("hour"), weekday_of().alias("weekday"), month_of().alias("month")))
    q["hour_label"] = _on_accidents(lambda a: a.select("ID", hour_label(hour_of()).alias("hour")))
    q["filter_key"] = _on_raw(silver.filter_key)
    q["filter_time_order"] = _on_raw(silver.filter_time_order)
    q["filter_severity"] = _on_raw(silver.filter_severity)
    q["dropna_any"] = _on_raw(silver.dropna_any)
    q["dropna_subset"] = _on_raw(lambda r: silver.dropna_any(r, DROPNA_SUBSET))
    q["dedup_key_no_seq"] = _on_raw(
        lambda r: silver.dedup_by_key(r.drop("seq"), ["ID"]))
    q["dedup_key"] = _on_raw(lambda r: silver.dedup_by_key(r, ["ID"], ["seq"]))

    # ---- Silver -----------------------------------------------------------
    q["silver_accidents"] = accidents
    q["silver_weather"] = weather
    q["silver_road_features"] = road

    # ---- Gold marts -------------------------------------------------------
    q["mart_by_region"] = by_region
    q["mart_by_hour_severity"] = by_hour
    q["mart_by_weather"] = by_weather

    def by_condition(spark, sf_dir):
        t = silver_tables(spark, sf_dir)
        return gold.mart_by_weather_condition(t["accidents"], t["weather"])
    q["mart_by_weather_condition"] = by_condition

    # ---- KPIs -------------------------------------------------------------
    q["kpi_global"] = lambda s, d: kpi.kpi_global(by_region(s, d))
    q["kpi_global_weighted"] = lambda s, d: kpi.kpi_global_weighted(by_region(s, d))
    q["kpi_top_regions"] = lambda s, d: kpi.kpi_top_regions(by_region(s, d))
    q["kpi_top_cities"] = lambda s, d: kpi.kpi_top_cities(by_region(s, d))
    q["region_label"] = lambda s, d: kpi.kpi_region_labels(by_region(s, d))
    q["kpi_by_hour"] = lambda s, d: kpi.kpi_by_hour(by_hour(s, d))
    q["kpi_by_severity"] = lambda s, d: kpi.kpi_by_severity(by_hour(s, d))
    q["kpi_by_weather"] = lambda s, d: kpi.kpi_by_weather(by_weather(s, d))
    q["kpi_max_hour"] = lambda s, d: kpi.kpi_max_hour(by_hour(s, d))

    # ---- profiling --------------------------------------------------------
    def profiled(spark, sf_dir):
        r = stored_raw(spark, sf_dir)
        return {"raw": r, "accidents": silver.conform_accidents(r), "weather": silver.conform_weather(r),
                "road_features": silver.conform_road(r)}

    def counted(spark, sf_dir):
        t = profiled(spark, sf_dir)
        t["accidents"] = materialize(t["accidents"])  # feeds its own count and the three marts
        return profile.row_counts({**t, **{f"accidents_by_{n}": m for n, m in
                                           zip(("region", "hour_severity", "weather"),
                                               gold.build_gold(t["accidents"]).values())}})
    q["row_count"] = counted
    q["null_profile"] = lambda s, d: profile.null_profile(profiled(s, d))
    q["schema_profile"] = lambda s, d: profile.schema_profile(silver_tables(s, d))
    q["sample_rows"] = lambda s, d: profile.sample_rows(accidents(s, d))

    # ---- features and model -----------------------------------------------
    q["join_silver"] = joined
    q["index_wind"] = q_index(["Wind_Direction"])
    q["index_weather"] = q_index(["Wind_Direction", "Weather_Condition"])
    q["index_label"] = q_index_label
    q["feature_frame"] = lambda s, d: features.feature_frame(joined(s, d))
    q["feature_vector"] = q_feature_vector
    q["split_counts"] = q_split_counts
    q["test_labels"] = q_test_labels
    q["rf_predictions"] = q_rf_predictions
    q["rf_accuracy"] = q_rf_accuracy
    return q
