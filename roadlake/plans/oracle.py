"""Independent DuckDB SQL for every registered query.

The SQL states the expected result directly from the driver's tables (views
``events customer nation region ...``).  Shared steps are CTEs, so each query
is one ``WITH`` statement.  Types are cast to what Spark returns (``BIGINT``
sums, ``INTEGER`` date parts, ``FLOAT`` coordinates).
"""

from __future__ import annotations

# The adapter of FIXTURES.md (raw incident feed), verbatim.
RAW = """raw AS (
SELECT e.event_id AS seq,
  CASE WHEN e.event_id % 37 = 5 THEN NULL ELSE
    concat('A-', cast(e.event_id - (CASE WHEN e.event_id % 10 = 7 THEN 1 ELSE 0 END) AS STRING)) END AS ID,
  CASE WHEN e.event_id % 41 = 7 THEN 'abc' ELSE cast(1 + e.event_id % 5 AS STRING) END AS Severity,
  cast(date_trunc('second', e.ts) AS STRING) AS Start_Time,
  cast(CASE WHEN e.event_id % 6 = 0 THEN date_trunc('second', e.ts)
            ELSE date_trunc('second', e.ts) + INTERVAL '30' MINUTE END AS STRING) AS End_Time,
  CASE WHEN e.event_id % 11 = 0 THEN NULL WHEN e.event_id % 23 = 1 THEN 'n/a' ELSE cast(e.value AS STRING) END AS Start_Lat,
  cast(0 - e.value AS STRING) AS Start_Lng, e.props AS Description,
  concat('  ', c.c_mktsegment, ' ') AS City, n.n_name AS County,
  concat(r.r_name, ' ', c.c_mktsegment) AS State, e.event_type AS Timezone,
  cast(date_trunc('second', e.ts) AS STRING) AS Weather_Timestamp,
  CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE cast(e.value AS STRING) END AS Temperature_F_,
  regexp_extract(e.props, '([0-9]+)', 1) AS Humidity_pct_,
  cast(e.user_id AS STRING) AS Pressure_in_, cast(e.event_id % 10 AS STRING) AS Visibility_mi_,
  CASE e.event_id % 4 WHEN 0 THEN ' N' WHEN 1 THEN 'S ' WHEN 2 THEN 'East' ELSE 'WSW' END AS Wind_Direction,
  cast(e.event_id % 40 AS STRING) AS Wind_Speed_mph_,
  CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE '0.0' END AS Precipitation_in_,
  concat(e.event_type, ' ') AS Weather_Condition,
  CASE WHEN e.event_id % 17 = 3 THEN NULL WHEN e.event_id % 2 = 0 THEN 'True' ELSE 'False' END AS Amenity,
  CASE WHEN e.event_id % 3 = 0 THEN 'True' ELSE 'False' END AS Bump,
  CASE WHEN e.event_id % 19 = 0 THEN 'yes' WHEN e.event_id % 5 = 0 THEN 'True' ELSE 'False' END AS Crossing,
  CASE WHEN e.event_id % 4 = 0 THEN 'True' ELSE 'False' END AS Junction,
  CASE WHEN e.user_id % 2 = 0 THEN 'True' ELSE 'False' END AS Traffic_Signal
FROM events e JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

ACC_COLS = ("ID, Severity, Start_Time, End_Time, Start_Lat, Start_Lng, Description, "
            "City, County, State, Timezone")
WEA_COLS = ("ID, Weather_Timestamp, Temperature_F_, Humidity_pct_, Pressure_in_, Visibility_mi_, "
            "Wind_Direction, Wind_Speed_mph_, Precipitation_in_, Weather_Condition")
ROAD_COLS = "ID, Amenity, Bump, Crossing, Junction, Traffic_Signal"


def _not_null(cols: str) -> str:
    return " AND ".join(f"{x.strip()} IS NOT NULL" for x in cols.split(","))


def _flag(name: str) -> str:
    return (f"CASE WHEN CAST({name} AS STRING) = 'True' THEN 1 "
            f"WHEN CAST({name} AS STRING) = 'False' THEN 0 END AS {name}")


def _acc_shape(src: str, extra: str = "") -> str:
    return f"""SELECT {extra}seq, ID, Severity, Start_Time, End_Time,
    TRY_CAST(Start_Lat AS FLOAT) AS Start_Lat, TRY_CAST(Start_Lng AS FLOAT) AS Start_Lng,
    Description, lower(trim(City)) AS City, lower(trim(County)) AS County,
    lower(trim(State)) AS State, lower(trim(Timezone)) AS Timezone
  FROM {src}
  WHERE ID IS NOT NULL AND Start_Time < End_Time AND CAST(Severity AS STRING) IN ('1', '2', '3', '4')"""


def _wea_shape(src: str, extra: str = "") -> str:
    return f"""SELECT {extra}seq, ID, Weather_Timestamp, Temperature_F_, Humidity_pct_, Pressure_in_,
    Visibility_mi_, lower(trim(Wind_Direction)) AS Wind_Direction, Wind_Speed_mph_,
    Precipitation_in_, lower(trim(Weather_Condition)) AS Weather_Condition
  FROM {src} WHERE ID IS NOT NULL"""


def _road_shape(src: str, extra: str = "") -> str:
    flags = ", ".join(_flag(f) for f in ("Amenity", "Bump", "Crossing", "Junction", "Traffic_Signal"))
    return f"SELECT {extra}seq, ID, {flags} FROM {src} WHERE ID IS NOT NULL"


def _first_per_key(shaped: str, cols: str, keys: str = "ID") -> str:
    return f"""SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY seq) AS rn_ FROM ({shaped}) s
  ) d WHERE rn_ = 1 AND {_not_null(cols)}"""


SILVER = f"""{RAW},
accidents AS ({_first_per_key(_acc_shape('raw'), ACC_COLS)}),
weather AS ({_first_per_key(_wea_shape('raw'), WEA_COLS)}),
road AS ({_first_per_key(_road_shape('raw'), ROAD_COLS)})"""

MARTS = f"""{SILVER},
mart_region AS (
  SELECT State, County, City, Severity, CAST(TRY_CAST(Start_Time AS TIMESTAMP) AS DATE) AS "date",
         count(ID) AS accident_count, avg(TRY_CAST(Severity AS DOUBLE)) AS avg_severity
  FROM accidents GROUP BY 1, 2, 3, 4, 5),
mart_hour AS (
  SELECT lpad(CAST(hour(TRY_CAST(Start_Time AS TIMESTAMP)) AS STRING), 2, '0') || ':00' AS "hour",
         TRY_CAST(Severity AS INTEGER) AS Severity,
         count(ID) AS accident_count, avg(TRY_CAST(Severity AS INTEGER)) AS avg_severity
  FROM accidents GROUP BY 1, 2),
mart_weather AS (
  SELECT State AS Weather_Condition, count(ID) AS accident_count,
         avg(TRY_CAST(Severity AS INTEGER)) AS avg_severity
  FROM accidents GROUP BY State)"""


def _with(prefix: str, body: str) -> str:
    return f"WITH {prefix}\n{body}"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}

    # ---- Silver -----------------------------------------------------------
    q["silver_accidents"] = _with(SILVER, "SELECT * FROM accidents")
    q["silver_weather"] = _with(SILVER, "SELECT * FROM weather")
    q["silver_road_features"] = _with(SILVER, "SELECT * FROM road")

    # ---- Gold marts -------------------------------------------------------
    q["mart_by_region"] = _with(MARTS, "SELECT * FROM mart_region")
    q["mart_by_hour_severity"] = _with(MARTS, "SELECT * FROM mart_hour")
    q["mart_by_weather"] = _with(MARTS, "SELECT * FROM mart_weather")
    q["mart_by_weather_condition"] = _with(SILVER, """
SELECT w.Weather_Condition, count(a.ID) AS accident_count,
       avg(TRY_CAST(a.Severity AS INTEGER)) AS avg_severity
FROM accidents a JOIN weather w ON a.ID = w.ID GROUP BY w.Weather_Condition""")

    # ---- KPIs -------------------------------------------------------------
    q["kpi_global"] = _with(MARTS, """
SELECT CAST(sum(accident_count) AS BIGINT) AS total_accidents, avg(avg_severity) AS avg_severity
FROM mart_region""")
    q["kpi_global_weighted"] = _with(MARTS, """
SELECT CAST(sum(accident_count) AS BIGINT) AS total_accidents,
       sum(accident_count * avg_severity) / sum(accident_count) AS weighted_avg_severity
FROM mart_region""")
    q["kpi_top_regions"] = _with(MARTS, """
SELECT State, County, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_region
GROUP BY State, County ORDER BY accidents DESC, State, County LIMIT 5""")
    q["kpi_top_cities"] = _with(MARTS, """
SELECT City, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_region
GROUP BY City ORDER BY accidents DESC, City LIMIT 5""")
    q["region_label"] = _with(MARTS, """
SELECT State || ' - ' || County AS Region, accidents FROM (
  SELECT State, County, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_region
  GROUP BY State, County ORDER BY accidents DESC, State, County LIMIT 5) t""")
    q["kpi_by_hour"] = _with(MARTS, """
SELECT "hour", CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_hour
GROUP BY "hour" ORDER BY "hour\"""")
    q["kpi_by_severity"] = _with(MARTS, """
SELECT Severity, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_hour
GROUP BY Severity ORDER BY Severity""")
    q["kpi_by_weather"] = _with(MARTS, """
SELECT Weather_Condition, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_weather
GROUP BY Weather_Condition ORDER BY accidents DESC, Weather_Condition LIMIT 10""")
    q["kpi_max_hour"] = _with(MARTS, """
SELECT "hour" AS max_hour, CAST(sum(accident_count) AS BIGINT) AS accidents FROM mart_hour
GROUP BY "hour" ORDER BY accidents DESC, "hour" LIMIT 1""")
    q.update(_bronze_queries())
    q.update(_step_queries())
    q.update(_profile_queries())
    q.update(_ml_queries())
    return q


# ---------------------------------------------------------------------------
# Bronze and sinks

BATCHES = f"""{SILVER},
numbered AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn_, count(*) OVER () AS n_ FROM raw),
batches AS (
  SELECT * EXCLUDE (rn_, n_, b_), b_ AS batch, CAST(DATE '2025-01-01' + b_ AS DATE) AS situation_date
  FROM (SELECT *, CAST(CASE WHEN floor(n_ / 3) = 0 THEN 2
                            ELSE least(floor((rn_ - 1) / floor(n_ / 3)), 2) END AS INTEGER) AS b_
        FROM numbered) t),
cumulative AS (
  SELECT *, situation_date AS bronze_date FROM batches WHERE situation_date <> DATE '2025-01-03'
  UNION ALL
  SELECT *, DATE '2025-01-03' AS bronze_date FROM batches)"""


def _bronze_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sanitize_columns"] = _with(RAW, """
SELECT * EXCLUDE (Description), Description AS "Description[raw]" FROM raw""")
    q["stamp_date"] = _with(RAW, "SELECT *, DATE '2025-01-03' AS situation_date FROM raw")
    q["batch_discovery"] = """
WITH names AS (
  SELECT strftime(ts, '%d-%m-%Y') || '.csv' AS file_name FROM events
  UNION SELECT strftime(ts, '%Y-%m-%d') || '.csv' FROM events
  UNION SELECT event_type || '-events.csv' FROM events),
dated AS (
  SELECT file_name, CAST(try_strptime(substr(file_name, 1, 10), '%d-%m-%Y') AS DATE) AS situation_date
  FROM names WHERE regexp_full_match(file_name, '[0-9]{2}-[0-9]{2}-[0-9]{4}[.]csv')),
picked AS (
  SELECT * FROM dated
  WHERE situation_date IS NOT NULL AND year(situation_date) = 2024 AND month(situation_date) = 1
  ORDER BY situation_date, file_name LIMIT 3)
SELECT file_name, situation_date,
       CAST(row_number() OVER (ORDER BY situation_date, file_name) - 1 AS INTEGER) AS batch
FROM picked"""
    q["ordered_split"] = _with(BATCHES, "SELECT * FROM batches")
    q["ordered_split_file"] = _with(BATCHES, """
SELECT seq, ID, Description || chr(10) || 'said "' || Timezone || '"' AS Description, City, batch, situation_date
FROM batches""")
    q["ordered_split_counts"] = _with(BATCHES, """
SELECT batch, situation_date, count(*) AS n_rows FROM batches GROUP BY batch, situation_date""")
    q["batch_pending"] = _with(BATCHES, """
SELECT * FROM batches b WHERE NOT EXISTS (
  SELECT 1 FROM batches l
  WHERE l.batch = 0 AND l.situation_date <> DATE '2025-01-03' AND l.situation_date = b.situation_date)""")
    q["union_by_name"] = _with(BATCHES, "SELECT * FROM batches")
    q["bronze_cumulative"] = _with(BATCHES, "SELECT * FROM cumulative")
    q["bronze_scan"] = _with(BATCHES, "SELECT * FROM cumulative WHERE bronze_date = DATE '2025-01-03'")
    q["parquet_roundtrip"] = _with(SILVER, "SELECT * FROM accidents")
    q["table_scan"] = _with(SILVER, "SELECT * FROM accidents")
    per_day = _first_per_key(_acc_shape("cumulative", "bronze_date, "), ACC_COLS, "bronze_date, ID")
    q["silver_append"] = _with(BATCHES, per_day)
    own = _first_per_key(_acc_shape("batches", "situation_date AS bronze_date, "), f"{ACC_COLS}, bronze_date", "bronze_date, ID")
    new = f"""{BATCHES},
own AS ({own}),
fresh AS (SELECT * FROM own WHERE NOT EXISTS (
  SELECT 1 FROM own e WHERE e.ID = own.ID AND e.bronze_date < own.bronze_date))"""
    q["silver_append_new"] = _with(new, "SELECT * FROM fresh")
    q["mart_by_region_merged"] = _with(new, """
SELECT State, County, City, Severity, CAST(TRY_CAST(Start_Time AS TIMESTAMP) AS DATE) AS "date",
       count(ID) AS accident_count, avg(TRY_CAST(Severity AS DOUBLE)) AS avg_severity
FROM fresh GROUP BY 1, 2, 3, 4, 5""")
    q["silver_snapshot"] = _with(SILVER, """
SELECT 'accidents' AS table_name, count(*) AS n_rows FROM accidents
UNION ALL SELECT 'weather', count(*) FROM weather
UNION ALL SELECT 'road_features', count(*) FROM road""")
    return q


# ---------------------------------------------------------------------------
# single steps

RAW_COLS = ("seq, ID, Severity, Start_Time, End_Time, Start_Lat, Start_Lng, Description, City, County, "
            "State, Timezone, Weather_Timestamp, Temperature_F_, Humidity_pct_, Pressure_in_, "
            "Visibility_mi_, Wind_Direction, Wind_Speed_mph_, Precipitation_in_, Weather_Condition, "
            "Amenity, Bump, Crossing, Junction, Traffic_Signal")
_TS = "TRY_CAST(Start_Time AS TIMESTAMP)"
DATE_PARTS = (f"CAST(hour({_TS}) AS INTEGER) AS \"hour\", CAST(dayofweek({_TS}) + 1 AS INTEGER) AS weekday, "
              f"CAST(month({_TS}) AS INTEGER) AS \"month\"")


def _step_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["project_accidents"] = _with(RAW, f"SELECT {ACC_COLS} FROM raw")
    q["project_weather"] = _with(RAW, f"SELECT {WEA_COLS} FROM raw")
    q["project_road"] = _with(RAW, f"SELECT {ROAD_COLS} FROM raw")
    q["complete_columns"] = _with(RAW, """
SELECT seq, ID, Severity, Start_Time, End_Time, Start_Lat, CAST(NULL AS FLOAT) AS Start_Lng, Description,
  City, County, State, CAST(NULL AS STRING) AS Timezone, Weather_Timestamp, Temperature_F_, Humidity_pct_,
  Pressure_in_, Visibility_mi_, Wind_Direction, Wind_Speed_mph_, CAST(NULL AS FLOAT) AS Precipitation_in_,
  Weather_Condition, Amenity, CAST(NULL AS INTEGER) AS Bump, Crossing, Junction, Traffic_Signal
FROM raw""")
    q["cast_latlng"] = _with(RAW, """
SELECT seq, ID, TRY_CAST(Start_Lat AS FLOAT) AS Start_Lat, TRY_CAST(Start_Lng AS FLOAT) AS Start_Lng FROM raw""")
    texts = ", ".join(f"lower(trim({n})) AS {n}" for n in
                      ("City", "County", "State", "Timezone", "Wind_Direction", "Weather_Condition"))
    q["normalize_text"] = _with(RAW, f"SELECT seq, ID, {texts} FROM raw")
    flags = ", ".join(_flag(f) for f in ("Amenity", "Bump", "Crossing", "Junction", "Traffic_Signal"))
    q["bool_to_int"] = _with(RAW, f"SELECT seq, ID, {flags} FROM raw")
    q["cast_severity"] = _with(SILVER, "SELECT ID, TRY_CAST(Severity AS INTEGER) AS Severity FROM accidents")
    q["date_part_date"] = _with(SILVER, f"SELECT ID, CAST({_TS} AS DATE) AS \"date\" FROM accidents")
    q["date_parts"] = _with(SILVER, f"SELECT ID, {DATE_PARTS} FROM accidents")
    q["hour_label"] = _with(SILVER, f"""
SELECT ID, lpad(CAST(hour({_TS}) AS STRING), 2, '0') || ':00' AS "hour" FROM accidents""")
    q["filter_key"] = _with(RAW, "SELECT * FROM raw WHERE ID IS NOT NULL")
    q["filter_time_order"] = _with(RAW, "SELECT * FROM raw WHERE Start_Time < End_Time")
    q["filter_severity"] = _with(RAW, "SELECT * FROM raw WHERE Severity IN ('1', '2', '3', '4')")
    q["dropna_any"] = _with(RAW, f"SELECT * FROM raw WHERE {_not_null(RAW_COLS)}")
    q["dropna_subset"] = _with(RAW, f"""
SELECT * FROM raw WHERE {_not_null('Severity, Start_Lat, Temperature_F_, Precipitation_in_')}""")
    others = [x.strip() for x in RAW_COLS.split(",") if x.strip() not in ("seq", "ID")]
    nulls = " + ".join(f"CAST({n} IS NULL AS INTEGER)" for n in others)
    order = ", ".join(f"{n} ASC NULLS LAST" for n in others)
    q["dedup_key_no_seq"] = _with(RAW, f"""
SELECT ID, {", ".join(others)} FROM (
  SELECT *, row_number() OVER (PARTITION BY ID ORDER BY {nulls}, {order}) AS rn_ FROM raw) d
WHERE rn_ = 1""")
    q["dedup_key"] = _with(RAW, """
SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY seq) AS rn_ FROM raw) d
WHERE rn_ = 1""")
    return q


# ---------------------------------------------------------------------------
# profiling

SILVER_TYPES = {
    "accidents": [(n, "float" if n in ("Start_Lat", "Start_Lng") else "string") for n in
                  [x.strip() for x in ACC_COLS.split(",")]],
    "weather": [(n, "string") for n in [x.strip() for x in WEA_COLS.split(",")]],
    "road_features": [(n, "string" if n == "ID" else "int") for n in [x.strip() for x in ROAD_COLS.split(",")]],
}
SILVER_VIEWS = {"accidents": "accidents", "weather": "weather", "road_features": "road"}


def _null_rows(table: str, view: str, cols: list[str]) -> list[str]:
    return [f"SELECT '{table}' AS table_name, '{n}' AS column_name, "
            f"count(*) FILTER (WHERE {n} IS NULL) AS null_count FROM {view}" for n in cols]


def _profile_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    parts = _null_rows("raw", "raw", [x.strip() for x in RAW_COLS.split(",")])
    for table, cols in SILVER_TYPES.items():
        parts += _null_rows(table, SILVER_VIEWS[table], [n for n, _ in cols])
    q["null_profile"] = _with(SILVER, "\nUNION ALL ".join(parts))
    parts = []
    for table, cols in SILVER_TYPES.items():
        for i, (n, t) in enumerate(cols):
            parts.append(f"SELECT '{table}' AS table_name, {i + 1} AS position, '{n}' AS column_name, "
                         f"'{t}' AS data_type, count(*) AS n_rows, count({n}) AS non_null "
                         f"FROM {SILVER_VIEWS[table]}")
    q["schema_profile"] = _with(SILVER, "\nUNION ALL ".join(parts))
    parts = [f"SELECT '{table}' AS table_name, '{n}' AS column_name, count(*) FILTER (WHERE {n} IS NULL) AS null_count, "
             f"count(*) AS n_rows FROM {SILVER_VIEWS[table]}" for table, cols in SILVER_TYPES.items() for n, _ in cols]
    q["stored_profile"] = _with(SILVER, "\nUNION ALL ".join(parts))
    counts = {"raw": "raw", "accidents": "accidents", "weather": "weather", "road_features": "road",
              "accidents_by_region": "mart_region", "accidents_by_hour_severity": "mart_hour",
              "accidents_by_weather": "mart_weather"}
    q["row_count"] = _with(MARTS, "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {v}" for t, v in counts.items()))
    q["sample_rows"] = _with(SILVER, "SELECT * FROM accidents ORDER BY ID LIMIT 5")
    return q


# ---------------------------------------------------------------------------
# features and indexes

FEATURES = f"""{SILVER},
joined AS (SELECT * FROM accidents LEFT JOIN weather USING (ID) LEFT JOIN road USING (ID)),
dated AS (SELECT *, {DATE_PARTS} FROM joined),
wind_idx AS (
  SELECT Wind_Direction AS value, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, Wind_Direction) - 1 AS DOUBLE) AS idx
  FROM dated WHERE Wind_Direction IS NOT NULL GROUP BY Wind_Direction),
with_wind AS (SELECT d.*, w.idx AS Wind_Direction_idx FROM dated d JOIN wind_idx w ON d.Wind_Direction = w.value),
cond_idx AS (
  SELECT Weather_Condition AS value, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, Weather_Condition) - 1 AS DOUBLE) AS idx
  FROM with_wind WHERE Weather_Condition IS NOT NULL GROUP BY Weather_Condition),
with_cond AS (
  SELECT x.*, c.idx AS Weather_Condition_idx FROM with_wind x JOIN cond_idx c ON x.Weather_Condition = c.value),
measured AS (
  SELECT * REPLACE (TRY_CAST(Temperature_F_ AS DOUBLE) AS Temperature_F_,
    TRY_CAST(Humidity_pct_ AS DOUBLE) AS Humidity_pct_, TRY_CAST(Pressure_in_ AS DOUBLE) AS Pressure_in_,
    TRY_CAST(Visibility_mi_ AS DOUBLE) AS Visibility_mi_, TRY_CAST(Wind_Speed_mph_ AS DOUBLE) AS Wind_Speed_mph_,
    TRY_CAST(Precipitation_in_ AS DOUBLE) AS Precipitation_in_)
  FROM with_cond),
ff AS (SELECT * FROM measured WHERE COLUMNS(*) IS NOT NULL)"""

FEATURE_COLS = ("Start_Lat, Start_Lng, Amenity, Bump, Crossing, Junction, Traffic_Signal, Temperature_F_, "
                "Humidity_pct_, Pressure_in_, Visibility_mi_, Wind_Speed_mph_, Precipitation_in_, "
                "\"hour\", weekday, \"month\", Wind_Direction_idx, Weather_Condition_idx")


def _ml_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["join_silver"] = _with(SILVER, """
SELECT * FROM accidents LEFT JOIN weather USING (ID) LEFT JOIN road USING (ID)""")
    q["index_wind"] = _with(FEATURES, "SELECT value, idx, n FROM wind_idx")
    q["index_weather"] = _with(FEATURES, "SELECT value, idx, n FROM cond_idx")
    q["index_label"] = _with(FEATURES, """
SELECT Severity AS value, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, Severity) - 1 AS DOUBLE) AS idx
FROM ff GROUP BY Severity""")
    q["feature_frame"] = _with(FEATURES, f"SELECT ID, Severity, {FEATURE_COLS} FROM ff")
    bits = "CAST('0x' || substr(md5(ID || '-42'), 1, 8) AS UBIGINT)"
    q["split_counts"] = _with(FEATURES, f"""
SELECT CASE WHEN {bits} < 0.8 * 4294967296 THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows
FROM ff GROUP BY 1""")
    q["test_labels"] = _with(FEATURES, f"""
SELECT Severity, count(*) AS n_rows FROM ff WHERE {bits} >= 0.8 * 4294967296 GROUP BY Severity""")
    q["rf_table_scores"] = _with(FEATURES, f"""
, labels AS (
  SELECT Severity, CAST(row_number() OVER (ORDER BY count(*) DESC, Severity) - 1 AS DOUBLE) AS label
  FROM ff GROUP BY Severity)
SELECT labels.label, count(*) AS n_rows, count(*) AS n_same FROM ff JOIN labels ON ff.Severity = labels.Severity
WHERE {bits} >= 0.8 * 4294967296 GROUP BY labels.label""")
    vector = ", ".join(f"CAST({x.strip()} AS DOUBLE)" for x in FEATURE_COLS.split(","))
    q["feature_vector"] = _with(FEATURES, f"""
, labels AS (
  SELECT Severity, CAST(row_number() OVER (ORDER BY count(*) DESC, Severity) - 1 AS DOUBLE) AS label
  FROM ff GROUP BY Severity)
SELECT ff.ID, labels.label, [{vector}] AS features
FROM ff JOIN labels ON ff.Severity = labels.Severity""")
    return q
