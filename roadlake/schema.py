"""Column contracts of every layer.

Fixed values: the column lists, types and domain values below are the data
contract of the incident records and must stay as they are for results to
match.  Weather measures use the Bronze (cleaned) names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
KEY = "ID"

ACCIDENT_COLUMNS = [
    "ID", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng",
    "Description", "City", "County", "State", "Timezone",
]
WEATHER_MEASURES = [
    "Temperature_F_", "Humidity_pct_", "Pressure_in_", "Visibility_mi_",
    "Wind_Speed_mph_", "Precipitation_in_",
]
WEATHER_COLUMNS = [
    "ID", "Weather_Timestamp", "Temperature_F_", "Humidity_pct_", "Pressure_in_",
    "Visibility_mi_", "Wind_Direction", "Wind_Speed_mph_", "Precipitation_in_",
    "Weather_Condition",
]
ROAD_FLAGS = ["Amenity", "Bump", "Crossing", "Junction", "Traffic_Signal"]
ROAD_COLUMNS = ["ID"] + ROAD_FLAGS

ACCIDENT_TEXT = ["City", "County", "State", "Timezone"]
WEATHER_TEXT = ["Wind_Direction", "Weather_Condition"]
COORDINATES = ["Start_Lat", "Start_Lng"]
SEVERITY_DOMAIN = ["1", "2", "3", "4"]
TRUE_TEXT, FALSE_TEXT = "True", "False"

# Candidate model features, in the order they are assembled.
FEATURE_CANDIDATES = [
    "Start_Lat", "Start_Lng", "Amenity", "Bump", "Crossing", "Junction", "Traffic_Signal",
    "Temperature_F_", "Humidity_pct_", "Pressure_in_", "Visibility_mi_", "Wind_Speed_mph_",
    "Precipitation_in_", "hour", "weekday", "month", "Wind_Direction_idx", "Weather_Condition_idx",
]
CATEGORY_COLUMNS = ["Wind_Direction", "Weather_Condition"]

# Type given to a column that is absent from a batch (anything else: string).
ABSENT_COLUMN_TYPES: dict[str, T.DataType] = {
    "Start_Lat": T.FloatType(),
    "Start_Lng": T.FloatType(),
    "Severity": T.IntegerType(),
    **{m: T.FloatType() for m in WEATHER_MEASURES},
    **{f: T.IntegerType() for f in ROAD_FLAGS},
}
# ---------------------------------------------------------------------------


def absent_type(name: str) -> T.DataType:
    return ABSENT_COLUMN_TYPES.get(name, T.StringType())
