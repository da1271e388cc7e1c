"""Feature frame for the severity classifier.

accidents LEFT JOIN weather USING (ID) LEFT JOIN road_features USING (ID);
calendar parts of ``Start_Time``; frequency indexes of the wind direction and
weather condition (NULL rows skipped); measures from text to double; rows
with any NULL dropped.  The skip and the final NULL drop make both left joins
behave as inner joins; that is kept on purpose.

Scale: the three Silver tables leave the conform step hash-partitioned by
``ID`` and unique per ``ID``, so the join chain is sort-merge on co-partitioned
inputs with no skew.  ``StringIndexer`` fits are distributed counts; only the
distinct labels (a handful of categories) reach the driver.  Before the fits
the joined frame is cut to what they and the features need (every other column
shrinks to one flag, whether all of them are there) and stored once as parquet,
so the join runs once, and each fit reads one column of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake import schema as S
from roadlake.functions.columns import c, hour_of, month_of, to_double, weekday_of
from roadlake.functions.names import present
from roadlake.session import materialize


def join_silver(accidents: DataFrame, weather: DataFrame, road: DataFrame) -> DataFrame:
    return accidents.join(weather, S.KEY, "left").join(road, S.KEY, "left")


def add_date_parts(df: DataFrame, ts: str = "Start_Time") -> DataFrame:
    if ts not in df.columns:
        return df
    return df.withColumns({"hour": hour_of(ts), "weekday": weekday_of(ts), "month": month_of(ts)})


def category_indexer(col: str, out: str | None = None, skip: bool = True) -> StringIndexer:
    """Index by frequency (most frequent = 0.0, ties alphabetical)."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx",
                         handleInvalid="skip" if skip else "error")


def index_table(model: StringIndexerModel, indexed: DataFrame) -> DataFrame:
    """(value, n, idx): each label with its row count and index, from the indexed rows."""
    src, out = model.getInputCol(), model.getOutputCol()
    return (indexed.groupBy(c(src).alias("value"), F.col(out).alias("idx"))
            .agg(F.count(F.lit(1)).alias("n")))


def index_categories(df: DataFrame, cols: Sequence[str] = S.CATEGORY_COLUMNS):
    """Fit and apply each present category indexer in turn; returns (frame, models)."""
    models = []
    for col in present(df.columns, cols):
        model = category_indexer(col).fit(df)
        df = model.transform(df)
        models.append(model)
    return df, models


def feature_columns(df: DataFrame) -> list[str]:
    return present(df.columns, S.FEATURE_CANDIDATES)


def text_measures(df: DataFrame) -> list[str]:
    """Feature columns that still hold text."""
    return [f for f in present(df.columns, S.FEATURE_CANDIDATES) if isinstance(df.schema[f].dataType, T.StringType)]


def narrow(joined: DataFrame) -> DataFrame:
    """Key, label, categories and features (measures as double), and ``_whole``: no other column is NULL."""
    df = add_date_parts(joined)
    used = [S.KEY, "Severity", *present(df.columns, S.CATEGORY_COLUMNS), *feature_columns(df)]
    whole = F.lit(True)
    for n in df.columns:
        if n not in used:
            whole = whole & c(n).isNotNull()
    text = text_measures(df)
    return df.select(*[(to_double(n) if n in text else c(n)).alias(n) for n in dict.fromkeys(used)],
                     whole.alias("_whole"))


def prepare_features(joined: DataFrame):
    """(frame of key, Severity, categories and features, feature names, category models), NULL-free.

    The category indexes are fitted on all rows of the stored narrow frame,
    before rows with a NULL anywhere in the joined frame are dropped.
    """
    df = materialize(narrow(joined))
    df, models = index_categories(df)
    features = feature_columns(df)
    if not features:
        raise ValueError("no feature column available for training")
    df = df.filter("_whole").drop("_whole").dropna()
    return df, features, models


def feature_frame(joined: DataFrame) -> DataFrame:
    df, features, _ = prepare_features(joined)
    return df.select(S.KEY, "Severity", *features)


def label_indexer(col: str = "Severity", out: str = "label") -> StringIndexer:
    return StringIndexer(inputCol=col, outputCol=out)


def assembler(features: Sequence[str], out: str = "features", skip: bool = False) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip" if skip else "error")


def preparation(joined: DataFrame) -> list[SQLTransformer]:
    """Stages that add the calendar columns and cast the measures of a joined Silver frame."""
    stages = []
    if "Start_Time" in joined.columns:
        ts = "try_cast(Start_Time AS timestamp_ntz)"
        stages.append(SQLTransformer(statement=(
            f"SELECT *, hour({ts}) AS hour, dayofweek({ts}) AS weekday, month({ts}) AS month FROM __THIS__")))
    text = text_measures(joined)
    if text:
        cast = ", ".join(f"try_cast(`{n}` AS double) AS `{n}`" for n in text)
        kept = ", ".join(f"`{n}`" for n in text)
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({kept}), {cast} FROM __THIS__"))
    return stages


def as_array(vector_col: str = "features") -> F.Column:
    """Expose an ML vector as ``array<double>`` (hashable, portable)."""
    return vector_to_array(F.col(vector_col)).alias(vector_col)
