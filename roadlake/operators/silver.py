"""Silver: conform one raw/Bronze frame into accidents, weather and road features.

Order of steps is part of the contract and is kept:

* accidents: key -> complete -> project -> cast -> normalise -> time order
  -> severity domain -> dedup -> NULL drop
* weather:   key -> complete -> project -> normalise -> dedup -> NULL drop
* road:      key -> complete -> project -> flag->int -> dedup -> NULL drop

Dedup keeps, per key, the first row in ``order_cols`` (``seq`` when the feed
has it, otherwise the row with fewest NULLs, then by all other columns), so
reruns are identical.  It runs before the NULL drop, so a key is lost only if
the row kept has a NULL: without ``seq`` that means none of its rows is complete.

Scale: each table costs exactly one shuffle, by ``ID`` (plus any
``group_cols``).  ``row_number() = 1`` lets Catalyst plant a partial
``WindowGroupLimit`` before the exchange, so even a key holding a third of all
rows leaves every map task as at most one row per key.  The three outputs stay
hash-partitioned by ``ID``, which the ``ID`` join downstream reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake import schema as S
from roadlake.functions.columns import c, flag_to_int, normalized_text, severity_in_domain, to_float


def complete_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Append each wanted column that is absent, as a NULL of its contract type."""
    have = set(df.columns)
    missing = [F.lit(None).cast(S.absent_type(n)).alias(n) for n in wanted if n not in have]
    return df.select("*", *missing) if missing else df


def filter_key(df: DataFrame, key: str = S.KEY) -> DataFrame:
    return df.filter(c(key).isNotNull()) if key in df.columns else df


def filter_time_order(df: DataFrame, start: str = "Start_Time", end: str = "End_Time") -> DataFrame:
    """Strict ``start < end`` on the ISO texts (text order = time order for ISO)."""
    if start in df.columns and end in df.columns:
        return df.filter(c(start) < c(end))
    return df


def filter_severity(df: DataFrame, name: str = "Severity") -> DataFrame:
    return df.filter(severity_in_domain(name)) if name in df.columns else df


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order_cols``.

    Without them, the most complete row (fewest NULLs); among equally complete
    ones the first by all other columns, NULLs last.
    """
    keys = list(keys)
    if order_cols is None:
        others = [c(n) for n in df.columns if n not in keys]
        nulls = sum((o.isNull().cast("int") for o in others), F.lit(0))
        order = [nulls, *[o.asc_nulls_last() for o in others]]
    else:
        order = [c(o).asc_nulls_first() for o in order_cols]
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).filter(F.col("_first") == 1).drop("_first")


def dropna_any(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def _default_order(df: DataFrame) -> list[str] | None:
    return ["seq"] if "seq" in df.columns else None


def _conform(df: DataFrame, out_cols: Sequence[str], shape, order_cols, group_cols) -> DataFrame:
    group_cols = list(group_cols)
    df = filter_key(df)
    df = complete_columns(df, out_cols)
    order_cols = list(order_cols) if order_cols is not None else _default_order(df)
    carry = [n for n in dict.fromkeys(group_cols + (order_cols or [])) if n not in out_cols]
    df = df.select(*[c(n) for n in list(out_cols) + carry])
    df = shape(df)
    df = dedup_by_key(df, group_cols + [S.KEY], order_cols)
    df = dropna_any(df, out_cols)
    return df.select(*[c(n) for n in group_cols + list(out_cols)])


def _shape_accidents(df: DataFrame) -> DataFrame:
    df = df.withColumns({n: to_float(n) for n in S.COORDINATES})
    df = df.withColumns({n: normalized_text(n) for n in S.ACCIDENT_TEXT})
    return filter_severity(filter_time_order(df))


def _shape_weather(df: DataFrame) -> DataFrame:
    return df.withColumns({n: normalized_text(n) for n in S.WEATHER_TEXT})


def _shape_road(df: DataFrame) -> DataFrame:
    return df.withColumns({n: flag_to_int(n) for n in S.ROAD_FLAGS})


def conform_accidents(df: DataFrame, order_cols=None, group_cols=()) -> DataFrame:
    """silver.accidents; ``group_cols`` (e.g. the Bronze day) scope the dedup."""
    return _conform(df, S.ACCIDENT_COLUMNS, _shape_accidents, order_cols, group_cols)


def conform_weather(df: DataFrame, order_cols=None, group_cols=()) -> DataFrame:
    return _conform(df, S.WEATHER_COLUMNS, _shape_weather, order_cols, group_cols)


def conform_road(df: DataFrame, order_cols=None, group_cols=()) -> DataFrame:
    return _conform(df, S.ROAD_COLUMNS, _shape_road, order_cols, group_cols)
