"""Column expressions shared by the layers.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Raw text becomes a number, date or time only through ``try_cast``:
under ANSI mode one malformed cell would otherwise fail the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake import schema as S


def c(name: str) -> Column:
    """Column reference that tolerates dots and brackets in the name."""
    return F.col(f"`{name}`")


def to_float(name: str) -> Column:
    return c(name).try_cast("float")


def to_double(name: str) -> Column:
    return c(name).try_cast("double")


def normalized_text(name: str) -> Column:
    return F.lower(F.trim(c(name)))


def flag_to_int(name: str) -> Column:
    """``'True'`` -> 1, ``'False'`` -> 0, anything else -> NULL."""
    text = c(name).cast("string")
    return F.when(text == S.TRUE_TEXT, F.lit(1)).when(text == S.FALSE_TEXT, F.lit(0))


def severity_in_domain(name: str = "Severity") -> Column:
    # string literals: no implicit numeric cast, so the predicate is pushed
    # down to the parquet scan and a bad cell cannot fail the job
    return c(name).cast("string").isin(S.SEVERITY_DOMAIN)


def severity_int(name: str = "Severity") -> Column:
    return c(name).try_cast("int")


def timestamp_of(name: str = "Start_Time") -> Column:
    """Wall-clock timestamp of an ISO text; no time-zone shift, NULL if malformed."""
    return c(name).try_cast("timestamp_ntz")


def date_of(name: str = "Start_Time") -> Column:
    return timestamp_of(name).cast("date")


def hour_of(name: str = "Start_Time") -> Column:
    return F.hour(timestamp_of(name))


def weekday_of(name: str = "Start_Time") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(timestamp_of(name))


def month_of(name: str = "Start_Time") -> Column:
    return F.month(timestamp_of(name))


def hour_label(hour: Column) -> Column:
    """``7`` -> ``'07:00'``."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def region_label(state: Column, county: Column) -> Column:
    """``State - County``; NULL when either part is NULL."""
    return F.concat(state, F.lit(" - "), county)
