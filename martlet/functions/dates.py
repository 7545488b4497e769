from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: Column | date | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)[:10]).cast("date")


def as_timestamp(value: Column | datetime | date | str) -> Column:
    """Zone-free timestamp, the type the extracts carry."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def month_of(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
