"""Numbers. Money is summed as DECIMAL(18,2), so totals do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def to_long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def divide(a: Column, b: Column) -> Column:
    """a / b as a double; NULL where b is zero or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return divide(a, b) * 100


def outward(df: DataFrame) -> DataFrame:
    """Cast decimals to double, the published type of money columns."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
