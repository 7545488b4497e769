"""Joins that keep NULL keys apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str | None = None) -> DataFrame:
    """Left join whose NULL keys do not meet in one task.

    A NULL key never matches, yet all of them hash to the same partition, and guest
    orders may be a third of the table. They get a key of their own instead, one no
    real key can equal: from the column `spread_by`, if the caller knows one that is unique,
    else from a hash of the whole row, so that they spread as finely as rows differ.
    Keys are compared as text. `right_key` is dropped from the output.
    """
    own = F.col(spread_by) if spread_by else F.xxhash64(*_hashable(left))
    spread = F.concat(F.lit("null:"), own.cast("string"))
    key = F.coalesce(F.col(left_key).cast("string"), spread)
    right = right.filter(F.col(right_key).isNotNull()).withColumn("_right_key", F.col(right_key).cast("string"))
    return (
        left.withColumn("_left_key", key)
        .join(right.drop(right_key), F.col("_left_key") == F.col("_right_key"), "left")
        .drop("_left_key", "_right_key")
    )


def _hashable(df: DataFrame) -> list[str]:
    """Columns a hash can be taken of: maps and variants have none."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
