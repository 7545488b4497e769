"""Exact median of a money column without gathering the column anywhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per factor e of value: an amount of 10^16 falls into bucket 368,414, so both signs
# together make fewer than 750,000 buckets however many rows there are.
RESOLUTION = 10000


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(v, n): rows per distinct value; a value held by a third of the rows is one row here."""
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n"))


def exact_median(counts: DataFrame, totals: Mapping[str, Column] | None = None) -> DataFrame:
    """One row (total, max_value, median, and the given totals) from value counts.

    The median is the mean of the middle two on even totals. Values go into buckets of
    growing width. A running total over the buckets, whose number is bounded, tells which
    one or two hold the middle ranks; only the distinct values of those are then ranked.
    `totals` are further sums over (v, n) to carry along. Both uses of the counts read the
    same shuffle.
    """
    totals = dict(totals or {})
    size = F.floor(F.log1p(F.abs(F.col("v").cast("double"))) * RESOLUTION)
    bucketed = counts.withColumn("b", F.when(F.col("v") < 0, -size).otherwise(size))

    everything = Window.partitionBy()
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_bucket = bucketed.groupBy("b").agg(
        F.sum("n").alias("bn"), F.max("v").alias("top"), *[F.sum(c).alias(k) for k, c in totals.items()]
    )
    placed = per_bucket.select(
        "b",
        (F.sum("bn").over(upto) - F.col("bn")).alias("start"),
        F.sum("bn").over(upto).alias("end"),
        F.sum("bn").over(everything).alias("total"),
        F.max("top").over(everything).cast("double").alias("max_value"),
        *[F.sum(k).over(everything).alias(k) for k in totals],
    )
    first, second = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    middle = placed.filter((F.col("end") > first) & (F.col("start") <= second)).drop("end")

    inside = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bucketed.join(F.broadcast(middle), "b").withColumn("end", F.col("start") + F.sum("n").over(inside))
    begins = F.col("end") - F.col("n")

    def at(rank: Column) -> Column:
        return F.max(F.when((begins <= rank) & (F.col("end") > rank), F.col("v")))

    return ranked.agg(
        F.coalesce(F.max("total"), F.lit(0)).alias("total"),
        F.max("max_value").alias("max_value"),
        ((at(first) + at(second)).cast("double") / 2).alias("median"),
        *[F.max(k).alias(k) for k in totals],
    )
