"""The marketing table kept, with only the days that changed computed anew; reports add the days up.

A row of the marketing table belongs to one day, and its figures come from that day's orders and ads alone. So a day can be computed
anew by itself, and monthly reports over the kept days equal those over a table built at once. A day is some rows per channel and
source, so the kept table has a folder per month; of a month with a changed day, the other days' rows are carried over as they are kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import month_of
from martlet.operators import changes, unify

MONTH = "kept_month"
Platforms = Mapping[str, tuple[DataFrame, str]]


def changed_days(shop: DataFrame | None = None, ads: Mapping[str, DataFrame] | None = None) -> list:
    """The days of arriving rows, orders by `order_date` and ads by `date`; at most one value per day of the calendar reaches the driver.

    A row that moved to another day must be given with its old day too. An ad row without a date counts as the day None.
    """
    found = [df.select(F.col("date").cast("date").alias("day")) for df in (ads or {}).values()]
    if shop is not None:
        found.append(shop.select(F.col("order_date").cast("date").alias("day")).filter("day IS NOT NULL"))
    out = None
    for one in found:
        out = one if out is None else out.unionByName(one)
    return [] if out is None else [r.day for r in out.distinct().collect()]


def _on(day: Column, days: list) -> Column:
    some = day.isin([d for d in days if d is not None])
    return some | day.isNull() if None in days else some


def marketing_of(shop: DataFrame, platforms: Platforms, days: list | None = None, by_source: bool = True) -> DataFrame:
    """The marketing table, or its rows of some days. The days are a filter on the inputs, so inputs partitioned by them are pruned."""
    if days is not None:
        shop = shop.filter(_on(F.col("order_date"), days))
        platforms = {name: (df.filter(_on(F.col("date"), days)), prefix) for name, (df, prefix) in platforms.items()}
    return unify.marketing_unified(unify.shopify_daily(shop, by_source), unify.daily_ad_spend(dict(platforms)))


def refresh_marketing(
    spark: SparkSession, path: str, shop: DataFrame, platforms: Platforms, days: list | None = None, by_source: bool = True
) -> DataFrame:
    """Build the kept table at `path`, or renew `days` of it, and give the whole table.

    Days without orders and ads any more lose their rows. Of the inputs only these days are read, and other months' files stay as they
    are. A run that is lost between its writes is brought to its end by the next.
    """
    rows = marketing_of(shop, platforms, days, by_source)
    columns = rows.columns
    rows = rows.withColumn(MONTH, month_of("date"))
    if days is None:
        rows.repartition(MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    elif days:
        changes.settle(spark, path, MONTH)
        months = list({d and d.replace(day=1) for d in days})
        kept = spark.read.schema(rows.schema).parquet(path).filter(_on(F.col(MONTH), months))
        others = kept.filter(~F.coalesce(_on(F.col("date"), days), F.lit(False)))
        changes.rewrite_partitions(spark, path, MONTH, months, others.unionByName(rows).repartition(MONTH))
    return spark.read.schema(rows.schema).parquet(path).select(*columns)
