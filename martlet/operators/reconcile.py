"""Reconcile what a source reports with what the warehouse holds, as joins over landed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as SqlWindow
from pyspark.sql import functions as F

from martlet.functions import as_date, divide, money

# Fixed value: the share by which both sides may differ.
TOLERANCE = 0.02


@dataclass(frozen=True)
class Window:
    start: date
    end: date


def settled_window(as_of: str | date, days: int = 14, settle: int = 2) -> Window:
    """Default range: `days` days that end `settle` days back, when attribution has settled."""
    today = date.fromisoformat(str(as_of)[:10])
    end = today - timedelta(days=settle)
    return Window(end - timedelta(days=days), end)


def in_window(df: DataFrame, day: Column, window: Window) -> DataFrame:
    return df.filter(day.between(as_date(window.start), as_date(window.end)))


# ------------------------------------------------------------------------ both sides
def _ad_sums(df: DataFrame, spend: Column) -> list[Column]:
    zero = lambda c, kind: F.coalesce(c, F.lit(0).cast(kind))
    return [
        zero(F.sum(spend), "decimal(28,2)").alias("spend"),
        zero(F.sum("impressions"), "bigint").alias("impressions"),
        zero(F.sum("clicks"), "bigint").alias("clicks"),
    ]


def account_stats(ads: DataFrame, window: Window, keys: Sequence[str] = ("account_id",)) -> DataFrame:
    return in_window(ads, F.col("date_start"), window).groupBy(*keys).agg(*_ad_sums(ads, money("spend")))


def platform_stats(ad_report: DataFrame, window: Window) -> DataFrame:
    return in_window(ad_report, F.col("report_date"), window).agg(*_ad_sums(ad_report, F.col("spend")))


def order_stats(clean_orders: DataFrame, window: Window) -> DataFrame:
    return in_window(clean_orders, F.col("created_at").cast("date"), window).agg(
        F.count("*").alias("order_count"),
        F.coalesce(F.sum(money("total_price")), F.lit(0).cast("decimal(28,2)")).alias("revenue"),
    )


def source_totals(api_rows: DataFrame, window: Window, keys: Sequence[str] = ("account_id",)) -> DataFrame:
    """Totals of landed interface rows: every figure is text, a missing one counts as zero."""
    typed = in_window(api_rows, F.col("date_start"), window).select(
        *keys,
        F.coalesce(F.col("spend").try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).alias("spend"),
        F.coalesce(F.col("impressions").try_cast("bigint"), F.lit(0).cast("bigint")).alias("impressions"),
        F.coalesce(F.col("clicks").try_cast("bigint"), F.lit(0).cast("bigint")).alias("clicks"),
    )
    return typed.groupBy(*keys).agg(*_ad_sums(typed, F.col("spend")))


# ------------------------------------------------------------------------ comparison
def compare(source: DataFrame, warehouse: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long rows (keys, metric, source_value, warehouse_value); a side without the key is NULL."""
    s = source.select(*keys, *[F.col(m).cast("double").alias(f"s_{m}") for m in metrics])
    w = warehouse.select(*keys, *[F.col(m).cast("double").alias(f"w_{m}") for m in metrics])
    both = s.join(w, list(keys), "full_outer")
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.col(f"s_{m}").alias("source_value"), F.col(f"w_{m}").alias("warehouse_value")
            )
            for m in metrics
        ]
    )
    return both.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")


def diff_pct(s: Column, w: Column) -> Column:
    """Difference in percent of the source: 0 if both are zero, 100 if only the source is."""
    return F.when((s == 0) & (w == 0), 0.0).when(s == 0, 100.0).otherwise(divide(F.abs(s - w), s) * 100)


def reconcile(
    source: DataFrame, warehouse: DataFrame, keys: Sequence[str], metrics: Sequence[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """MATCH or MISMATCH per key and metric; a side without the key counts as zero."""
    long = compare(source, warehouse, keys, metrics).fillna(0.0, ["source_value", "warehouse_value"])
    d = diff_pct(F.col("source_value"), F.col("warehouse_value"))
    return long.withColumn("diff_pct", d).withColumn(
        "status", F.when(F.col("diff_pct") <= tolerance * 100, "MATCH").otherwise("MISMATCH")
    )


def reconcile_lenient(
    source: DataFrame, warehouse: DataFrame, keys: Sequence[str], metrics: Sequence[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """Variant that skips what one side lacks and only warns where the source says zero."""
    s, w = F.col("source_value"), F.col("warehouse_value")
    diff = divide(F.abs(s - w), s)
    status = (
        F.when(s.isNull() | w.isNull(), "SKIP")
        .when((s == 0) & (w == 0), "OK")
        .when(s == 0, "WARN")
        .when(diff <= tolerance, "OK")
        .otherwise("MISMATCH")
    )
    return compare(source, warehouse, keys, metrics).withColumn("status", status)


def skip_dormant(compared: DataFrame, keys: Sequence[str], watched: Sequence[str] = ("spend", "impressions")) -> DataFrame:
    """Mark keys without activity on either side as SKIPPED; a key has one row per metric."""
    activity = F.when(F.col("metric").isin(*watched), F.abs("source_value") + F.abs("warehouse_value"))
    busiest = F.max(activity).over(SqlWindow.partitionBy(*keys))
    return (
        compared.withColumn("_active", busiest)
        .withColumn("status", F.when(F.col("_active") == 0, "SKIPPED").otherwise(F.col("status")))
        .drop("_active")
    )


def scoreboard(compared: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return compared.agg(
        n("MATCH").alias("matches"), n("MISMATCH").alias("mismatches"), n("SKIPPED").alias("skipped")
    ).withColumn(
        "verdict",
        F.when(F.col("matches") + F.col("mismatches") == 0, "NO COMPARISON")
        .when(F.col("mismatches") == 0, "MATCH")
        .otherwise("MISMATCH"),
    )


# -------------------------------------------------------------------- keys and counts
def missing_records(source: DataFrame, warehouse: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, from one grouping over both."""
    s = source.select(*keys, F.lit(1).alias("s"), F.lit(0).alias("w"))
    w = warehouse.select(*keys, F.lit(0).alias("s"), F.lit(1).alias("w"))
    seen = s.unionByName(w).groupBy(*keys).agg(F.max("s").alias("s"), F.max("w").alias("w"))
    side = F.when(F.col("w") == 0, "missing in warehouse").otherwise("missing in source")
    return seen.filter(F.col("s") != F.col("w")).select(*keys, side.alias("side"))


def expected_members(df: DataFrame, col: str, expected: DataFrame) -> DataFrame:
    """Expected values that `df` does not hold; `expected` has one column of the same name."""
    return expected.join(df.select(col).distinct(), col, "left_anti")


def record_count_diff(
    source: DataFrame, warehouse: DataFrame, keys: Sequence[str], warn: float = 1.0, crit: float = 5.0
) -> DataFrame:
    """Row counts per key on both sides, with bands in percent of the source."""
    s = source.groupBy(*keys).agg(F.count("*").alias("rows"))
    w = warehouse.groupBy(*keys).agg(F.count("*").alias("rows"))
    return banded(compare(s, w, keys, ["rows"]), warn, crit)


def banded(compared: DataFrame, warn: float, crit: float) -> DataFrame:
    filled = compared.fillna(0.0, ["source_value", "warehouse_value"])
    d = F.col("diff_pct")
    return filled.withColumn("diff_pct", diff_pct(F.col("source_value"), F.col("warehouse_value"))).withColumn(
        "status", F.when(d > crit, "CRITICAL").when(d > warn, "WARNING").otherwise("PASS")
    )
