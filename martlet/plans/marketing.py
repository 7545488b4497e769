"""Reports over the marketing table: one row per day, channel and source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import as_date, divide, month_of, percent
from martlet.operators.unify import year_over_year

PAID = ("facebook", "google", "tiktok")


def _sum(c: str) -> Column:
    return F.sum(c)


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def _mean(c: str) -> Column:
    return divide(F.sum(c), F.count(c))


def since(df: DataFrame, as_of, days: int | None = None, months: int | None = None) -> DataFrame:
    start = F.date_sub(as_date(as_of), days) if days is not None else F.add_months(as_date(as_of), -months)
    return df.filter(F.col("date") >= start)


def monthly_performance(marketing: DataFrame) -> DataFrame:
    """Monthly figures per channel. `total_customers` adds up daily counts of distinct customers."""
    spend, revenue, net, orders = (_sum(c) for c in ("ad_spend", "revenue", "net_revenue", "orders"))
    return (
        marketing.filter(F.col("date").isNotNull())
        .groupBy(month_of("date").alias("month"), "channel")
        .agg(
            spend.alias("total_spend"),
            _mean("ad_spend").alias("avg_daily_spend"),
            revenue.alias("total_revenue"),
            net.alias("total_net_revenue"),
            _mean("revenue").alias("avg_daily_revenue"),
            orders.alias("total_orders"),
            _mean("orders").alias("avg_daily_orders"),
            _sum("unique_customers").alias("total_customers"),
            _sum("ad_impressions").alias("total_impressions"),
            _sum("ad_clicks").alias("total_clicks"),
            F.round(F.avg("ctr_percent"), 10).alias("avg_ctr"),
            divide(revenue, spend).alias("roas"),
            divide(spend, orders).alias("cpa"),
            divide(revenue, orders).alias("aov"),
            divide(net, spend).alias("mer"),
            percent(spend, revenue).alias("marketing_pct_of_revenue"),
            (revenue - spend).alias("contribution_margin"),
            percent(revenue - spend, revenue).alias("contribution_margin_pct"),
        )
    )


def monthly_totals(marketing: DataFrame) -> DataFrame:
    spend, revenue, net, orders = (_sum(c) for c in ("ad_spend", "revenue", "net_revenue", "orders"))
    return marketing.groupBy(month_of("date").alias("month")).agg(
        revenue.alias("gross_revenue"),
        net.alias("net_revenue"),
        spend.alias("marketing_spend"),
        orders.alias("orders"),
        _sum("unique_customers").alias("customers"),
        F.round(F.avg("avg_order_value"), 10).alias("aov"),
        divide(revenue, spend).alias("roas"),
        divide(spend, orders).alias("cpa"),
        (net - spend).alias("pre_marketing_contribution"),
        percent(spend, net).alias("marketing_pct"),
    )


def executive_summary(marketing: DataFrame) -> DataFrame:
    """Monthly figures, those of a year before, and the change between them."""
    metrics = ["gross_revenue", "net_revenue", "marketing_spend", "orders", "customers"]
    both = year_over_year(monthly_totals(marketing), "month", [*metrics, "roas"])
    change = {
        f"{m}_yoy": percent(_double(m) - _double(f"ly_{m}"), F.col(f"ly_{m}"))
        for m in ("gross_revenue", "net_revenue", "marketing_spend", "orders", "roas")
    }
    return both.withColumns(change).drop("ly_roas")


def channel_mix(marketing: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Channel totals with their shares. The totals over all channels are taken over the
    aggregated rows, one per channel, so the marketing table is read once."""
    per_channel = (
        since(marketing, as_of, days=days)
        .groupBy("channel")
        .agg(
            _sum("ad_spend").alias("total_spend"),
            _sum("revenue").alias("total_revenue"),
            _sum("orders").alias("total_orders"),
            divide(_sum("revenue"), _sum("ad_spend")).alias("roas"),
        )
    )
    share = lambda c: percent(F.col(c), F.sum(c).over(Window.partitionBy()))
    return per_channel.withColumns(
        {"spend_share_pct": share("total_spend"), "revenue_share_pct": share("total_revenue")}
    )


def kpi_yoy(df: DataFrame, as_of, metrics: Mapping[str, Column], with_last_year: bool) -> DataFrame:
    """This month against the same month last year, one row per metric.

    Each metric is an aggregate; both months are grouped in one pass, then turned long.
    """
    month = month_of("date")
    this, last = month_of(as_date(as_of)), month_of(F.add_months(as_date(as_of), -12))
    values = F.array(*[F.struct(F.lit(name).alias("metric"), agg.cast("double").alias("v")) for name, agg in metrics.items()])
    per_month = (
        df.filter((month == this) | (month == last))
        .groupBy((month == this).alias("current"))
        .agg(values.alias("m"))
        .select("current", F.explode("m").alias("m"))
    )
    both = per_month.groupBy(F.col("m.metric").alias("metric")).agg(
        F.count_if(F.col("current")).alias("_c"),
        F.max(F.when(F.col("current"), F.col("m.v"))).alias("current_value"),
        F.count_if(~F.col("current")).alias("_l"),
        F.max(F.when(~F.col("current"), F.col("m.v"))).alias("last_year_value"),
    )
    # A month without any row has no figure to compare, as in a join of the two months.
    both = both.filter("_c > 0 AND _l > 0")
    change = percent(F.col("current_value") - F.col("last_year_value"), F.col("last_year_value"))
    if with_last_year:
        return both.select("metric", "current_value", "last_year_value", change.alias("yoy_change_percent"))
    return both.select("metric", "current_value", change.alias("yoy_change"))


def exec_kpi_yoy(marketing: DataFrame, as_of) -> DataFrame:
    metrics = {
        "Gross Revenue": _sum("revenue"),
        "Net Revenue": _sum("net_revenue"),
        "Marketing Spend": _sum("ad_spend"),
        "Orders": _sum("orders"),
    }
    return kpi_yoy(marketing, as_of, metrics, with_last_year=True)


def sitewide_kpi_yoy(daily_metrics: DataFrame, as_of) -> DataFrame:
    metrics = {
        "Orders": _sum("orders"),
        "Net Revenue": _sum("net_revenue"),
        "AOV": F.round(F.avg("aov"), 10),
        "Unique Customers": _sum("unique_customers"),
        "Returning %": F.round(F.avg("returning_customer_pct"), 10),
    }
    return kpi_yoy(daily_metrics, as_of, metrics, with_last_year=False)


def marketing_efficiency(marketing: DataFrame, as_of, months: int = 13) -> DataFrame:
    spend, net = _sum("ad_spend"), _sum("net_revenue")
    return (
        since(marketing, as_of, months=months)
        .groupBy(month_of("date").alias("month"))
        .agg(
            net.alias("net_revenue"),
            spend.alias("ad_spend"),
            divide(net, spend).alias("mer"),
            (net - spend).alias("contribution_margin"),
            percent(spend, net).alias("marketing_pct_of_revenue"),
        )
    )


def paid_channel_performance(marketing: DataFrame, as_of, channels=PAID) -> DataFrame:
    spend, revenue, orders = _sum("ad_spend"), _sum("revenue"), _sum("orders")
    return (
        since(marketing, as_of, months=1)
        .filter(F.col("channel").isin(*channels))
        .groupBy("channel")
        .agg(
            spend.alias("spend"),
            revenue.alias("revenue"),
            orders.alias("orders"),
            F.round(F.avg("avg_order_value"), 10).alias("aov"),
            divide(spend, orders).alias("cpa"),
            divide(revenue, spend).alias("roas"),
        )
    )


def revenue_month_yoy(marketing: DataFrame, as_of) -> DataFrame:
    """Months of this year with last year's revenue of the same month."""
    year, this = F.year("date"), F.year(as_date(as_of))
    per_month = (
        marketing.filter((year == this) | (year == this - 1))
        .groupBy(month_of("date").alias("month"))
        .agg(_sum("revenue").alias("revenue"), _sum("ad_spend").alias("spend"))
    )
    return (
        year_over_year(per_month, "month", ["revenue"])
        .filter(F.year("month") == this)
        .select(
            "month",
            F.col("revenue").alias("current_revenue"),
            F.col("spend").alias("current_spend"),
            F.col("ly_revenue").alias("last_year_revenue"),
            percent(_double("revenue") - _double("ly_revenue"), F.col("ly_revenue")).alias("yoy_growth_pct"),
        )
    )


def labelled_yoy(marketing: DataFrame, as_of) -> DataFrame:
    """One row: this month's revenue against last year's, both periods named."""
    this = month_of(as_date(as_of))
    last = F.add_months(this, -12)
    month = month_of("date")
    revenue = lambda m: F.sum(F.when(month == m, F.col("revenue")))
    one = marketing.filter(month.isin(this, last)).agg(revenue(this).alias("c"), revenue(last).alias("l"))
    return one.select(
        F.date_format(this, "MMMM yyyy").alias("current_period"),
        F.col("c").alias("current_revenue"),
        F.date_format(last, "MMMM yyyy").alias("comparison_period"),
        F.col("l").alias("last_year_revenue"),
        percent(_double("c") - _double("l"), F.col("l")).alias("yoy_growth_pct"),
        F.lit("YoY").alias("growth_type"),
    )


def channel_overview(marketing: DataFrame, as_of=None, days: int | None = 90) -> DataFrame:
    """Totals per channel over the last `days`, or over everything with `days=None`."""
    df = marketing if days is None else since(marketing, as_of, days=days)
    spend, revenue, orders = _sum("ad_spend"), _sum("revenue"), _sum("orders")
    return df.groupBy("channel").agg(
        spend.alias("total_spend"),
        revenue.alias("total_revenue"),
        divide(revenue, spend).alias("roas"),
        orders.alias("total_orders"),
        divide(spend, orders).alias("cpa"),
    )


def channel_daily_roas(marketing: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        since(marketing, as_of, days=days)
        .groupBy("date", "channel")
        .agg(
            _sum("revenue").alias("revenue"),
            _sum("ad_spend").alias("spend"),
            divide(_sum("revenue"), _sum("ad_spend")).alias("roas"),
        )
    )


def channel_rows(marketing: DataFrame, as_of, channels, days: int = 7) -> DataFrame:
    return (
        since(marketing, as_of, days=days)
        .filter(F.col("channel").isin(*channels))
        .select("date", "channel", "ad_spend", "revenue", "ad_clicks", divide(F.col("revenue"), F.col("ad_spend")).alias("roas"))
    )


def monthly_index(marketing: DataFrame, as_of, months: int = 8) -> DataFrame:
    """Monthly spend, revenue and orders of the whole business, with efficiency ratios."""
    spend, revenue, orders = _sum("ad_spend"), _sum("revenue"), _sum("orders")
    return (
        since(marketing, as_of, months=months)
        .groupBy(F.date_format("date", "yyyy-MM").alias("month"))
        .agg(
            spend.alias("spend"),
            revenue.alias("revenue"),
            orders.alias("orders"),
            divide(revenue, spend).alias("mer"),
            divide(spend, orders).alias("cpo"),
            divide(revenue, orders).alias("aov"),
        )
    )


def marketing_verify(marketing: DataFrame) -> DataFrame:
    return marketing.agg(
        F.lit("marketing_unified").alias("table_name"),
        F.count("*").alias("row_count"),
        _sum("revenue").alias("total_revenue"),
        _sum("ad_spend").alias("total_spend"),
        divide(_sum("revenue"), _sum("ad_spend")).alias("overall_roas"),
    )


def view_row_counts(views: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in views.items():
        one = df.agg(F.lit(name).alias("view_name"), F.count("*").alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


def unified_verify(checks: Sequence[DataFrame]) -> DataFrame:
    """Verification of the unified tables, one row each: `checks` are `shop_verify`, `ad_verify` and their like.

    Row counts stand beside the distinct keys, totals and returns on spend of each table; a figure that a table does not have is NULL.
    """
    out = None
    for one in checks:
        one = one.withColumnRenamed("table_name", "view_name")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
