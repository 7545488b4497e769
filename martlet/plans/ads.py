"""Ad reports: over latest report rows with JSON metrics, ad insights and unified ad tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import as_date, divide, json_decimal, json_long, json_text, money, percent
from martlet.operators.conform import ad_revenue_from_roas
from martlet.operators.dedup import ads_base

COUNTERS = {
    "impressions": "impressions",
    "clicks": "clicks",
    "conversions": "conversion",
    "purchases": "complete_payment",
    "video_plays": "video_play_actions",
    "views_25pct": "video_views_p25",
    "views_50pct": "video_views_p50",
    "views_75pct": "video_views_p75",
    "views_100pct": "video_views_p100",
    "likes": "likes",
    "comments": "comments",
    "shares": "shares",
}


def typed_metrics(latest_json: DataFrame) -> DataFrame:
    """Report rows with day, names and counters typed; columns a report does not use are never parsed."""
    m = "metrics"
    return latest_json.select(
        F.col("stat_time_day").cast("date").alias("day"),
        json_text(m, "$.campaign_name").alias("campaign_name"),
        json_text(m, "$.ad_name").alias("ad_name"),
        json_decimal(m, "$.spend").alias("spend"),
        *[json_long(m, f"$.{src}").alias(dst) for dst, src in COUNTERS.items()],
        json_decimal(m, "$.average_video_play").alias("watch_time"),
    )


def _s(c: str) -> Column:
    return F.sum(c)


def _cpa() -> Column:
    return divide(_s("spend"), _s("conversions"))


def _ctr() -> Column:
    return percent(_s("clicks"), _s("impressions"))


def _cpc() -> Column:
    return divide(_s("spend"), _s("clicks"))


def campaign_summary(latest_json: DataFrame) -> DataFrame:
    """Life span, reach and cost of each campaign.

    Rows are added up per campaign, day and ad first; the two distinct counts then run
    over those few groups.
    """
    counters = ("impressions", "clicks", "conversions", "purchases", "video_plays", "likes", "shares")
    per_ad_day = (
        typed_metrics(latest_json)
        .groupBy("campaign_name", "day", "ad_name")
        .agg(*[_s(c).alias(c) for c in ("spend", *counters)])
    )
    return per_ad_day.groupBy("campaign_name").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count_distinct("day").alias("active_days"),
        F.count_distinct("ad_name").alias("ads"),
        _s("spend").alias("total_spend_usd"),
        *[_s(c).alias(f"total_{c}") for c in counters],
        _ctr().alias("ctr_pct"),
        _cpc().alias("avg_cpc_usd"),
        _cpa().alias("avg_cpa_usd"),
    )


def ad_monthly_trend(latest_json: DataFrame, since=None) -> DataFrame:
    m = typed_metrics(latest_json)
    if since is not None:
        m = m.filter(F.col("day") >= as_date(since))
    return m.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        *[_s(c).alias(c) for c in ("spend", "impressions", "clicks", "conversions")],
        _ctr().alias("ctr"),
        _cpc().alias("cpc"),
        _cpa().alias("cpa"),
    )


def top_ads_by_conversions(latest_json: DataFrame, as_of, n: int = 50) -> DataFrame:
    return (
        typed_metrics(latest_json)
        .filter(F.col("day") >= F.add_months(as_date(as_of), -6))
        .groupBy("ad_name", "campaign_name")
        .agg(
            *[_s(c).alias(c) for c in ("spend", "impressions", "clicks", "conversions")],
            _ctr().alias("ctr_pct"),
            _cpa().alias("cpa_usd"),
        )
        .filter("conversions > 0")
        .orderBy(F.col("conversions").desc(), "ad_name", "campaign_name")
        .limit(n)
    )


def ad_yearly(latest_json: DataFrame) -> DataFrame:
    return typed_metrics(latest_json).groupBy(F.year("day").cast("bigint").alias("year")).agg(
        *[_s(c).alias(c) for c in ("spend", "impressions", "conversions")], _cpa().alias("cpa")
    )


# Words in a campaign's name and the type they stand for, in order of precedence.
CAMPAIGN_TYPES = (
    ("remarketing", "Remarketing"),
    ("prospecting", "Prospecting"),
    ("Catalogue", "Catalogue/Smart"),
    ("Catalog", "Catalogue/Smart"),
    ("search", "Search"),
)


def campaign_type(name: str) -> Column:
    """Kind of campaign by words in its name, upper and lower case told apart; first match wins."""
    kind = F.lit("Other")
    for word, label in reversed(CAMPAIGN_TYPES):
        kind = F.when(F.col(name).contains(word), label).otherwise(kind)
    return kind


def campaign_type_performance(latest_json: DataFrame) -> DataFrame:
    return typed_metrics(latest_json).groupBy(campaign_type("campaign_name").alias("campaign_type")).agg(
        _s("spend").alias("spend"), _s("conversions").alias("conversions"), _cpa().alias("cpa"), _ctr().alias("ctr")
    )


def cheapest(latest_json: DataFrame, keys: Sequence[str], min_conversions: int, n: int, since=None) -> DataFrame:
    """Groups with more than `min_conversions`, lowest cost per conversion first."""
    m = typed_metrics(latest_json)
    if since is not None:
        m = m.filter(F.col("day") >= as_date(since))
    return (
        m.groupBy(*keys)
        .agg(_s("spend").alias("spend"), _s("conversions").alias("conversions"), _cpa().alias("cpa"), _ctr().alias("ctr"))
        .filter(F.col("conversions") > min_conversions)
        .orderBy(F.col("cpa").asc(), *keys)
        .limit(n)
    )


def top_campaigns_by_cpa(latest_json: DataFrame, n: int = 10) -> DataFrame:
    return cheapest(latest_json, ["campaign_name"], 100, n)


def top_recent_ads(latest_json: DataFrame, since, n: int = 15, min_conversions: int = 50) -> DataFrame:
    return cheapest(latest_json, ["ad_name", "campaign_name"], min_conversions, n, since)


def day_of_week_performance(latest_json: DataFrame, since) -> DataFrame:
    """Sunday is day 1."""
    return (
        typed_metrics(latest_json)
        .filter(F.col("day") >= as_date(since))
        .groupBy(F.date_format("day", "EEEE").alias("day_name"), F.dayofweek("day").cast("bigint").alias("day_num"))
        .agg(
            divide(_s("spend"), F.count("spend")).alias("avg_spend"),
            divide(_s("conversions"), F.count("conversions")).alias("avg_conversions"),
            _cpa().alias("cpa"),
        )
    )


def video_engagement(latest_json: DataFrame) -> DataFrame:
    m = typed_metrics(latest_json)
    counters = ("video_plays", "views_25pct", "views_50pct", "views_75pct", "views_100pct")
    return m.agg(
        *[_s(c).alias(c) for c in counters],
        divide(_s("watch_time"), F.count("watch_time")).alias("avg_watch_time"),
        *[_s(c).alias(c) for c in ("likes", "comments", "shares")],
    )


# ------------------------------------------------------------------- insights with ROAS
def _returns() -> list[Column]:
    spend, revenue = _s("spend"), _s("revenue")
    return [spend.alias("spend"), revenue.alias("revenue"), divide(revenue, spend).alias("roas")]


def ad_overall(ads: DataFrame) -> DataFrame:
    return ad_revenue_from_roas(ads).agg(
        *_returns(),
        _s("impressions").alias("total_impressions"),
        _s("clicks").alias("total_clicks"),
        _ctr().alias("ctr"),
        _cpc().alias("cpc"),
    )


def ad_by_country(ads: DataFrame, min_spend: float = 100) -> DataFrame:
    return (
        ad_revenue_from_roas(ads)
        .groupBy("country")
        .agg(
            *_returns(),
            _s("impressions").alias("impressions"),
            _s("clicks").alias("clicks"),
            (_s("revenue") - _s("spend")).alias("profit"),
        )
        .filter(F.col("spend") > min_spend)
    )


def campaign_country(ads: DataFrame, min_spend: float = 1000) -> DataFrame:
    return (
        ad_revenue_from_roas(ads)
        .groupBy("campaign_name", "country")
        .agg(*_returns(), _s("clicks").alias("clicks"))
        .filter(F.col("spend") > min_spend)
    )


def loss_making_campaigns(ads: DataFrame, min_spend: float = 500) -> DataFrame:
    return (
        ad_revenue_from_roas(ads)
        .groupBy("campaign_name", "country")
        .agg(*_returns(), (_s("revenue") - _s("spend")).alias("loss"))
        .filter((F.col("roas") < 1) & (F.col("spend") > min_spend))
    )


def country_monthly(ads: DataFrame, countries: Sequence[str]) -> DataFrame:
    return (
        ad_revenue_from_roas(ads.filter(F.col("country").isin(*countries)))
        .groupBy(F.date_format("date_start", "yyyy-MM").alias("month"), "country")
        .agg(*_returns())
    )


def account_summary(ads: DataFrame) -> DataFrame:
    return ads.groupBy("account_name", "account_id").agg(
        F.count("*").alias("records"),
        F.count_distinct("date_start").alias("days"),
        F.min("date_start").alias("first_date"),
        F.max("date_start").alias("last_date"),
        F.sum(money("spend")).alias("total_spend"),
        _s("impressions").alias("total_impressions"),
        _s("clicks").alias("total_clicks"),
    )


def ad_totals(ad_report: DataFrame) -> DataFrame:
    return ad_report.agg(
        F.count("*").alias("records"),
        F.count_distinct("report_date").alias("days"),
        F.min("report_date").alias("first_date"),
        F.max("report_date").alias("last_date"),
        _s("spend").alias("total_spend"),
        _s("impressions").alias("impressions"),
    )


def daily_spend_deduped(raw_ads: DataFrame, start, end, n: int = 10) -> DataFrame:
    """Spend per day over latest rows only, newest days first. The range is cut before the dedup."""
    in_range = raw_ads.filter(F.col("date_start").between(as_date(start), as_date(end)))
    return (
        ads_base(in_range)
        .groupBy("date_start")
        .agg(F.sum(money("spend")).alias("daily_spend"), F.count("*").alias("ad_count"))
        .orderBy(F.col("date_start").desc())
        .limit(n)
    )


# ----------------------------------------------------------------------- unified tables
def _last(df: DataFrame, as_of, days: int) -> DataFrame:
    return df.filter(F.col("date") >= F.date_sub(as_date(as_of), days))


def campaign_daily(facebook: DataFrame, since) -> DataFrame:
    return (
        facebook.filter(F.col("date") >= as_date(since))
        .groupBy("date", "fb_campaign_name")
        .agg(
            _s("fb_spend").alias("spend"),
            _s("fb_clicks").alias("clicks"),
            F.round(F.avg("fb_ctr_percent"), 10).alias("avg_ctr"),
        )
    )


def platform_daily(tiktok: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        _last(tiktok, as_of, days)
        .groupBy("date")
        .agg(
            _s("tt_spend").alias("spend"),
            _s("tt_conversions").alias("conversions"),
            F.round(F.avg("tt_cpa"), 10).alias("avg_cpa"),
            F.round(F.avg("tt_conversion_rate"), 10).alias("avg_conversion_rate"),
        )
    )


def campaign_roas(google: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        _last(google, as_of, days)
        .filter(F.col("ga_campaign_status") == "ENABLED")
        .groupBy("ga_campaign_name")
        .agg(
            (_s("metrics_cost_micros").cast("double") / 1000000).alias("spend"),
            _s("ga_conversions").alias("conversions"),
            F.round(F.avg("ga_roas"), 10).alias("roas"),
        )
    )


def spend_by_campaign(ads: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        ads.filter(F.col("date_start") >= F.date_sub(as_date(as_of), days))
        .groupBy("campaign_name")
        .agg(F.sum(money("spend")).alias("spend"), _s("impressions").alias("impressions"), _s("clicks").alias("clicks"))
    )


def platform_daily_spend(ad_report: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        ad_report.filter(F.col("report_date") >= F.date_sub(as_date(as_of), days))
        .groupBy(F.col("report_date").alias("date"))
        .agg(*[_s(c).alias(c) for c in ("spend", "impressions", "clicks")])
    )


def search_daily_spend(stats: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        stats.filter(F.col("segments_date") >= F.date_sub(as_date(as_of), days))
        .groupBy(F.col("segments_date").alias("date"))
        .agg(
            (_s("metrics_cost_micros").cast("double") / 1000000).alias("spend_usd"),
            _s("metrics_impressions").alias("impressions"),
            _s("metrics_clicks").alias("clicks"),
        )
    )


def ad_verify(name: str, df: DataFrame, prefix: str) -> DataFrame:
    return df.agg(
        F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.sum(f"{prefix}spend").alias("total_spend")
    )


def google_verify(google: DataFrame) -> DataFrame:
    spend = F.sum("metrics_cost_micros").cast("double") / 1000000
    return google.agg(
        F.lit("google_ads_unified").alias("table_name"),
        F.count("*").alias("row_count"),
        F.count_distinct("ga_campaign_id").alias("unique_campaigns"),
        spend.alias("total_spend"),
        F.sum("ga_conversions").alias("total_conversions"),
        divide(F.sum("ga_conversion_value"), spend).alias("avg_roas"),
    )


def amazon_verify(amazon: DataFrame) -> DataFrame:
    return amazon.agg(
        F.lit("amazon_ads_unified").alias("table_name"),
        F.count("*").alias("row_count"),
        F.sum("amz_spend").alias("total_spend"),
        F.sum("amz_sales").alias("total_sales"),
        divide(F.sum("amz_sales"), F.sum("amz_spend")).alias("avg_roas"),
    )
