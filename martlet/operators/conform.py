"""Bring each extract into one shape: renamed, typed, with per-row ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import (
    as_date,
    digits,
    divide,
    json_decimal,
    json_long,
    json_text,
    money,
    order_number,
    percent,
    query_param,
    to_long,
)
from martlet.operators.joins import left_join_spread


# ------------------------------------------------------------------------- shop
def orders_base(clean_orders: DataFrame) -> DataFrame:
    """Conformed order columns; rows without a creation time are not orders yet."""
    renamed = {
        "order_name": "name",
        "order_created_at": "created_at",
        "order_processed_at": "processed_at",
        "order_cancelled_at": "cancelled_at",
        "order_closed_at": "closed_at",
        "order_tags": "tags",
        "order_currency": "currency",
        "shopify_customer_id": "user_id",
        "order_last_sync_at": "extracted_at",
    }
    amounts = {
        "order_value": "total_price",
        "order_subtotal": "total_line_items_price",
        "order_discounts": "current_total_discounts",
        "order_tax": "total_tax",
    }
    return clean_orders.filter(F.col("created_at").isNotNull()).select(
        F.col("id").alias("order_id"),
        digits("admin_graphql_api_id").alias("order_id_numeric"),
        F.col("email_hash").alias("order_email_hash"),
        F.col("created_at").cast("date").alias("order_date"),
        order_number("name").alias("order_number_clean"),
        "source_name",
        "financial_status",
        "fulfillment_status",
        "cancel_reason",
        "landing_site",
        "referring_site",
        *[F.col(src).alias(dst) for dst, src in renamed.items()],
        *[money(src).alias(dst) for dst, src in amounts.items()],
        shape_json("total_shipping_price_set").alias("shipping_info"),
    )


def customers_enhanced(clean_customers: DataFrame) -> DataFrame:
    consent = [
        json_text(f"{kind}_marketing_consent", f"$.{field}").alias(f"{kind}_consent_{label}")
        for label, field in (("date", "consent_updated_at"), ("status", "state"))
        for kind in ("email", "sms")
    ]
    return clean_customers.select(
        F.col("id").alias("customer_id"),
        F.col("email_hash").alias("customer_email_hash"),
        F.col("state").alias("customer_state"),
        F.col("first_name").alias("customer_first_name"),
        F.col("tags").alias("customer_tags"),
        F.col("created_at").alias("customer_created_at"),
        F.col("orders_count").alias("customer_order_count_shopify"),
        F.col("verified_email").alias("customer_email_verified"),
        F.col("accepts_marketing").alias("customer_accepts_marketing"),
        *consent,
        money("total_spent").alias("customer_lifetime_value_shopify"),
        F.col("extracted_at").alias("customer_last_sync_at"),
    )


# Kind of order by how its name begins.
ORDER_TYPES = {"#": "Shopify Standard", "X-": "Marketplace/External"}


def order_type(name: Column | str) -> Column:
    n = F.col(name) if isinstance(name, str) else name
    kind = F.lit("Other")
    for prefix, label in ORDER_TYPES.items():
        kind = F.when(n.startswith(prefix), label).otherwise(kind)
    return kind


def order_type_counts(clean_orders: DataFrame) -> DataFrame:
    return clean_orders.groupBy(order_type("name").alias("order_type"), "source_name").agg(
        F.count("*").alias("order_count")
    )


def order_numbers(orders: DataFrame) -> DataFrame:
    return orders.select("id", "name", order_number("name").alias("order_number_clean"))


def numeric_ids(df: DataFrame, gid: str) -> DataFrame:
    return df.select(gid, digits(gid).alias("numeric_id"))


def shape_json(col: str) -> Column:
    return F.to_json(F.col(col))


def utm_parameters(utm: DataFrame, source: str = "landing_site_ref_params") -> DataFrame:
    """The five tracking parameters out of a query string, per numeric order id."""
    names = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term")
    return utm.filter(F.col("admin_graphql_api_id").isNotNull()).select(
        digits("admin_graphql_api_id").alias("order_id_numeric"),
        F.col(source).alias("utm_params_raw"),
        *[query_param(source, n).alias(n) for n in names],
    )


def attribution_channel(first_source: Column, order_source: Column) -> Column:
    return F.coalesce(first_source, order_source, F.lit("direct"))


def order_flags(df: DataFrame) -> DataFrame:
    """Cancelled and refunded flags, and the value left after discounts and refunds.

    The price already has discounts taken off; they are subtracted again because
    every downstream figure is defined that way.
    """
    off = F.coalesce(F.col("order_discounts"), F.lit(0)) + F.coalesce(F.col("refunds_total_amount"), F.lit(0))
    return df.withColumns(
        {
            "is_cancelled": F.col("order_cancelled_at").isNotNull(),
            "has_refund": F.coalesce(F.col("refund_count") > 0, F.lit(False)),
            "order_net_value": F.col("order_value") - off,
        }
    )


def shipping_geo(df: DataFrame, address: str = "shipping_address") -> DataFrame:
    return df.withColumns({f"shipping_{f}": json_text(address, f"$.{f}") for f in ("country", "city", "province")})


def variant_cost(products: DataFrame) -> DataFrame:
    """Cost and SKU of the first variant of each product."""
    return products.select(
        "product_id",
        "title",
        "vendor",
        json_decimal("variants", "$[0].cost").alias("cost"),
        json_text("variants", "$[0].sku").alias("sku"),
    )


# -------------------------------------------------------------------------- ads
def ad_ratios(prefix: str, spend: Column, impressions: Column, clicks: Column) -> list[Column]:
    return [
        percent(clicks, impressions).alias(f"{prefix}ctr_percent"),
        divide(spend, clicks).alias(f"{prefix}cpc"),
        (divide(spend, impressions) * 1000).alias(f"{prefix}cpm"),
    ]


def _row_id(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _known(campaign: Column) -> Column:
    return F.coalesce(campaign.cast("string"), F.lit("unknown"))


def ad_unified_facebook(ads: DataFrame) -> DataFrame:
    spend, shown, clicks = money("spend"), to_long("impressions"), to_long("clicks")
    ids = ("account_id", "account_name", "campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name")
    day = F.col("date_start").cast("date")
    return ads.filter(F.col("date_start").isNotNull()).select(
        _row_id(F.col("account_id"), "_", day, "_", _known(F.col("campaign_id"))).alias("fb_row_id"),
        *[F.col(c).alias(f"fb_{c}") for c in ids],
        day.alias("date"),
        "date_start",
        "date_stop",
        spend.alias("fb_spend"),
        shown.alias("fb_impressions"),
        clicks.alias("fb_clicks"),
        to_long("reach").alias("fb_reach"),
        *ad_ratios("fb_", spend, shown, clicks),
        F.col("actions").alias("fb_actions_json"),
        F.col("extract_no").alias("fb_last_sync_at"),
    )


def ad_unified_tiktok(ad_report: DataFrame) -> DataFrame:
    spend, shown, clicks, conv = (F.col(c) for c in ("spend", "impressions", "clicks", "conversions"))
    return ad_report.filter(F.col("report_date").isNotNull()).select(
        _row_id(F.col("report_date"), "_", _known(F.col("campaign_id"))).alias("tt_row_id"),
        F.col("report_date").alias("date"),
        *[F.col(c).alias(f"tt_{c}") for c in ("campaign_id", "adgroup_id", "ad_id")],
        spend.alias("tt_spend"),
        shown.alias("tt_impressions"),
        clicks.alias("tt_clicks"),
        conv.alias("tt_conversions"),
        *ad_ratios("tt_", spend, shown, clicks),
        percent(conv, clicks).alias("tt_conversion_rate"),
        divide(spend, conv).alias("tt_cpa"),
    )


def ad_unified_google(stats: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Search ads; cost arrives in millionths. Campaigns without a dimension row keep their figures."""
    cost = F.col("metrics_cost_micros").cast("double") / 1000000
    shown, clicks, conv = (F.col(f"metrics_{c}") for c in ("impressions", "clicks", "conversions"))
    value = F.col("metrics_conversions_value")
    dated = stats.filter(F.col("segments_date").isNotNull())
    joined = left_join_spread(dated, campaigns.withColumnRenamed("campaign_id", "_campaign"), "campaign_id", "_campaign")
    return joined.select(
        _row_id(F.col("segments_date"), "_", _known(F.col("campaign_id"))).alias("ga_row_id"),
        F.col("segments_date").alias("date"),
        *[F.col(c).alias(f"ga_{c}") for c in ("campaign_id", "campaign_name", "campaign_status")],
        F.col("segments_device").alias("ga_device"),
        F.col("segments_ad_network_type").alias("ga_network_type"),
        cost.alias("ga_spend"),
        shown.alias("ga_impressions"),
        clicks.alias("ga_clicks"),
        conv.alias("ga_conversions"),
        value.alias("ga_conversion_value"),
        *ad_ratios("ga_", cost, shown, clicks),
        percent(conv, clicks).alias("ga_conversion_rate"),
        divide(cost, conv).alias("ga_cpa"),
        divide(value, cost).alias("ga_roas"),
        "metrics_cost_micros",
    )


def ad_unified_amazon(sponsored_products: DataFrame, sponsored_brands: DataFrame) -> DataFrame:
    """Both sponsored reports stacked; conversions and sales are attributed over 14 days."""

    def one(report: DataFrame, suffix: str) -> DataFrame:
        cost, shown, clicks = money("cost"), F.col("impressions"), F.col("clicks")
        conv, sales = F.col("attributed_conversions_14d"), money("attributed_sales_14d")
        return report.filter(F.col("date").isNotNull()).select(
            _row_id(F.col("date"), "_", F.col("campaign_id"), suffix).alias("amz_row_id"),
            "date",
            F.col("campaign_id").alias("amz_campaign_id"),
            F.col("campaign_name").alias("amz_campaign_name"),
            shown.alias("amz_impressions"),
            clicks.alias("amz_clicks"),
            cost.alias("amz_spend"),
            conv.alias("amz_conversions"),
            sales.alias("amz_sales"),
            *ad_ratios("amz_", cost, shown, clicks),
            divide(sales, cost).alias("amz_roas"),
            divide(cost, conv).alias("amz_cpa"),
        )

    return one(sponsored_products, "").unionByName(one(sponsored_brands, "_brand"))


def ad_export_detail(latest_json: DataFrame) -> DataFrame:
    """Detail export: the JSON metrics as 23 typed columns, money and rates rounded to cents."""
    text = ("campaign_name", "adgroup_name", "ad_name")
    rounded = {
        "spend_usd": "spend",
        "ctr_pct": "ctr",
        "cpc_usd": "cpc",
        "cpm_usd": "cpm",
        "cpa_usd": "cost_per_conversion",
        "avg_watch_time_sec": "average_video_play",
    }
    whole = {
        "impressions": "impressions",
        "clicks": "clicks",
        "conversions": "conversion",
        "purchases": "complete_payment",
        "video_plays": "video_play_actions",
        "video_25pct": "video_views_p25",
        "video_50pct": "video_views_p50",
        "video_75pct": "video_views_p75",
        "video_100pct": "video_views_p100",
        "likes": "likes",
        "comments": "comments",
        "shares": "shares",
        "engagements": "engagements",
    }
    fields = [*text, *rounded.values(), *whole.values()]
    schema = ", ".join(f"`{f}` string" for f in fields)
    m = latest_json.select(
        F.col("stat_time_day").cast("date").alias("date"), F.from_json("metrics", schema).alias("m")
    )
    return m.select(
        "date",
        *[F.col(f"m.{c}").alias(c) for c in text],
        *[F.round(F.col(f"m.{src}").cast("decimal(18,6)"), 2).cast("double").alias(dst) for dst, src in rounded.items()],
        *[F.col(f"m.{src}").cast("bigint").alias(dst) for dst, src in whole.items()],
    )


def ad_conversions_from_actions(facebook: DataFrame, as_of, days: int = 30) -> DataFrame:
    conv = json_long("fb_actions_json", "$[0].value")
    return facebook.filter(
        F.col("fb_actions_json").isNotNull() & (F.col("date") >= F.date_sub(as_date(as_of), days))
    ).select(
        "fb_campaign_name",
        "date",
        "fb_clicks",
        conv.alias("conversions"),
        percent(conv, F.col("fb_clicks")).alias("conversion_rate_percent"),
    )


def ad_revenue_from_roas(ads: DataFrame) -> DataFrame:
    """Revenue is the reported return on spend times spend; a missing return counts as zero."""
    spend = money("spend")
    back = F.coalesce(json_decimal("purchase_roas", "$[0].value", "decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return ads.withColumn("spend", spend).withColumn("revenue", back * spend).withColumn(
        "profit", F.col("revenue") - F.col("spend")
    )


# What a zero is put down to.
NORMAL = "Normal"
NO_CAMPAIGN = "No campaign running"
LOW_TRAFFIC = "Low traffic - not enough clicks"
LAG = "Attribution issue or conversion lag"
UNKNOWN_ZERO = "Unknown - investigate"
PAUSED = "Campaign paused or budget exhausted"
SYNC_ISSUE = "Data sync issue - check Airbyte"
# Clicks below which traffic is low; spend and clicks above which no revenue is suspicious.
LOW_CLICKS, SUSPICIOUS_SPEND, SUSPICIOUS_CLICKS = 10, 100, 50


def zero_explanations(marketing: DataFrame) -> DataFrame:
    """Say why a day shows zero revenue or impressions, and flag the zeros that look wrong."""
    no_revenue, unseen = F.col("revenue") == 0, F.col("ad_impressions") == 0
    spend, clicks = F.col("ad_spend"), F.col("ad_clicks")
    after_spend = F.when(clicks < LOW_CLICKS, LOW_TRAFFIC).when(clicks >= LOW_CLICKS, LAG).otherwise(UNKNOWN_ZERO)
    why_no_revenue = F.when(spend == 0, NO_CAMPAIGN).when(spend > 0, after_spend).otherwise(UNKNOWN_ZERO)
    why_unseen = F.when(spend == 0, PAUSED).when(spend > 0, SYNC_ISSUE).otherwise(NORMAL)
    costly = no_revenue & (spend > SUSPICIOUS_SPEND) & (clicks > SUSPICIOUS_CLICKS)
    return marketing.withColumns(
        {
            "revenue_zero_explanation": F.when(no_revenue, why_no_revenue).otherwise(NORMAL),
            "impressions_zero_explanation": F.when(unseen, why_unseen).otherwise(NORMAL),
            "is_suspicious_zero": costly | (unseen & (spend > 0)),
        }
    )


def period_labels(monthly: DataFrame) -> DataFrame:
    label = lambda d: F.date_format(d, "MMMM yyyy")
    return monthly.withColumns(
        {
            "period_label": label(F.col("month")),
            "comparison_period_label": label(F.add_months("month", -12)),
            "comparison_type": F.lit("YoY"),
        }
    )
