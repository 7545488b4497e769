"""Reports: orders, marketing, ads, attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.operators import conform, unify
from martlet.plans import ads, commerce, marketing
from workload.inputs import AS_OF, EVENTS_AS_OF
from workload.registry import SQL, query

DAY = "DATE '2001-08-01'"


def div(a: str, b: str, factor: str = "") -> str:
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0){factor}"


# ------------------------------------------------------------------ orders and products
query("shopify_daily_metrics", lambda x: x.daily_metrics, "SELECT * FROM daily_metrics")
query(
    "shopify_daily_metrics_lite",
    lambda x: commerce.shopify_daily_metrics_lite(x.shop),
    f"""
SELECT date, orders, gross_revenue, net_revenue, aov, unique_customers,
  {div('r', 'unique_customers', ' * 100')} AS returning_customer_pct, c AS cancelled_orders, f AS refunded_orders
FROM daily_metrics JOIN (SELECT order_date AS date, count(*) FILTER (customer_order_count_shopify > 1) AS r,
  count(*) FILTER (is_cancelled) AS c, count(*) FILTER (has_refund) AS f FROM shop GROUP BY 1) USING (date)
""",
)
query("marketing_monthly_performance", lambda x: x.monthly, "SELECT * FROM monthly")
query("product_performance", lambda x: x.products_monthly, "SELECT * FROM products_monthly")
query("executive_summary_monthly", lambda x: marketing.executive_summary(x.marketing), "SELECT * FROM executive")
query("channel_mix", lambda x: marketing.channel_mix(x.marketing, AS_OF), "SELECT * FROM channel_mix")
KPI = {"Gross Revenue": "gross_revenue", "Net Revenue": "net_revenue", "Marketing Spend": "marketing_spend", "Orders": "orders"}
query(
    "exec_kpi_yoy",
    lambda x: marketing.exec_kpi_yoy(x.marketing, AS_OF),
    "SELECT metric, c AS current_value, l AS last_year_value, (c - l) / nullif(l, 0) * 100 AS yoy_change_percent FROM ("
    + " UNION ALL ".join(
        f"SELECT '{k}' AS metric, {v}::DOUBLE AS c, ly_{v}::DOUBLE AS l FROM executive WHERE month = {DAY}"
        for k, v in KPI.items()
    )
    + ") WHERE l IS NOT NULL",
)
SITE = {
    "Orders": "sum(orders)",
    "Net Revenue": "sum(net_revenue)",
    "AOV": "round(avg(aov), 10)",
    "Unique Customers": "sum(unique_customers)",
    "Returning %": "round(avg(returning_customer_pct), 10)",
}
query(
    "sitewide_kpi_yoy",
    lambda x: marketing.sitewide_kpi_yoy(x.daily_metrics, AS_OF),
    "SELECT metric, c AS current_value, (c - l) / nullif(l, 0) * 100 AS yoy_change FROM ("
    + " UNION ALL ".join(
        f"SELECT '{k}' AS metric, (SELECT {v}::DOUBLE FROM daily_metrics WHERE date_trunc('month', date) = {DAY}) AS c, "
        f"(SELECT {v}::DOUBLE FROM daily_metrics WHERE date_trunc('month', date) = DATE '2000-08-01') AS l"
        for k, v in SITE.items()
    )
    + ")",
)
query(
    "marketing_efficiency",
    lambda x: marketing.marketing_efficiency(x.marketing, AS_OF),
    f"""
SELECT date_trunc('month', date)::DATE AS month, sum(net_revenue)::DOUBLE AS net_revenue,
  sum(ad_spend)::DOUBLE AS ad_spend, {div('sum(net_revenue)', 'sum(ad_spend)')} AS mer,
  (sum(net_revenue) - sum(ad_spend))::DOUBLE AS contribution_margin,
  {div('sum(ad_spend)', 'sum(net_revenue)', ' * 100')} AS marketing_pct_of_revenue
FROM marketing WHERE date >= {DAY} - INTERVAL 13 MONTH GROUP BY 1
""",
)
query(
    "sales_trend",
    lambda x: commerce.sales_trend(x.daily_metrics, AS_OF),
    f"""
SELECT date_trunc('month', order_date)::DATE AS month, count(DISTINCT order_id) AS total_orders,
  sum(order_net_value)::DOUBLE AS net_revenue, sum(order_value)::DOUBLE AS gross_revenue
FROM shop WHERE order_date >= {DAY} - INTERVAL 13 MONTH GROUP BY 1
""",
)
query(
    "paid_channel_performance",
    lambda x: marketing.paid_channel_performance(x.marketing, AS_OF),
    f"""
SELECT channel, sum(ad_spend)::DOUBLE AS spend, sum(revenue)::DOUBLE AS revenue, sum(orders)::BIGINT AS orders,
  round(avg(avg_order_value), 10) AS aov, {div('sum(ad_spend)', 'sum(orders)')} AS cpa,
  {div('sum(revenue)', 'sum(ad_spend)')} AS roas
FROM marketing WHERE date >= {DAY} - INTERVAL 1 MONTH AND channel IN ('facebook', 'google', 'tiktok') GROUP BY 1
""",
)
query(
    "top_products",
    lambda x: commerce.top_products(x.shop, AS_OF),
    f"""
SELECT product_titles AS product_name, sum(items_total_original)::DOUBLE AS gross_revenue,
  sum(items_total_original - coalesce(order_discounts, 0))::DOUBLE AS net_revenue,
  sum(total_quantity)::BIGINT AS units_sold,
  {div('sum(items_total_original - coalesce(order_discounts, 0))', 'sum(total_quantity)')} AS avg_price_per_unit
FROM shop WHERE order_date >= {DAY} - INTERVAL 1 MONTH AND product_titles IS NOT NULL
GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20
""",
)
query(
    "top_products_monthly",
    lambda x: commerce.top_products_monthly(x.products_monthly, AS_OF),
    f"""
SELECT product_name, round(sum(gross_revenue), 2) AS revenue, sum(total_units)::BIGINT AS units
FROM products_monthly WHERE month >= {DAY} - INTERVAL 1 MONTH GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
)
query(
    "revenue_month_yoy",
    lambda x: marketing.revenue_month_yoy(x.marketing, AS_OF),
    f"""
SELECT month, gross_revenue AS current_revenue, marketing_spend AS current_spend,
  ly_gross_revenue AS last_year_revenue, gross_revenue_yoy AS yoy_growth_pct FROM executive WHERE year(month) = 2001
""",
)
query(
    "labelled_yoy",
    lambda x: marketing.labelled_yoy(x.marketing, AS_OF),
    f"""
SELECT 'August 2001' AS current_period, gross_revenue AS current_revenue, 'August 2000' AS comparison_period,
  ly_gross_revenue AS last_year_revenue, gross_revenue_yoy AS yoy_growth_pct, 'YoY' AS growth_type
FROM executive WHERE month = {DAY}
""",
)
query(
    "unified_orders_daily",
    lambda x: commerce.unified_orders_daily(x.shop, "2000-01-01"),
    """
SELECT order_date, count(*) AS orders, sum(order_value)::DOUBLE AS revenue, sum(order_net_value)::DOUBLE AS net_revenue,
  count(DISTINCT customer_id) AS unique_customers FROM shop WHERE order_date >= DATE '2000-01-01' GROUP BY 1
""",
)
query(
    "daily_revenue",
    lambda x: commerce.daily_revenue(x.clean_orders, AS_OF),
    f"""
SELECT created_at::DATE AS date, count(*) AS orders, sum(total_price)::DOUBLE AS revenue FROM clean_orders
WHERE created_at >= {DAY} - 30 GROUP BY 1
""",
)
query(
    "recent_orders_utm",
    lambda x: commerce.recent_orders_utm(x.shop_consistent, AS_OF, days=30),
    f"""
SELECT order_id, order_created_at, order_value::DOUBLE AS order_value, utm_source, utm_medium, utm_campaign, customer_id
FROM shop_consistent WHERE order_created_at >= {DAY} - 30 AND order_value > 0
ORDER BY order_created_at DESC, order_id, customer_id NULLS FIRST LIMIT 100
""",
)
query(
    "guest_vs_registered",
    lambda x: commerce.guest_vs_registered(x.shop_consistent),
    f"""
SELECT if(order_email_hash IS NULL, 'NULL (Guest Checkout)', 'Has Email Hash') AS email_status,
  count(*) AS order_count, {div('sum(order_value)', 'count(order_value)')} AS avg_order_value,
  sum(order_value)::DOUBLE AS total_revenue FROM shop_consistent GROUP BY 1
""",
)

# --------------------------------------------------------------------------- ad reports
SUMS = "sum(spend)::DOUBLE AS spend, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks, sum(conversions)::BIGINT AS conversions"
CPA, CTR, CPC = (
    div("sum(spend)", "sum(conversions)"),
    div("sum(clicks)", "sum(impressions)", " * 100"),
    div("sum(spend)", "sum(clicks)"),
)
query(
    "campaign_summary",
    lambda x: ads.campaign_summary(x.ads_latest_json),
    f"""
SELECT campaign_name, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS active_days,
  count(DISTINCT ad_name) AS ads, sum(spend)::DOUBLE AS total_spend_usd, sum(impressions)::BIGINT AS total_impressions,
  sum(clicks)::BIGINT AS total_clicks, sum(conversions)::BIGINT AS total_conversions,
  sum(purchases)::BIGINT AS total_purchases, {CTR} AS ctr_pct, {CPC} AS avg_cpc_usd, {CPA} AS avg_cpa_usd,
  sum(video_plays)::BIGINT AS total_video_plays, sum(likes)::BIGINT AS total_likes, sum(shares)::BIGINT AS total_shares
FROM ad_metrics GROUP BY 1
""",
)
query(
    "ad_monthly_trend",
    lambda x: ads.ad_monthly_trend(x.ads_latest_json),
    f"SELECT strftime(day, '%Y-%m') AS month, {SUMS}, {CTR} AS ctr, {CPC} AS cpc, {CPA} AS cpa FROM ad_metrics GROUP BY 1",
)
query(
    "ad_monthly_trend_since",
    lambda x: ads.ad_monthly_trend(x.ads_latest_json, "2000-01-01"),
    f"""
SELECT strftime(day, '%Y-%m') AS month, {SUMS}, {CTR} AS ctr, {CPC} AS cpc, {CPA} AS cpa FROM ad_metrics
WHERE day >= DATE '2000-01-01' GROUP BY 1
""",
)
query(
    "top_ads_by_conversions",
    lambda x: ads.top_ads_by_conversions(x.ads_latest_json, AS_OF),
    f"""
SELECT ad_name, campaign_name, {SUMS}, {CTR} AS ctr_pct, {CPA} AS cpa_usd FROM ad_metrics
WHERE day >= {DAY} - INTERVAL 6 MONTH GROUP BY 1, 2 HAVING sum(conversions) > 0
ORDER BY sum(conversions) DESC, 1, 2 LIMIT 50
""",
)
query(
    "ad_yearly",
    lambda x: ads.ad_yearly(x.ads_latest_json),
    f"""
SELECT year(day) AS year, sum(spend)::DOUBLE AS spend, sum(impressions)::BIGINT AS impressions,
  sum(conversions)::BIGINT AS conversions, {CPA} AS cpa FROM ad_metrics GROUP BY 1
""",
)
query(
    "campaign_type_performance",
    lambda x: ads.campaign_type_performance(x.ads_latest_json),
    f"""
SELECT CASE WHEN campaign_name LIKE '%remarketing%' THEN 'Remarketing' WHEN campaign_name LIKE '%prospecting%'
    THEN 'Prospecting' WHEN campaign_name LIKE '%Catalog%' THEN 'Catalogue/Smart' WHEN campaign_name LIKE '%search%'
    THEN 'Search' ELSE 'Other' END AS campaign_type,
  sum(spend)::DOUBLE AS spend, sum(conversions)::BIGINT AS conversions, {CPA} AS cpa, {CTR} AS ctr
FROM ad_metrics GROUP BY 1
""",
)
CHEAP = f"sum(spend)::DOUBLE AS spend, sum(conversions)::BIGINT AS conversions, {CPA} AS cpa, {CTR} AS ctr"
query(
    "top_campaigns_by_cpa",
    lambda x: ads.top_campaigns_by_cpa(x.ads_latest_json),
    f"""
SELECT campaign_name, {CHEAP} FROM ad_metrics GROUP BY 1 HAVING sum(conversions) > 100 ORDER BY cpa, 1 LIMIT 10
""",
)
query(
    "top_recent_ads",
    lambda x: ads.top_recent_ads(x.ads_latest_json, "2000-06-01"),
    f"""
SELECT ad_name, campaign_name, {CHEAP} FROM ad_metrics WHERE day >= DATE '2000-06-01' GROUP BY 1, 2
HAVING sum(conversions) > 50 ORDER BY cpa, 1, 2 LIMIT 15
""",
)
query(
    "day_of_week_performance",
    lambda x: ads.day_of_week_performance(x.ads_latest_json, "2000-01-01"),
    f"""
SELECT dayname(day) AS day_name, dayofweek(day) + 1 AS day_num, {div('sum(spend)', 'count(*)')} AS avg_spend,
  {div('sum(conversions)', 'count(*)')} AS avg_conversions, {CPA} AS cpa
FROM ad_metrics WHERE day >= DATE '2000-01-01' GROUP BY 1, 2
""",
)
VIDEO = {25: "p25", 50: "p50", 75: "p75", 100: "p100"}
query(
    "video_engagement",
    lambda x: ads.video_engagement(x.ads_latest_json),
    "SELECT sum(video_plays)::BIGINT AS video_plays, "
    + ", ".join(f"sum((metrics ->> '$.video_views_{p}')::BIGINT)::BIGINT AS views_{n}pct" for n, p in VIDEO.items())
    + f", {div('''sum((metrics ->> '$.average_video_play')::DECIMAL(18,2))''', 'count(*)')} AS avg_watch_time,"
    " sum(likes)::BIGINT AS likes, sum(comments)::BIGINT AS comments, sum(shares)::BIGINT AS shares FROM ad_metrics",
)
RETURNS = (
    "(SELECT * REPLACE (spend::DECIMAL(18,2) AS spend), spend::DECIMAL(18,2) * "
    "ifnull((purchase_roas ->> '$[0].value')::DECIMAL(8,2), 0) AS revenue FROM ads)"
)
RET = f"sum(spend)::DOUBLE AS spend, sum(revenue)::DOUBLE AS revenue, {div('sum(revenue)', 'sum(spend)')} AS roas"
query(
    "ad_overall",
    lambda x: ads.ad_overall(x.ads),
    f"""
SELECT {RET}, sum(impressions)::BIGINT AS total_impressions, sum(clicks)::BIGINT AS total_clicks, {CTR} AS ctr,
  {CPC} AS cpc FROM {RETURNS}
""",
)
query(
    "ad_by_country",
    lambda x: ads.ad_by_country(x.ads),
    f"""
SELECT country, {RET}, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks,
  (sum(revenue) - sum(spend))::DOUBLE AS profit FROM {RETURNS} GROUP BY 1 HAVING sum(spend) > 100
""",
)
query(
    "campaign_country",
    lambda x: ads.campaign_country(x.ads),
    f"""
SELECT campaign_name, country, {RET}, sum(clicks)::BIGINT AS clicks FROM {RETURNS} GROUP BY 1, 2
HAVING sum(spend) > 1000
""",
)


def no_returns_saturday_to_wednesday(x):
    """Ads whose days from Saturday to Wednesday brought no reported return, so that some campaigns lose money."""
    quiet = F.dayofweek("date_start").isin(1, 2, 3, 4, 7)
    return x.ads.withColumn("purchase_roas", F.when(~quiet, F.col("purchase_roas")))


query(
    "loss_making_campaigns",
    lambda x: ads.loss_making_campaigns(no_returns_saturday_to_wednesday(x)),
    f"""
SELECT campaign_name, country, sum(spend)::DOUBLE AS spend, sum(r)::DOUBLE AS revenue,
  {div('sum(r)', 'sum(spend)')} AS roas, (sum(r) - sum(spend))::DOUBLE AS loss
FROM (SELECT *, if(dayofweek(date_start) IN (4, 5), revenue, 0) AS r FROM {RETURNS}) GROUP BY 1, 2
HAVING sum(r) < sum(spend) AND sum(spend) > 500
""",
)
FIVE = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4")
query(
    "country_monthly",
    lambda x: ads.country_monthly(x.ads, FIVE),
    f"""
SELECT strftime(date_start, '%Y-%m') AS month, country, {RET} FROM {RETURNS} WHERE country IN {FIVE} GROUP BY 1, 2
""",
)
query(
    "account_summary",
    lambda x: ads.account_summary(x.ads),
    """
SELECT account_name, account_id, count(*) AS records, count(DISTINCT date_start) AS days, min(date_start) AS first_date,
  max(date_start) AS last_date, sum(spend::DECIMAL(18,2))::DOUBLE AS total_spend,
  sum(impressions)::BIGINT AS total_impressions, sum(clicks)::BIGINT AS total_clicks FROM ads GROUP BY 1, 2
""",
)
query(
    "campaign_daily",
    lambda x: ads.campaign_daily(x.facebook, "2000-01-01"),
    """
SELECT date, fb_campaign_name, sum(fb_spend)::DOUBLE AS spend, sum(fb_clicks)::BIGINT AS clicks,
  round(avg(fb_ctr_percent), 10) AS avg_ctr FROM facebook WHERE date >= DATE '2000-01-01' GROUP BY 1, 2
""",
)
query(
    "platform_daily",
    lambda x: ads.platform_daily(x.tiktok, AS_OF),
    f"""
SELECT date, sum(tt_spend)::DOUBLE AS spend, sum(tt_conversions)::BIGINT AS conversions, round(avg(tt_cpa), 10) AS avg_cpa,
  round(avg(tt_conversion_rate), 10) AS avg_conversion_rate FROM tiktok WHERE date >= {DAY} - 30 GROUP BY 1
""",
)
query(
    "campaign_roas",
    lambda x: ads.campaign_roas(x.google, AS_OF),
    f"""
SELECT ga_campaign_name, sum(metrics_cost_micros)::DOUBLE / 1000000 AS spend, sum(ga_conversions)::BIGINT AS conversions,
  round(avg(ga_roas), 10) AS roas FROM google WHERE date >= {DAY} - 30 AND ga_campaign_status = 'ENABLED' GROUP BY 1
""",
)
query(
    "spend_by_campaign",
    lambda x: ads.spend_by_campaign(x.ads, AS_OF),
    f"""
SELECT campaign_name, sum(spend::DECIMAL(18,2))::DOUBLE AS spend, sum(impressions)::BIGINT AS impressions,
  sum(clicks)::BIGINT AS clicks FROM ads WHERE date_start >= {DAY} - 7 GROUP BY 1
""",
)
query(
    "platform_daily_spend",
    lambda x: ads.platform_daily_spend(x.ad_report, AS_OF),
    f"""
SELECT report_date AS date, sum(spend)::DOUBLE AS spend, sum(impressions)::BIGINT AS impressions,
  sum(clicks)::BIGINT AS clicks FROM ad_report WHERE report_date >= {DAY} - 7 GROUP BY 1
""",
)
query(
    "search_daily_spend",
    lambda x: ads.search_daily_spend(x.campaign_stats, AS_OF),
    f"""
SELECT segments_date AS date, sum(metrics_cost_micros)::DOUBLE / 1000000 AS spend_usd,
  sum(metrics_impressions)::BIGINT AS impressions, sum(metrics_clicks)::BIGINT AS clicks
FROM campaign_stats WHERE segments_date >= {DAY} - 7 GROUP BY 1
""",
)
query(
    "daily_spend_deduped",
    lambda x: ads.daily_spend_deduped(x.raw_ads, "2001-01-01", AS_OF),
    f"""
SELECT date_start, sum(spend::DECIMAL(18,2))::DOUBLE AS daily_spend, count(*) AS ad_count FROM ads
WHERE date_start BETWEEN DATE '2001-01-01' AND {DAY} GROUP BY 1 ORDER BY 1 DESC LIMIT 10
""",
)
query(
    "ad_totals",
    lambda x: ads.ad_totals(x.ad_report),
    """
SELECT count(*) AS records, count(DISTINCT report_date) AS days, min(report_date) AS first_date,
  max(report_date) AS last_date, sum(spend)::DOUBLE AS total_spend, sum(impressions)::BIGINT AS impressions FROM ad_report
""",
)

# ---------------------------------------------------------------------- channel reports
OVERVIEW = f"""
SELECT channel, sum(ad_spend)::DOUBLE AS total_spend, sum(revenue)::DOUBLE AS total_revenue,
  {div('sum(revenue)', 'sum(ad_spend)')} AS roas, sum(orders)::BIGINT AS total_orders,
  {div('sum(ad_spend)', 'sum(orders)')} AS cpa FROM marketing
"""
query(
    "channel_overview",
    lambda x: marketing.channel_overview(x.marketing, AS_OF),
    f"{OVERVIEW} WHERE date >= {DAY} - 90 GROUP BY 1",
)
query(
    "channel_overview_all_time",
    lambda x: marketing.channel_overview(x.marketing, days=None),
    f"{OVERVIEW} GROUP BY 1",
)
query(
    "channel_daily_roas",
    lambda x: marketing.channel_daily_roas(x.marketing, AS_OF),
    f"""
SELECT date, channel, sum(revenue)::DOUBLE AS revenue, sum(ad_spend)::DOUBLE AS spend,
  {div('sum(revenue)', 'sum(ad_spend)')} AS roas FROM marketing WHERE date >= {DAY} - 7 GROUP BY 1, 2
""",
)
query(
    "channel_rows",
    lambda x: marketing.channel_rows(x.marketing, AS_OF, ["facebook", "tiktok"]),
    f"""
SELECT date, channel, ad_spend::DOUBLE AS ad_spend, revenue::DOUBLE AS revenue, ad_clicks, roas FROM marketing
WHERE date >= {DAY} - 7 AND channel IN ('facebook', 'tiktok')
""",
)
query(
    "monthly_index",
    lambda x: marketing.monthly_index(x.marketing, AS_OF),
    f"""
SELECT strftime(date, '%Y-%m') AS month, sum(ad_spend)::DOUBLE AS spend, sum(revenue)::DOUBLE AS revenue,
  sum(orders)::BIGINT AS orders, {div('sum(revenue)', 'sum(ad_spend)')} AS mer, {div('sum(ad_spend)', 'sum(orders)')}
  AS cpo, {div('sum(revenue)', 'sum(orders)')} AS aov FROM marketing WHERE date >= {DAY} - INTERVAL 8 MONTH GROUP BY 1
""",
)

# ------------------------------------------------------------------ attribution reports
query(
    "customer_journey",
    lambda x: commerce.customer_journey(x.utm),
    f"""
SELECT first_utm_source, last_utm_source, count(*) AS orders, {div('sum(days_to_conversion)', 'count(*)')}
  AS avg_days_to_convert, sum(total_price)::DOUBLE AS total_revenue FROM utm WHERE first_utm_source IS NOT NULL
GROUP BY 1, 2
""",
)
query(
    "new_vs_returning",
    lambda x: commerce.new_vs_returning(x.utm),
    f"""
SELECT if(customer_order_index = 1, 'New Customer', 'Returning') AS customer_type, first_utm_source,
  count(*) AS orders, sum(total_price)::DOUBLE AS revenue, {div('sum(total_price)', 'count(*)')} AS aov
FROM utm GROUP BY 1, 2
""",
)
query(
    "event_funnel",
    lambda x: commerce.event_funnel(x.web_events),
    """
SELECT event_name, count(*) AS event_count, count(DISTINCT user_pseudo_id) AS unique_users FROM web_events
WHERE event_name IN ('page_view', 'view_item', 'add_to_cart', 'purchase') GROUP BY 1
""",
)
query(
    "revenue_by_attribution_status",
    lambda x: commerce.revenue_by_attribution_status(x.utm),
    f"""
SELECT attribution_status, count(*) AS order_count, sum(total_price)::DOUBLE AS total_revenue,
  {div('sum(total_price)', 'count(*)')} AS avg_order_value FROM utm GROUP BY 1
""",
)
query(
    "channel_by_month",
    lambda x: commerce.channel_by_month(x.utm, "2000-01-01"),
    """
SELECT strftime(created_at, '%Y-%m') AS month, sales_channel, count(*) AS orders, sum(total_price)::DOUBLE AS revenue
FROM utm WHERE created_at >= TIMESTAMP '2000-01-01' GROUP BY 1, 2
""",
)
query(
    "orders_without_channel_by_year",
    lambda x: commerce.orders_without_channel_by_year(x.utm),
    """
SELECT year(created_at) AS year, count(*) AS orders_without_channel FROM utm WHERE sales_channel IS NULL GROUP BY 1
""",
)
query(
    "attribution_status_distribution",
    lambda x: commerce.attribution_status_distribution(x.utm),
    "SELECT attribution_status, count(*) AS order_count FROM utm GROUP BY 1",
)
query(
    "attribution_status_by_channel",
    lambda x: commerce.attribution_status_distribution(x.utm, by_channel=True),
    "SELECT attribution_status, sales_channel, count(*) AS order_count FROM utm GROUP BY 1, 2",
)
query(
    "unknown_channel_profile",
    lambda x: commerce.unknown_channel_profile(x.utm),
    """
SELECT sales_channel, count(*) AS order_count, min(created_at) AS first_order, max(created_at) AS last_order FROM utm
WHERE attribution_status = 'UNKNOWN_CHANNEL' GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20
""",
)
query(
    "unknown_channel_samples",
    lambda x: commerce.unknown_channel_samples(x.utm),
    """
SELECT order_id, order_name, created_at, total_price::DOUBLE AS total_price FROM utm
WHERE attribution_status = 'UNKNOWN_CHANNEL' ORDER BY created_at DESC, order_id LIMIT 20
""",
)
query(
    "revenue_by_utm_source",
    lambda x: commerce.revenue_by_utm_source(x.utm, AS_OF),
    f"""
SELECT first_utm_source, count(*) AS orders, sum(total_price)::DOUBLE AS revenue FROM utm
WHERE created_at >= {DAY} - 30 AND first_utm_source IS NOT NULL GROUP BY 1
""",
)
query(
    "utm_coverage",
    lambda x: commerce.utm_coverage(x.shop_consistent, AS_OF),
    f"""
SELECT count(*) AS total_orders, count(utm_source) AS orders_with_utm, {div('count(utm_source)', 'count(*)', ' * 100')}
  AS utm_coverage_pct FROM shop_consistent WHERE order_date >= {DAY} - 30
""",
)
query(
    "conversion_source_split",
    lambda x: commerce.conversion_source_split(x.conversions, EVENTS_AS_OF),
    """
SELECT count(*) AS total_purchases, count(*) FILTER (event_id % 3 = 0) AS pixel_purchases,
  count(*) FILTER (event_id % 3 <> 0) AS api_purchases FROM web_events
WHERE event_name = 'purchase' AND ts >= TIMESTAMP '2024-01-24'
""",
)
query(
    "order_totals",
    lambda x: commerce.order_totals(x.order_history),
    """
SELECT count(*) AS total_orders, count(DISTINCT created_at::DATE) AS days, min(created_at::DATE) AS first_date,
  max(created_at::DATE) AS last_date, sum(total_price)::DOUBLE AS total_revenue,
  count(DISTINCT customer_id) AS unique_customers FROM order_history
""",
)
query(
    "utm_totals",
    lambda x: commerce.utm_totals(x.utm),
    f"""
SELECT count(*) AS total_records, count(first_utm_source) AS with_utm,
  {div('count(first_utm_source)', 'count(*)', ' * 100')} AS utm_rate, min(created_at::DATE) AS first_date,
  max(created_at::DATE) AS last_date, sum(total_price)::DOUBLE AS total_revenue FROM utm
""",
)
query(
    "utm_extract_status",
    lambda x: commerce.utm_extract_status(x.utm, "2001-08-01 00:00:00"),
    """
SELECT max(extracted_at) AS last_extraction, count(*) FILTER (created_at >= TIMESTAMP '2001-07-31') AS recent_orders
FROM utm
""",
)

# ----------------------------------------------------------------- verification of tables
query(
    "unified_verify_shop",
    lambda x: commerce.shop_verify(x.shop),
    """
SELECT 'shopify_unified' AS table_name, count(*) AS row_count, count(DISTINCT order_id) AS unique_orders,
  count(DISTINCT customer_id) AS unique_customers, sum(order_value)::DOUBLE AS total_gmv,
  sum(order_net_value)::DOUBLE AS total_net_gmv FROM shop
""",
)
query(
    "unified_verify_ads",
    lambda x: ads.ad_verify("facebook_unified", x.facebook, "fb_").unionByName(
        ads.ad_verify("tiktok_unified", x.tiktok, "tt_")
    ),
    """
SELECT 'facebook_unified' AS table_name, count(*) AS row_count, sum(fb_spend)::DOUBLE AS total_spend FROM facebook
UNION ALL SELECT 'tiktok_unified', count(*), sum(tt_spend)::DOUBLE FROM tiktok
""",
)
query(
    "unified_verify_google",
    lambda x: ads.google_verify(x.google),
    """
SELECT 'google_ads_unified' AS table_name, count(*) AS row_count, count(DISTINCT ga_campaign_id) AS unique_campaigns,
  sum(metrics_cost_micros)::DOUBLE / 1000000 AS total_spend, sum(ga_conversions)::BIGINT AS total_conversions,
  sum(ga_conversion_value)::DOUBLE / (sum(metrics_cost_micros)::DOUBLE / 1000000) AS avg_roas FROM google
""",
)
query(
    "unified_verify_amazon",
    lambda x: ads.amazon_verify(x.amazon),
    """
SELECT 'amazon_ads_unified' AS table_name, count(*) AS row_count, sum(amz_spend)::DOUBLE AS total_spend,
  sum(amz_sales)::DOUBLE AS total_sales, sum(amz_sales)::DOUBLE / sum(amz_spend)::DOUBLE AS avg_roas FROM amazon
""",
)
query(
    "unified_verify_marketing",
    lambda x: marketing.marketing_verify(x.marketing),
    """
SELECT 'marketing_unified' AS table_name, count(*) AS row_count, sum(revenue)::DOUBLE AS total_revenue,
  sum(ad_spend)::DOUBLE AS total_spend, sum(revenue)::DOUBLE / sum(ad_spend)::DOUBLE AS overall_roas FROM marketing
""",
)
def verified(x):
    """Every unified table with its own figures; what two of them read is landed once."""
    shop, facebook, tiktok = x.land(
        "shop", "facebook", "tiktok", shop_columns=[*commerce.VERIFY_COLUMNS, *unify.DAILY_COLUMNS]
    )
    return marketing.unified_verify(
        [
            commerce.shop_verify(shop),
            ads.ad_verify("facebook_unified", facebook, "fb_"),
            ads.ad_verify("tiktok_unified", tiktok, "tt_"),
            ads.google_verify(x.google),
            ads.amazon_verify(x.amazon),
            marketing.marketing_verify(x.marketing),
        ]
    )


query(
    "unified_verify",
    verified,
    "SELECT table_name AS view_name, * EXCLUDE (table_name) FROM ("
    + " UNION ALL BY NAME ".join(f"({SQL[f'unified_verify_{t}']})" for t in ("shop", "ads", "google", "amazon", "marketing"))
    + ")",
)


def daily_and_monthly(x):
    x.land("shop", "marketing", shop_columns=[*unify.DAILY_COLUMNS, *commerce.METRIC_COLUMNS, *commerce.PRODUCT_COLUMNS])
    return x.daily_metrics, x.monthly


query(
    "view_row_counts",
    lambda x: marketing.view_row_counts(
        {
            **dict(zip(("shopify_daily_metrics", "marketing_monthly_performance"), daily_and_monthly(x))),
            "product_performance": x.products_monthly,
            "executive_summary_monthly": marketing.executive_summary(x.marketing),
            "channel_mix": marketing.channel_mix(x.marketing, AS_OF),
        }
    ),
    " UNION ALL ".join(
        f"SELECT '{n}' AS view_name, count(*) AS row_count FROM {v}"
        for n, v in {
            "shopify_daily_metrics": "daily_metrics",
            "marketing_monthly_performance": "monthly",
            "product_performance": "products_monthly",
            "executive_summary_monthly": "executive",
            "channel_mix": "channel_mix",
        }.items()
    ),
)

# ---------------------------------------------------------------------------- segments
query(
    "customer_segments",
    lambda x: commerce.customer_segments(x.shop),
    """
SELECT *, customers::DOUBLE / (sum(customers) OVER ())::DOUBLE * 100 AS customer_share_pct,
  revenue / (sum(revenue) OVER ()) * 100 AS revenue_share_pct
FROM (SELECT if(customer_order_count_shopify > 1, 'Returning', 'New') AS segment,
  count(DISTINCT customer_id) AS customers, count(*) AS orders, sum(order_net_value)::DOUBLE AS revenue,
  sum(order_value)::DOUBLE / count(*) AS aov FROM shop WHERE customer_id IS NOT NULL GROUP BY 1)
""",
)


def orders_with_geo(x):
    return conform.shipping_geo(x.raw_orders).select(
        "shipping_province", F.col("created_at").cast("date").alias("order_date"), F.col("total_price").alias("order_value")
    )


query(
    "region_performance",
    lambda x: commerce.region_performance(orders_with_geo(x), AS_OF),
    f"""
SELECT region, r::DOUBLE AS revenue, n AS orders, r::DOUBLE / nullif(n, 0) AS aov,
  (r - b)::DOUBLE / nullif(b::DOUBLE, 0) * 100 AS yoy_pct
FROM (SELECT shipping_address ->> '$.province' AS region,
    sum(total_price) FILTER (created_at::DATE > {DAY} - INTERVAL 12 MONTH) AS r,
    count(*) FILTER (created_at::DATE > {DAY} - INTERVAL 12 MONTH) AS n,
    sum(total_price) FILTER (created_at::DATE <= {DAY} - INTERVAL 12 MONTH) AS b
  FROM raw_orders WHERE created_at::DATE > {DAY} - INTERVAL 24 MONTH GROUP BY 1)
WHERE region IS NOT NULL ORDER BY r DESC NULLS LAST, region LIMIT 5
""",
)
