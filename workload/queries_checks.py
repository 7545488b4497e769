"""Data-quality checks, reconciliation, monitoring, streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from martlet.functions import as_timestamp, digits
from martlet.operators import checks, conform, digests, monitor, quality, reconcile, unify
from martlet.sources import tables
from martlet.streaming import streams
from workload.inputs import AS_OF, BASELINE_AS_OF, EVENTS_AS_OF
from workload.registry import fresh_folder, query

DAY = "DATE '2001-08-01'"
NOW = "TIMESTAMP '2024-01-31'"


def pct(a: str, b: str) -> str:
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0) * 100"


# ------------------------------------------------------------------ five basic checks
query(
    "check_price_format",
    lambda x: quality.check_price_format(x.clean_orders, "total_price", "orders"),
    """
SELECT 'Price Format' AS check_name, 'orders' AS table_name, *, CASE WHEN median_price > 1000 OR critical_count > 0
  THEN 'CRITICAL' WHEN suspicious_count > 0 THEN 'WARNING' ELSE 'PASS' END AS status
FROM (SELECT median(total_price::DOUBLE) AS median_price, max(total_price)::DOUBLE AS max_price,
  count(*) FILTER (total_price > 10000) AS suspicious_count, count(*) FILTER (total_price > 100000) AS critical_count
  FROM clean_orders)
""",
)
DUPLICATES = """
SELECT 'Duplicate Detection' AS check_name, '{table}' AS table_name, *,
  CASE WHEN duplicate_rate_pct > 1 THEN 'CRITICAL' WHEN duplicate_rate_pct > 0.1 THEN 'WARNING' ELSE 'PASS' END AS status
FROM (SELECT count(*) FILTER (n > 1) AS duplicate_keys, ifnull(sum(n) FILTER (n > 1), 0)::BIGINT AS total_duplicate_rows,
    sum(n)::BIGINT AS total_rows, count(*) FILTER (n > 1)::DOUBLE / sum(n)::DOUBLE * 100 AS duplicate_rate_pct
  FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys}))
"""
query(
    "check_duplicates",
    lambda x: quality.check_duplicates(x.raw_orders, ["id"], "raw_orders"),
    DUPLICATES.format(table="raw_orders", source="raw_orders", keys="id"),
)
query(
    "check_duplicates_ads",
    lambda x: quality.check_duplicates(x.raw_ads, ["ad_id", "date_start", "account_id"], "raw_ads"),
    DUPLICATES.format(table="raw_ads", source="raw_ads", keys="ad_id, date_start, account_id"),
)
NULL_FIELDS = ["id", "email", "phone", "browser_ip", "total_price", "created_at"]
query(
    "null_rate_per_field",
    lambda x: quality.null_counts(x.raw_orders, NULL_FIELDS),
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS total_rows, count(*) - count({f}) AS null_count, "
        f"{pct(f'count(*) - count({f})', 'count(*)')} AS rate_pct FROM raw_orders"
        for f in NULL_FIELDS
    ),
)
query(
    "check_null_rates",
    lambda x: quality.check_null_rates(x.raw_orders, NULL_FIELDS, "raw_orders"),
    """
SELECT 'Null Rate' AS check_name, 'raw_orders' AS table_name, count(*) AS total_rows,
  (count(*) - count(phone))::DOUBLE / count(*) * 100 AS max_null_rate, 'phone' AS worst_field,
  CASE WHEN count(phone) < count(*) * 0.8 THEN 'CRITICAL' WHEN count(phone) < count(*) * 0.95 THEN 'WARNING'
    ELSE 'PASS' END AS status
FROM raw_orders
HAVING count(phone) <= least(count(id), count(email), count(browser_ip), count(total_price), count(created_at))
""",
)
query(
    "check_freshness",
    lambda x: quality.check_freshness(x.web_events, "ts", EVENTS_AS_OF, "web_events"),
    f"""
SELECT 'Data Freshness' AS check_name, 'web_events' AS table_name, max(ts) AS latest_record, min(ts) AS earliest_record,
  count(*) AS total_records, floor(epoch({NOW} - max(ts)) / 3600)::BIGINT AS hours_since_last,
  CASE WHEN epoch({NOW} - max(ts)) >= 7 * 3600 THEN 'CRITICAL' WHEN epoch({NOW} - max(ts)) >= 2 * 3600 THEN 'WARNING'
    ELSE 'PASS' END AS status
FROM web_events
""",
)
query(
    "check_record_count",
    lambda x: quality.check_record_count(x.clean_orders, F.col("created_at").cast("date"), "orders"),
    """
SELECT 'Record Count' AS check_name, 'orders' AS table_name, count(*) AS total_count,
  count(DISTINCT created_at::DATE) AS unique_days, if(count(*) = 0, 'WARNING', 'PASS') AS status FROM clean_orders
""",
)


def platforms(x):
    return [
        quality.Platform("shopify", x.clean_orders, ["id"], "created_at", ["id", "total_price", "email_hash", "created_at"], "total_price"),
        quality.Platform("facebook", x.ads, ["ad_id", "date_start", "account_id"], "date_start", ["ad_id", "spend", "impressions", "date_start"]),
        quality.Platform("tiktok", x.ad_report, ["ad_id", "report_date"], "report_date", ["ad_id", "report_date"]),
        quality.Platform("google", x.google, ["ga_row_id"], "date", ["date"], enabled=False),
    ]


def all_checks(x):
    return quality.run_checks(platforms(x), f"{AS_OF} 00:00:00", "2001-01-01", AS_OF)


IN_RANGE = "BETWEEN DATE '2001-01-01' AND DATE '2001-08-01'"
RUN_CHECKS = f"""
WITH o AS (SELECT * FROM clean_orders WHERE created_at::DATE {IN_RANGE}),
f AS (SELECT * FROM ads WHERE date_start {IN_RANGE}), t AS (SELECT * FROM ad_report WHERE report_date {IN_RANGE}),
r(check_name, table_name, observed, warn, crit) AS (
  SELECT 'Price Format', 'shopify', median(total_price::DOUBLE), 0, 1000 FROM o
  UNION ALL SELECT 'Duplicate Detection', unnest(['shopify', 'facebook', 'tiktok']), 0.0, 0.1, 1
  UNION ALL SELECT 'Null Rate', 'shopify', {pct('count(*) - count(email_hash)', 'count(*)')}, 5, 20 FROM o
  UNION ALL SELECT 'Null Rate', 'facebook', 0, 5, 20 UNION ALL SELECT 'Null Rate', 'tiktok', 0, 5, 20
  UNION ALL SELECT 'Data Freshness', 'shopify', datediff('hour', max(created_at), {DAY}::TIMESTAMP), 1, 6 FROM clean_orders
  UNION ALL SELECT 'Data Freshness', 'facebook', datediff('hour', max(date_start)::TIMESTAMP, {DAY}::TIMESTAMP), 1, 6 FROM ads
  UNION ALL SELECT 'Data Freshness', 'tiktok', datediff('hour', max(report_date)::TIMESTAMP, {DAY}::TIMESTAMP), 1, 6
    FROM ad_report
  UNION ALL SELECT 'Record Count', 'shopify', count(*), 1e18, 1e18 FROM o
  UNION ALL SELECT 'Record Count', 'facebook', count(*), 1e18, 1e18 FROM f
  UNION ALL SELECT 'Record Count', 'tiktok', count(*), 1e18, 1e18 FROM t)
SELECT check_name, table_name, observed::DOUBLE AS observed,
  CASE WHEN observed > crit THEN 'CRITICAL' WHEN observed > warn THEN 'WARNING' ELSE 'PASS' END AS status FROM r
"""
query(
    "run_checks",
    lambda x: all_checks(x).select("check_name", "table_name", "status", "observed"),
    RUN_CHECKS,
)
query(
    "summarise_checks",
    lambda x: quality.summarise_checks(all_checks(x)),
    """
SELECT 13 AS total_checks, 13 - w - c AS passed, w AS warnings, c AS critical, 0 AS errors,
  CASE WHEN c > 0 THEN 'CRITICAL' WHEN w > 0 THEN 'WARNING' ELSE 'PASS' END AS overall_status
FROM (SELECT (median(total_price) > 1000)::BIGINT + (count(email_hash) < count(*) * 0.8)::BIGINT AS c,
  (count(email_hash) >= count(*) * 0.8 AND count(email_hash) < count(*) * 0.95)::BIGINT AS w
  FROM clean_orders WHERE created_at::DATE BETWEEN DATE '2001-01-01' AND DATE '2001-08-01')
""",
)



def exported(x):
    """What each of the three files says."""
    folder = fresh_folder(x.spark, "results")
    tables.export_results(all_checks(x), folder)
    read = {
        "checks.json": x.spark.read.json(f"{folder}/checks.json"),
        "checks.csv": x.spark.read.option("header", True).option("escape", '"').csv(f"{folder}/checks.csv"),
        "action_items.json": x.spark.read.json(f"{folder}/action_items.json"),
    }
    return checks.union(
        df.select(
            F.lit(file).alias("file"), "check_name", "table_name", "status", F.col("observed").cast("double").alias("observed"),
            *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in ("cause", "impact", "action")],
        )
        for file, df in read.items()
    )


def advice_sql(place: int) -> str:
    return "CASE check_name " + " ".join(f"WHEN '{n}' THEN '{texts[place]}'" for n, texts in checks.ADVICE.items()) + " END"


query(
    "export_results",
    exported,
    f"""
SELECT file, check_name, table_name, status, observed, NULL::VARCHAR AS cause, NULL::VARCHAR AS impact, NULL::VARCHAR AS action
FROM ({RUN_CHECKS}), (VALUES ('checks.json'), ('checks.csv')) f(file)
UNION ALL SELECT 'action_items.json', check_name, table_name, status, observed, {advice_sql(0)}, {advice_sql(1)}, {advice_sql(2)}
FROM ({RUN_CHECKS}) WHERE status <> 'PASS'
""",
)

# ---------------------------------------------------------------------- audit variants
DISTINCT = """
SELECT 'Duplicates' AS check_name, '{t}' AS table_name, total, distinct_keys, total - distinct_keys AS duplicates,
  (total - distinct_keys)::DOUBLE / total * 100 AS pct, {status} AS status
FROM (SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {t})) AS distinct_keys FROM {t})
"""
query(
    "dup_by_distinct",
    lambda x: checks.union(
        [
            quality.dup_by_distinct(x.raw_orders, ["id"], "raw_orders", raw=True),
            quality.dup_by_distinct(x.raw_customers, ["id"], "raw_customers", raw=True),
            quality.dup_by_distinct(x.clean_orders, ["id"], "clean_orders"),
            quality.dup_by_distinct(x.raw_ads, ["ad_id", "date_start", "account_id"], "raw_ads"),
        ]
    ),
    " UNION ALL ".join(
        DISTINCT.format(t=t, keys=k, status=s)
        for t, k, s in (
            ("raw_orders", "id", "if(total = distinct_keys, 'PASS', 'WARNING')"),
            ("raw_customers", "id", "if(total = distinct_keys, 'PASS', 'WARNING')"),
            ("clean_orders", "id", "'PASS'"),
            (
                "raw_ads",
                "ad_id, date_start, account_id",
                "if((total - distinct_keys)::DOUBLE / total < 0.01, 'WARNING', 'FAIL')",
            ),
        )
    ),
)
REPEATED = """
SELECT 'Duplicates' AS check_name, '{name}' AS table_name, count(*) AS duplicate_keys,
  ifnull(sum(n - 1), 0)::BIGINT AS extra_rows, if(count(*) = 0, 'PASS', 'WARNING') AS status
FROM (SELECT count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1)
"""
query(
    "unified_duplicates",
    lambda x: quality.unified_duplicates(*x.land("shop", "marketing", shop_columns=["order_id", *unify.DAILY_COLUMNS])),
    REPEATED.format(name="shopify_unified", t="shop", k="order_id")
    + " UNION ALL "
    + REPEATED.format(name="marketing_unified", t="marketing", k="date, channel"),
)
GAP = """
SELECT 'Continuity' AS check_name, '{name}' AS table_name, count(*) AS missing_days, min(d) AS first_missing,
  max(d) AS last_missing, CASE WHEN count(*) = 0 THEN 'none' WHEN max(d) >= DATE '2001-08-01' - 2 THEN 'end' ELSE 'middle' END
    AS gap_position,
  (count(*) * {value})::DOUBLE AS estimated_value,
  CASE WHEN count(*) = 0 THEN 'PASS' WHEN count(*) <= 3 THEN 'WARNING' ELSE 'FAIL' END AS status
FROM (SELECT unnest(generate_series(DATE '2001-07-02', DATE '2001-07-31', INTERVAL 1 DAY))::DATE AS d)
WHERE d NOT IN (SELECT {col}::DATE FROM {t})
"""
query(
    "continuity",
    lambda x: checks.union(
        [
            quality.continuity(x.clean_orders, F.col("created_at").cast("date"), AS_OF, "orders", 90000),
            quality.continuity(x.ads, F.col("date_start"), AS_OF, "facebook", 20000),
            quality.continuity(x.ad_report, F.col("report_date"), AS_OF, "tiktok", 2000),
            quality.continuity(few_orders(x), F.col("created_at").cast("date"), AS_OF, "large_orders", 90000),
        ]
    ),
    " UNION ALL ".join(
        [
            GAP.format(name="orders", value=90000, col="created_at", t="clean_orders"),
            GAP.format(name="facebook", value=20000, col="date_start", t="ads"),
            GAP.format(name="tiktok", value=2000, col="report_date", t="ad_report"),
            GAP.format(
                name="large_orders", value=90000, col="created_at", t="(SELECT * FROM clean_orders WHERE total_price > 440000)"
            ),
        ]
    ),
)


def few_orders(x):
    """Orders of which only very large ones are dated: rare enough to leave days without any."""
    return x.clean_orders.withColumn("created_at", F.when(F.col("total_price") > 440000, F.col("created_at")))


CRITICAL = {
    "orders_clean": ("clean_orders", ["total_price", "created_at", "email_hash"]),
    "customers_clean": ("clean_customers", ["email_hash"]),
    "ads": ("ads", ["spend", "date_start", "ad_id"]),
    "ad_report": ("ad_report", ["spend", "report_date"]),
}
query(
    "critical_nulls",
    lambda x: quality.critical_nulls({n: (getattr(x, attr), fields) for n, (attr, fields) in CRITICAL.items()}),
    "SELECT *, CASE WHEN null_count = 0 THEN 'PASS' WHEN rate_pct < 5 THEN 'WARNING' ELSE 'FAIL' END AS status FROM ("
    + " UNION ALL ".join(
        f"SELECT 'NULLs' AS check_name, '{n}' AS table_name, '{f}' AS field, count(*) AS total_rows, "
        f"count(*) - count({f}) AS null_count, {pct(f'count(*) - count({f})', 'count(*)')} AS rate_pct FROM {t}"
        for n, (t, fields) in CRITICAL.items()
        for f in fields
    )
    + ")",
)


def latest_days(x):
    return checks.union(
        [
            quality.latest_day(x.ads, F.col("date_start"), "facebook"),
            quality.latest_day(x.ad_report, F.col("report_date"), "tiktok"),
            quality.latest_day(x.clean_orders, F.col("created_at").cast("date"), "shopify"),
            quality.latest_day(x.raw_customers, F.col("updated_at").cast("date"), "customers"),
        ]
    )


LATEST = """
(SELECT 'facebook' AS source, max(date_start) AS latest, 20000 AS v FROM ads
  UNION ALL SELECT 'tiktok', max(report_date), 2000 FROM ad_report
  UNION ALL SELECT 'shopify', max(created_at)::DATE, 90000 FROM clean_orders
  UNION ALL SELECT 'customers', max(updated_at)::DATE, 0 FROM raw_customers)
"""
query(
    "freshness_impact",
    lambda x: quality.freshness_impact(latest_days(x), "2001-11-05", quality.DAILY_VALUE),
    f"""
SELECT source, latest, DATE '2001-11-05' - latest AS gap_days, ((DATE '2001-11-05' - latest) * v)::DOUBLE AS missed_value,
  CASE WHEN latest >= DATE '2001-11-04' THEN 'PASS' WHEN latest >= DATE '2001-11-02' THEN 'WARNING' ELSE 'FAIL' END
    AS status
FROM {LATEST}
""",
)
query(
    "freshness_simple",
    lambda x: quality.freshness_simple(latest_days(x), "2001-11-05"),
    f"""
SELECT source, latest, DATE '2001-11-05' - latest AS days_old, CASE WHEN latest >= DATE '2001-11-03' THEN 'Fresh'
  WHEN latest >= DATE '2001-10-29' THEN 'Stale' ELSE 'Old' END AS status FROM {LATEST}
""",
)
query(
    "sync_lag",
    lambda x: quality.sync_lag(x.tables_now, EVENTS_AS_OF),
    f"""
SELECT table_name, row_count, floor(epoch({NOW} - last_extracted_at) / 3600)::BIGINT AS hours_behind,
  CASE WHEN epoch({NOW} - last_extracted_at) < 26 * 3600 THEN 'PASS'
    WHEN epoch({NOW} - last_extracted_at) < 73 * 3600 THEN 'WARNING' ELSE 'FAIL' END AS status FROM tables_now
""",
)
query(
    "volume_bounds",
    lambda x: quality.volume_bounds(x.ads, F.col("date_start"), "ads", 20, 24),
    """
SELECT 'Volume' AS check_name, 'ads' AS table_name, date_start AS date, count(*) AS row_count,
  if(count(*) < 20, 'LOW', 'HIGH') AS status FROM ads GROUP BY date_start HAVING count(*) NOT BETWEEN 20 AND 24
""",
)
query(
    "null_zero_anomalies",
    lambda x: quality.null_zero_anomalies(*x.land("shop", "marketing", shop_columns=unify.DAILY_COLUMNS)),
    f"""
SELECT * FROM (
  SELECT 'shopify_unified' AS table_name, 'order_value' AS field, count(*) AS total_rows,
    count(*) - count(order_value) AS null_count, count(*) FILTER (order_value = 0) AS zero_count,
    {pct('count(*) - count(order_value)', 'count(*)')} AS null_pct FROM shop
  UNION ALL SELECT 'shopify_unified', 'customer_id', count(*), count(*) - count(customer_id), 0,
    {pct('count(*) - count(customer_id)', 'count(*)')} FROM shop
  UNION ALL SELECT 'marketing_unified', f, count(*), count(*) - count(v), count(*) FILTER (v = 0),
    {pct('count(*) - count(v)', 'count(*)')}
    FROM (SELECT unnest(['revenue', 'ad_spend']) AS f, unnest([revenue, ad_spend]) AS v FROM marketing) GROUP BY f)
WHERE null_count > 0 OR zero_count > total_rows * 0.1
""",
)
query(
    "revenue_drop",
    lambda x: quality.revenue_drop(*x.land("marketing"), AS_OF),
    f"""
SELECT date, channel, revenue::DOUBLE AS revenue FROM marketing WHERE date >= {DAY} - 7
  AND revenue::DOUBLE < (SELECT sum(revenue)::DOUBLE / count(*) FROM marketing WHERE date >= {DAY} - 30) / 2
""",
)

# ------------------------------------------------------------------------------- zeros


def impressions_lost(x):
    """Marketing rows whose impressions did not arrive on the first of a month."""
    shown = F.when(F.dayofmonth("date") == 1, F.lit(0)).otherwise(F.col("ad_impressions"))
    return x.marketing.withColumn("ad_impressions", shown)


query(
    "suspicious_zeros",
    lambda x: quality.suspicious_zeros(impressions_lost(x)),
    """
SELECT date, channel, utm_source, revenue::DOUBLE AS revenue, ad_spend::DOUBLE AS ad_spend, ad_clicks,
  CASE WHEN revenue <> 0 THEN 'Normal' WHEN ad_clicks < 10 THEN 'Low traffic - not enough clicks'
    ELSE 'Attribution issue or conversion lag' END AS revenue_zero_explanation,
  if(day(date) = 1, 'Data sync issue - check Airbyte', 'Normal') AS impressions_zero_explanation
FROM marketing WHERE ad_spend > 0 AND (day(date) = 1 OR (revenue = 0 AND ad_spend > 100 AND ad_clicks > 50))
""",
)
query(
    "spend_without_revenue",
    lambda x: quality.spend_without_revenue(x.marketing),
    """
SELECT date, channel, ad_spend::DOUBLE AS ad_spend, revenue::DOUBLE AS revenue, ad_clicks FROM marketing
WHERE revenue = 0 AND ad_spend > 0
""",
)
query(
    "zero_value_orders",
    lambda x: quality.zero_value_orders(x.shop),
    """
SELECT order_id, customer_id, order_subtotal::DOUBLE AS order_subtotal, order_discounts::DOUBLE AS order_discounts,
  t AS is_test_or_draft, d AS is_full_discount, s AS is_free_sample, e AS is_sync_error,
  CASE WHEN t THEN 'Test order' WHEN d THEN '100% discount' WHEN s THEN 'Free sample' WHEN e THEN 'Sync error'
    ELSE 'Unknown' END AS cause
FROM (SELECT *, ifnull(order_tags LIKE '%test%', false) OR ifnull(source_name = 'shopify_draft_order', false) AS t,
  order_discounts >= order_subtotal AS d, ifnull(regexp_matches(product_titles, 'sample|free'), false) AS s,
  order_subtotal > 0 AND order_tags NOT LIKE '%test%' AS e FROM shop WHERE order_value = 0)
""",
)


def fully_refunded(x):
    """Sales net of refunds, so that some days come to nothing."""
    quiet = F.col("ad_spend") < 100000
    return x.marketing.withColumns(
        {
            "ad_spend": F.when(quiet, F.lit(0)).otherwise(F.col("ad_spend")),
            "ad_impressions": F.when(quiet, F.lit(0)).otherwise(F.col("ad_impressions")),
        }
    )


query(
    "idle_days",
    lambda x: quality.idle_days(fully_refunded(x)),
    """
SELECT date, channel, 0::DOUBLE AS ad_spend, 0::DOUBLE AS revenue FROM marketing WHERE revenue = 0 AND ad_spend < 100000
""",
)


def dark_devices(x):
    """Search stats in which tablets were never shown."""
    shown = F.when(F.col("segments_device") == "TABLET", F.lit(0)).otherwise(F.col("metrics_impressions"))
    return conform.ad_unified_google(x.campaign_stats.withColumn("metrics_impressions", shown), x.campaigns)


query(
    "paused_campaigns",
    lambda x: quality.paused_campaigns(dark_devices(x)),
    """
SELECT date, ga_campaign_name, ga_campaign_status, 0 AS ga_impressions, ga_clicks FROM google
WHERE ga_device = 'TABLET' AND ga_campaign_status = 'PAUSED'
""",
)
query(
    "not_synced_yet",
    lambda x: quality.not_synced_yet(x.marketing, AS_OF),
    f"""
SELECT date, channel, ad_impressions, ad_spend::DOUBLE AS ad_spend FROM marketing
WHERE date >= {DAY} - 1 AND ad_impressions = 0
""",
)
query(
    "idle_rows",
    lambda x: checks.union(
        df.agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"))
        for kind, df in (
            ("idle day", quality.idle_days(fully_refunded(x))),
            ("paused campaign", quality.paused_campaigns(dark_devices(x))),
            ("not synced yet", quality.not_synced_yet(x.marketing, AS_OF)),
        )
    ),
    f"""
SELECT 'idle day' AS kind, count(*) AS rows FROM marketing WHERE revenue = 0 AND ad_spend < 100000
UNION ALL SELECT 'paused campaign', count(*) FROM google WHERE ga_device = 'TABLET' AND ga_campaign_status = 'PAUSED'
UNION ALL SELECT 'not synced yet', count(*) FROM marketing WHERE date >= {DAY} - 1 AND ad_impressions = 0
""",
)


def capped_budgets(x):
    """Ads that were not shown on the first of a month."""
    shown = F.when(F.dayofmonth("date") == 1, F.lit(0)).otherwise(F.col("fb_impressions"))
    return x.facebook.withColumn("fb_impressions", shown)


query(
    "budget_exhausted",
    lambda x: quality.budget_exhausted(capped_budgets(x)),
    """
SELECT fb_campaign_name, date, 0 AS fb_impressions, s::DOUBLE AS fb_spend, p::DOUBLE AS prev_day_spend
FROM (SELECT fb_campaign_name, date, sum(fb_spend) AS s,
  lag(sum(fb_spend)) OVER (PARTITION BY fb_campaign_name ORDER BY date) AS p FROM facebook GROUP BY 1, 2)
WHERE day(date) = 1 AND p > 0
""",
)

# -------------------------------------------------------------- keys, sums and formats


def known_customers(x):
    """Customers, one segment of whom have an id that no order knows."""
    lost = F.col("tags") == "MACHINERY"
    return x.clean_customers.withColumn("id", F.when(lost, -F.col("id") - 1).otherwise(F.col("id")))


query(
    "referential_integrity",
    lambda x: quality.referential_integrity(x.clean_orders, "user_id", known_customers(x), "id", "orders"),
    """
SELECT 'Referential Integrity' AS check_name, 'orders' AS table_name, count(DISTINCT user_id) AS orphan_keys,
  count(*) AS orphan_rows, if(count(*) = 0, 'PASS', 'FAIL') AS status
FROM clean_orders WHERE user_id NOT IN (SELECT id FROM clean_customers WHERE tags <> 'MACHINERY')
""",
)
query(
    "sum_validation",
    lambda x: quality.sum_validation(conform.orders_base(x.clean_orders), unify.items_agg(x.line_items)),
    """
SELECT order_id, order_value::DOUBLE AS order_value, items_total_original::DOUBLE AS items_total_original,
  abs(order_value - items_total_original)::DOUBLE / nullif(order_value, 0)::DOUBLE AS diff_ratio
FROM base_orders JOIN items_by_order USING (order_id_numeric)
WHERE if(order_value = 0, items_total_original <> 0,
  abs(order_value - items_total_original)::DOUBLE / order_value::DOUBLE > 0.02)
""",
)
query(
    "format_checks",
    lambda x: quality.format_checks(
        x.clean_orders, "id", "admin_graphql_api_id", F.col("created_at").cast("date").cast("string"), "currency"
    ),
    """
SELECT count(*) AS total_rows, count(DISTINCT currency) AS currencies,
  count(*) FILTER (NOT regexp_full_match(admin_graphql_api_id, 'gid://[a-z]+/Order/[1-9][0-9]*')) AS bad_ids,
  count(*) FILTER (split_part(admin_graphql_api_id, '/', 5) <> id::VARCHAR) AS changed_ids, 0 AS bad_dates,
  if(count(*) FILTER (id = 0) > 0, 'WARNING', 'PASS') AS status FROM clean_orders
""",
)


def order_ids(x):
    return x.utm.select(digits("order_id").alias("order_id_numeric"), "total_price")


def campaign_names(x):
    return x.facebook.select(F.concat(F.lit("c"), "fb_campaign_id").alias("c"))


query(
    "order_totals_agree",
    lambda x: quality.order_totals_agree(conform.orders_base(x.clean_orders), order_ids(x)),
    """
SELECT count(*) AS orders, 0 AS only_in_orders, 0 AS only_in_attribution,
  count(*) FILTER (o.total_price <> u.total_price) AS different_totals
FROM clean_orders o JOIN utm u ON u.numeric_id = o.id
""",
)
query(
    "unmatched_campaigns",
    lambda x: quality.unmatched_campaigns(x.utm, campaign_names(x), "c"),
    """
SELECT first_utm_campaign AS campaign, count(*) AS orders FROM utm
WHERE first_utm_campaign NOT IN ('c0', 'c1', 'c2', 'c3', 'c4') GROUP BY 1
""",
)


def cross_platform(x):
    """Order totals that differ between two tables, and tracked campaigns no ad table knows."""
    totals = quality.order_totals_agree(conform.orders_base(x.clean_orders), order_ids(x))
    names = quality.unmatched_campaigns(x.utm, campaign_names(x), "c")
    return totals.select("different_totals").withColumn("unmatched_campaigns", names.agg(F.count("*")).scalar())


query(
    "cross_platform_consistency",
    cross_platform,
    """
SELECT count(*) FILTER (o.total_price <> u.total_price) AS different_totals,
  count(DISTINCT first_utm_campaign) FILTER (first_utm_campaign NOT IN ('c0', 'c1', 'c2', 'c3', 'c4'))
    AS unmatched_campaigns
FROM clean_orders o JOIN utm u ON u.numeric_id = o.id
""",
)


def workflow_kpis(x):
    """The four figures the workflow is judged by, measured on the tables."""
    fresh = quality.check_freshness(x.web_events, "ts", EVENTS_AS_OF, "e").select(
        F.lit("freshness_hours").alias("kpi"), F.col("hours_since_last").cast("double").alias("value")
    )
    dups = quality.check_duplicates(x.raw_orders, ["id"], "o").select(
        F.lit("duplicates").alias("kpi"), F.col("duplicate_keys").cast("double").alias("value")
    )
    nulls = quality.check_null_rates(x.raw_orders, ["email"], "o").select(
        F.lit("null_pct").alias("kpi"), F.col("max_null_rate").alias("value")
    )
    odd = quality.null_zero_anomalies(*x.land("shop", "marketing", shop_columns=unify.DAILY_COLUMNS)).agg(
        F.lit("anomalies").alias("kpi"), F.count("*").cast("double").alias("value")
    )
    return checks.union([fresh, dups, nulls, odd])


query(
    "workflow_kpi_status",
    lambda x: quality.workflow_kpi_status(workflow_kpis(x)),
    f"""
SELECT kpi, value, CASE WHEN value < a THEN 'OK' WHEN value <= b THEN 'WARNING' ELSE 'CRITICAL' END AS status FROM (
  SELECT 'freshness_hours' AS kpi, floor(epoch({NOW} - max(ts)) / 3600)::DOUBLE AS value, 24 AS a, 48 AS b FROM web_events
  UNION ALL SELECT 'duplicates', count(*)::DOUBLE, 1, 10 FROM (SELECT id FROM raw_orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'null_pct', {pct('count(*) - count(email)', 'count(*)')}, 5, 15 FROM raw_orders
  UNION ALL SELECT 'anomalies', ((SELECT (count(*) FILTER (order_value = 0) > count(*) * 0.1)::INT
      + (count(customer_id) < count(*))::INT FROM shop)
    + (SELECT (count(*) FILTER (revenue = 0) > count(*) * 0.1)::INT
      + (count(*) FILTER (ad_spend = 0) > count(*) * 0.1)::INT FROM marketing))::DOUBLE, 1, 5)
""",
)

# ---------------------------------------------------------------------- reconciliation
RANGE = reconcile.Window(date(2001, 1, 1), date(2001, 8, 1))
KEYS, METRICS = ["account_id", "campaign_id"], ["spend", "impressions", "clicks"]


def api_side(x):
    return reconcile.source_totals(x.api_daily, RANGE, KEYS)


def warehouse_side(x):
    return reconcile.account_stats(x.ads, RANGE, KEYS)


SIDES = f"""
(SELECT account_id, campaign_id, metric, s AS source_value, w AS warehouse_value FROM (
  SELECT account_id, campaign_id, unnest(['spend', 'impressions', 'clicks']) AS metric, unnest([sp, i, c]) AS s
  FROM (SELECT account_id, campaign_id, sum(spend::DECIMAL(18,2))::DOUBLE AS sp, sum(impressions::BIGINT)::DOUBLE AS i,
    sum(ifnull(clicks, '0')::BIGINT)::DOUBLE AS c FROM api_daily WHERE date_start {IN_RANGE} GROUP BY 1, 2))
FULL JOIN (
  SELECT account_id, campaign_id, unnest(['spend', 'impressions', 'clicks']) AS metric, unnest([sp, i, c]) AS w
  FROM (SELECT account_id, campaign_id, sum(spend::DECIMAL(18,2))::DOUBLE AS sp, sum(impressions)::DOUBLE AS i,
    sum(clicks)::DOUBLE AS c FROM ads WHERE date_start {IN_RANGE} GROUP BY 1, 2))
USING (account_id, campaign_id, metric))
"""
COMPARED = f"""
(SELECT *, if(diff_pct <= 2, 'MATCH', 'MISMATCH') AS status FROM (
  SELECT * REPLACE (ifnull(source_value, 0) AS source_value, ifnull(warehouse_value, 0) AS warehouse_value),
  CASE WHEN source_value > 0 THEN abs(source_value - ifnull(warehouse_value, 0)) / source_value * 100
    WHEN ifnull(warehouse_value, 0) = 0 THEN 0 ELSE 100 END AS diff_pct FROM {SIDES}))
"""
query(
    "reconcile",
    lambda x: reconcile.reconcile(api_side(x), warehouse_side(x), KEYS, METRICS),
    f"SELECT * FROM {COMPARED}",
)
query(
    "reconcile_lenient",
    lambda x: reconcile.reconcile_lenient(api_side(x), warehouse_side(x), KEYS, METRICS),
    f"""
SELECT *, CASE WHEN source_value IS NULL OR warehouse_value IS NULL THEN 'SKIP'
  WHEN source_value = 0 THEN if(warehouse_value = 0, 'OK', 'WARN')
  WHEN abs(source_value - warehouse_value) <= source_value * 0.02 THEN 'OK' ELSE 'MISMATCH' END AS status FROM {SIDES}
""",
)
STATS = "sum(spend::DECIMAL(18,2))::DOUBLE AS spend, sum(impressions::BIGINT)::BIGINT AS impressions, sum(clicks::BIGINT)::BIGINT AS clicks"
query(
    "account_stats",
    lambda x: reconcile.account_stats(x.ads, RANGE),
    f"SELECT account_id, {STATS} FROM ads WHERE date_start {IN_RANGE} GROUP BY 1",
)
query(
    "platform_stats",
    lambda x: reconcile.platform_stats(x.ad_report, RANGE),
    f"SELECT {STATS} FROM ad_report WHERE report_date {IN_RANGE}",
)
query(
    "order_stats",
    lambda x: reconcile.order_stats(x.clean_orders, RANGE),
    f"""
SELECT count(*) AS order_count, sum(total_price)::DOUBLE AS revenue FROM clean_orders WHERE created_at::DATE {IN_RANGE}
""",
)
query(
    "source_totals",
    lambda x: reconcile.source_totals(x.api_daily, RANGE),
    f"SELECT account_id, {STATS} FROM api_daily WHERE date_start {IN_RANGE} GROUP BY 1",
)


def with_dormant(x):
    """The comparison beside an account that was quiet in the range: only future days."""
    quiet = x.ads.select(F.concat(F.lit("quiet-"), "account_id").alias("account_id"), "campaign_id").distinct()
    zero = [F.lit(0).cast(k).alias(m) for m, k in (("spend", "decimal(28,2)"), ("impressions", "bigint"), ("clicks", "bigint"))]
    dormant = quiet.select(*KEYS, *zero)
    both = reconcile.reconcile(api_side(x).unionByName(dormant), warehouse_side(x).unionByName(dormant), KEYS, METRICS)
    return reconcile.skip_dormant(both, KEYS)


query(
    "skip_dormant",
    lambda x: with_dormant(x).groupBy("status").agg(F.count("*").alias("comparisons")),
    f"""
SELECT status, count(*) AS comparisons FROM {COMPARED} GROUP BY 1
UNION ALL SELECT 'SKIPPED', count(*) * 3 FROM (SELECT DISTINCT account_id, campaign_id FROM ads)
""",
)
query(
    "scoreboard",
    lambda x: reconcile.scoreboard(with_dormant(x)),
    f"""
SELECT count(*) FILTER (status = 'MATCH') AS matches, count(*) FILTER (status = 'MISMATCH') AS mismatches,
  (SELECT count(*) * 3 FROM (SELECT DISTINCT account_id, campaign_id FROM ads)) AS skipped,
  if(bool_and(status = 'MATCH'), 'MATCH', 'MISMATCH') AS verdict FROM {COMPARED}
""",
)
query(
    "settled_window",
    lambda x: reconcile.order_stats(x.clean_orders, reconcile.settled_window(AS_OF)),
    f"""
SELECT count(*) AS order_count, sum(total_price)::DOUBLE AS revenue FROM clean_orders
WHERE created_at::DATE BETWEEN {DAY} - 16 AND {DAY} - 2
""",
)


def renumbered(orders, limit, *others):
    """Ids of all orders; those up to a price came under another id."""
    return orders.select(F.when(F.col("total_price") > limit, F.col("id")).otherwise(-F.col("id") - 1).alias("id"), *others)


query(
    "missing_records",
    lambda x: reconcile.missing_records(
        renumbered(x.order_history, 1000),
        renumbered(x.clean_orders, 2000),
        ["id"],
    ),
    """
SELECT coalesce(a.id, b.id) AS id, if(b.id IS NULL, 'missing in warehouse', 'missing in source') AS side
FROM (SELECT if(total_price > 1000, id, -id - 1) AS id FROM order_history) a FULL JOIN
  (SELECT if(total_price > 2000, id, -id - 1) AS id FROM clean_orders) b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL
""",
)
def in_parts(x, source, warehouse, keys, buckets, day=None, columns=None):
    """Both sides stored in parts with digests, as a nightly job leaves them."""
    paths = [fresh_folder(x.spark, side) for side in ("source-parts", "warehouse-parts")]
    for df, path in zip((source, warehouse), paths):
        digests.store_parts(df, path, keys, buckets, day, columns)
    return paths


def missing_by_digest(x):
    source, warehouse = (
        df.select("*", F.trunc("created_at", "year").alias("year"))
        for df in (
            renumbered(x.order_history, 1000, "created_at"),
            renumbered(x.clean_orders, 2000, "created_at"),
        )
    )
    paths = in_parts(x, source, warehouse, ["id"], 4, F.col("year"), ["id"])
    return digests.missing_stored(*paths, ["id"], source)


def repriced(x):
    """Orders, and the same orders where the dearest came under another price and the cheapest under another id."""
    price = F.col("total_price")
    source = x.clean_orders.select("id", "total_price")
    warehouse = source.select(
        F.when(price > 1500, F.col("id")).otherwise(-F.col("id") - 1).alias("id"),
        F.when(price < 300000, price).otherwise(price - 1).cast(source.schema["total_price"].dataType).alias("total_price"),
    )
    return digests.changed_stored(*in_parts(x, source, warehouse, ["id"], 16), ["id"], source)


def count_changes(x):
    source, warehouse = (df.select("campaign_id") for df in (x.raw_ads, x.ads))
    paths = in_parts(x, source, warehouse, ["campaign_id"], 16)
    return digests.count_changes(*paths, ["campaign_id"], source)


query(
    "missing_records_stored",
    missing_by_digest,
    """
SELECT coalesce(a.id, b.id) AS id, if(b.id IS NULL, 'missing in warehouse', 'missing in source') AS side
FROM (SELECT if(total_price > 1000, id, -id - 1) AS id FROM order_history) a FULL JOIN
  (SELECT if(total_price > 2000, id, -id - 1) AS id FROM clean_orders) b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL
""",
)
query(
    "changed_records_stored",
    repriced,
    """
SELECT id, 'changed' AS status FROM clean_orders WHERE total_price >= 300000
UNION ALL SELECT id, 'missing in warehouse' FROM clean_orders WHERE ifnull(total_price <= 1500, true)
UNION ALL SELECT -id - 1, 'missing in source' FROM clean_orders WHERE ifnull(total_price <= 1500, true)
""",
)
query(
    "record_count_changes",
    count_changes,
    """
SELECT campaign_id, 'rows' AS metric, s::DOUBLE AS source_value, w::DOUBLE AS warehouse_value, (s - w)::DOUBLE / s * 100
  AS diff_pct, CASE WHEN s - w > s * 0.05 THEN 'CRITICAL' WHEN s - w > s * 0.01 THEN 'WARNING' ELSE 'PASS' END AS status
FROM (SELECT campaign_id, count(*) AS s FROM raw_ads GROUP BY 1) JOIN
  (SELECT campaign_id, count(*) AS w FROM ads GROUP BY 1) USING (campaign_id) WHERE s <> w
""",
)
query(
    "expected_members",
    lambda x: reconcile.expected_members(
        x.ads.withColumn("account_id", F.when(F.col("country") == "NATION_1", F.col("account_id"))),
        "account_id",
        x.ads.select("account_id").distinct(),
    ),
    "SELECT account_id FROM ads EXCEPT SELECT account_id FROM ads WHERE country = 'NATION_1'",
)
query(
    "record_count_diff",
    lambda x: reconcile.record_count_diff(x.raw_ads, x.ads, ["campaign_id"]),
    """
SELECT campaign_id, 'rows' AS metric, s::DOUBLE AS source_value, w::DOUBLE AS warehouse_value, (s - w)::DOUBLE / s * 100
  AS diff_pct, CASE WHEN s - w > s * 0.05 THEN 'CRITICAL' WHEN s - w > s * 0.01 THEN 'WARNING' ELSE 'PASS' END AS status
FROM (SELECT campaign_id, count(*) AS s FROM raw_ads GROUP BY 1) JOIN
  (SELECT campaign_id, count(*) AS w FROM ads GROUP BY 1) USING (campaign_id)
""",
)
query(
    "spend_diff",
    lambda x: reconcile.banded(reconcile.compare(api_side(x), warehouse_side(x), KEYS, ["spend"]), 1.0, 5.0),
    f"""
SELECT * REPLACE (CASE WHEN diff_pct > 5 THEN 'CRITICAL' WHEN diff_pct > 1 THEN 'WARNING' ELSE 'PASS' END AS status)
FROM {COMPARED} WHERE metric = 'spend'
""",
)

# -------------------------------------------------------------------------- monitoring


def stored_baseline(x):
    """Two scans, the earlier one stored last: the later scan is the baseline."""
    folder = fresh_folder(x.spark, "baseline")
    monitor.baseline_snapshot(x.tables_baseline, BASELINE_AS_OF, folder)
    return monitor.baseline_snapshot(x.tables_now, "2024-01-08 00:00:00", folder)


query(
    "baseline_snapshot",
    lambda x: stored_baseline(x),
    "SELECT table_name, row_count, created_at, TIMESTAMP '2024-01-15' AS scanned_at FROM tables_baseline",
)
query(
    "new_tables",
    lambda x: monitor.new_tables(x.tables_now, x.tables_baseline),
    """
SELECT table_name, row_count, created_at, if(row_count = 0, 'NEW & EMPTY', 'NEW TABLE') AS status FROM tables_now
WHERE table_name NOT IN (SELECT table_name FROM tables_baseline)
""",
)
query(
    "deleted_tables",
    lambda x: monitor.deleted_tables(x.tables_now, x.tables_baseline),
    """
SELECT table_name, row_count AS rows_before, 'DELETED' AS status FROM tables_baseline
WHERE table_name NOT IN (SELECT table_name FROM tables_now)
""",
)
query(
    "empty_tables",
    lambda x: monitor.empty_tables(x.tables_now, x.tables_baseline),
    """
SELECT n.table_name, last_extracted_at, ifnull(b.row_count, 0) AS rows_before,
  if(b.row_count = 0, 'STILL EMPTY', 'NEWLY EMPTY') AS status
FROM tables_now n LEFT JOIN tables_baseline b USING (table_name) WHERE n.row_count = 0
""",
)


def stored_pair(x):
    """The given orders, and a table of those without a key, of which there are none."""
    path = fresh_folder(x.spark, "refused")
    x.table("orders").filter(F.col("o_orderkey").isNull()).write.parquet(path)
    return {"orders": f"{x.sf_dir}/orders.parquet", "refused": path}


query(
    "empty_tables_from_footers",
    lambda x: monitor.empty_tables(
        tables.footer_counts(x.spark, stored_pair(x)).withColumn("last_extracted_at", F.lit(None).cast("timestamp")),
        tables.footer_session(x.spark).createDataFrame([("orders", 5), ("refused", 5)], "table_name string, row_count long"),
    ).drop("last_extracted_at"),
    "SELECT 'refused' AS table_name, 5::BIGINT AS rows_before, 'NEWLY EMPTY' AS status FROM (SELECT count(*) FROM orders)",
)
query(
    "stale_tables",
    lambda x: monitor.stale_tables(x.tables_now, EVENTS_AS_OF),
    f"""
SELECT table_name, last_extracted_at, floor(epoch({NOW} - last_extracted_at)) / 3600 AS hours_ago, 'STALE' AS status
FROM tables_now WHERE floor(epoch({NOW} - last_extracted_at)) > 48 * 3600
""",
)
query(
    "missing_expected",
    lambda x: monitor.missing_expected(x.tables_now, x.tables_baseline.select("table_name")),
    "SELECT table_name FROM tables_baseline EXCEPT SELECT table_name FROM tables_now",
)


def syncs(x):
    return monitor.last_sync(
        {
            "Events": (x.web_events, "ts"),
            "Jobs": (x.attempts.filter(F.col("status") == "succeeded"), "created_at"),
            "Orders": (x.raw_orders, "extracted_at"),
        }
    )


SYNCS = """
(SELECT 'Events' AS source, max(ts) AS last_sync FROM web_events
  UNION ALL SELECT 'Jobs', max(created_at) FROM attempts WHERE status = 'succeeded'
  UNION ALL SELECT 'Orders', max(extracted_at) FROM raw_orders)
"""
query(
    "sync_status",
    lambda x: monitor.sync_status(syncs(x), EVENTS_AS_OF),
    f"""
SELECT source, last_sync, h AS hours_ago, CASE WHEN h < 2 THEN 'OK' WHEN h < 24 THEN 'WARNING' ELSE 'STALE' END AS status
FROM (SELECT *, floor(epoch({NOW} - last_sync)) / 3600 AS h FROM {SYNCS})
""",
)
query(
    "load_freshness",
    lambda x: monitor.load_freshness(syncs(x), EVENTS_AS_OF),
    f"""
SELECT source, last_sync, floor(epoch({NOW} - last_sync) / 3600)::BIGINT AS hours_since,
  if(floor(epoch({NOW} - last_sync) / 3600) > 48, 'WARNING', 'OK') AS status FROM {SYNCS}
""",
)


def watched(x):
    return x.tables_now.withColumn("source", F.regexp_extract("table_name", r"^([a-z_]+)_\d", 1))


VALUES = {"purchase": 90000, "page_view": 20000}
ALERTS = f"""
(SELECT table_name, h AS hours_behind, h // 24 AS days_behind, if(h >= 48, h // 24 * v, 0) AS missed_value,
  if(h >= 48, 'CRITICAL', 'WARNING') AS level
FROM (SELECT table_name, floor(epoch({NOW} - last_extracted_at) / 3600)::BIGINT AS h,
  CASE WHEN table_name LIKE 'purchase%' THEN 90000 WHEN table_name LIKE 'page_view%' THEN 20000 ELSE 0 END AS v
  FROM tables_now) WHERE h >= 30)
"""
query(
    "watchdog_alerts",
    lambda x: monitor.watchdog_alerts(watched(x), EVENTS_AS_OF, VALUES),
    f"SELECT * FROM {ALERTS}",
)


def alert_history(x):
    """Alert batches sent so far: one an hour before, naming every table but the newest events' own."""
    alerts = monitor.watchdog_alerts(watched(x), EVENTS_AS_OF, VALUES)
    return alerts.filter("level = 'CRITICAL'").select(
        as_timestamp("2024-01-30 23:00:00").alias("alerted_at"), "table_name"
    )


query(
    "suppress_repeat_alerts",
    lambda x: monitor.suppress_repeat_alerts(
        monitor.watchdog_alerts(watched(x), EVENTS_AS_OF, VALUES), alert_history(x), EVENTS_AS_OF
    ),
    f"SELECT * FROM {ALERTS} WHERE EXISTS (SELECT 1 FROM {ALERTS} WHERE level = 'WARNING')",
)
query(
    "job_history",
    lambda x: monitor.job_history(x.sync_jobs, x.attempts),
    """
SELECT job_id, j.connection, j.created_at, count(*) AS attempts, arg_max(status, attempt_no) AS last_status,
  arg_max(job_id * 3 + attempt_no, attempt_no) % 600 + 1 AS duration_seconds, arg_max(records, attempt_no) AS records_synced
FROM sync_jobs j JOIN (SELECT job_id, attempt_no, status, records FROM attempts) a USING (job_id)
GROUP BY job_id, j.connection, j.created_at
""",
)
query(
    "stream_stats",
    lambda x: monitor.stream_stats(x.attempts),
    """
SELECT job_id, attempt_no, unnest(['orders', 'customers']) AS stream_name, unnest([k * 10, k]) AS emitted,
  unnest([k * 10, k - 1]) AS committed FROM attempts
""",
)
query(
    "schedule_health",
    lambda x: monitor.schedule_health(x.attempts, EVENTS_AS_OF),
    f"""
SELECT unnest(['frequency', 'errors', 'recency']) AS check, unnest([n, e, m]) AS observed,
  unnest([CASE WHEN n >= 10 THEN 'PASS' WHEN n >= 5 THEN 'WARNING' ELSE 'FAIL' END, if(e = 0, 'PASS', 'FAIL'),
    if(m <= 10, 'PASS', 'FAIL')]) AS status
FROM (SELECT count(*) AS n, count(*) FILTER (status = 'failed') AS e,
  floor(epoch({NOW} - max(created_at)) / 60)::BIGINT AS m FROM attempts WHERE created_at > {NOW} - INTERVAL 1 HOUR)
""",
)

# ----------------------------------------------------------------------------- streams


def stream_of(x, table):
    return streams.read_stream(x.spark, f"{x.sf_dir}/{table}.parquet", x.table(table).schema)


query(
    "stream_hash_pii",
    lambda x: streams.append_stream(
        streams.hash_on_arrival(x.customers_from(stream_of(x, "customer")), ["email"]), fresh_folder(x.spark, "hashed")
    ).select("id", "extracted_at", "email", "email_hash"),
    """
SELECT id, extracted_at, if(email_hash IS NULL, email, NULL) AS email, email_hash FROM hashed_customers
""",
)
query(
    "stream_dedup",
    lambda x: streams.first_wins(
        x.shape_ads_json(stream_of(x, "lineitem")),
        fresh_folder(x.spark, "first"),
        ["ad_id", "stat_time_day"],
        "stat_time_day",
        ["extract_no", "tie1", "tie2", "tie3", "tie4"],
    ).select("ad_id", "stat_time_day", "extract_no", "tie1", "tie2", "tie3", "tie4"),
    """
SELECT ad_id, stat_time_day, extract_no, tie1, tie2, tie3, tie4::DOUBLE AS tie4 FROM (SELECT *, row_number() OVER (
  PARTITION BY ad_id, stat_time_day ORDER BY extract_no, tie1, tie2, tie3, tie4) AS n FROM raw_ads_json) WHERE n = 1
""",
)
query(
    "stream_upsert_latest",
    lambda x: streams.latest_wins(
        x.shape_ads_json(stream_of(x, "lineitem")),
        fresh_folder(x.spark, "latest"),
        ["ad_id", F.col("stat_time_day").cast("date")],
        ["extract_no"],
        ["tie1", "tie2", "tie3", "tie4"],
    ).select("ad_id", "stat_time_day", "extract_no", "tie1", "tie2", "tie3", "tie4"),
    """
SELECT ad_id, stat_time_day, extract_no, tie1, tie2, tie3, tie4::DOUBLE AS tie4 FROM ads_latest_json
""",
)
query(
    "stream_hourly_ads",
    lambda x: streams.hourly_ads(x.shape_ads_json(stream_of(x, "lineitem")), fresh_folder(x.spark, "hourly")),
    """
SELECT date_trunc('hour', stat_time_day) AS hour, sum((metrics ->> '$.spend')::DECIMAL(18,2))::DOUBLE AS spend,
  sum((metrics ->> '$.impressions')::BIGINT)::BIGINT AS impressions, sum((metrics ->> '$.clicks')::BIGINT)::BIGINT AS clicks
FROM raw_ads_json GROUP BY 1
""",
)
query(
    "stream_event_funnel",
    lambda x: streams.event_funnel(x.shape_events(stream_of(x, "events")), fresh_folder(x.spark, "funnel")),
    """
SELECT date_trunc('hour', ts) AS window_start, event_name, count(*) AS event_count,
  count(DISTINCT user_pseudo_id) AS users FROM web_events
WHERE event_name IN ('page_view', 'view_item', 'add_to_cart', 'purchase') GROUP BY 1, 2
""",
)


def sketched(x):
    """Funnel by sketches, and whether each estimate lies within four standard errors of the exact count of users."""
    web = x.shape_events(x.table("events"))
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")
    exact = web.groupBy(hour, "event_name").agg(F.count_distinct("user_pseudo_id").alias("exact"))
    found = streams.event_funnel_sketch(x.shape_events(stream_of(x, "events")), fresh_folder(x.spark, "sketch"))
    error = 4 * 1.04 / 2 ** (streams.SKETCH_LG / 2)
    near = F.abs(F.col("users") - F.col("exact")) <= F.greatest(F.lit(0.5), error * F.col("exact"))
    joined = found.alias("s").join(exact.alias("e"), (F.col("s.window_start") == F.col("e.window_start")) & (F.col("s.event_name") == F.col("e.event_name")))
    return joined.select("s.window_start", "s.event_name", "event_count", near.alias("users_near"))


query(
    "stream_funnel_sketch",
    sketched,
    """
SELECT date_trunc('hour', ts) AS window_start, event_name, count(*) AS event_count, true AS users_near FROM web_events
WHERE event_name IN ('page_view', 'view_item', 'add_to_cart', 'purchase') GROUP BY 1, 2
""",
)
query(
    "stream_freshness",
    lambda x: streams.source_freshness(
        x.shape_events(stream_of(x, "events")), fresh_folder(x.spark, "freshness"), "event_name", "ts", EVENTS_AS_OF
    ),
    f"""
SELECT event_name AS source, max(ts) AS last_sync, floor(epoch({NOW} - max(ts))) / 3600 AS hours_ago,
  CASE WHEN floor(epoch({NOW} - max(ts))) < 2 * 3600 THEN 'OK' WHEN floor(epoch({NOW} - max(ts))) < 86400 THEN 'WARNING'
    ELSE 'STALE' END AS status FROM web_events GROUP BY 1
""",
)
query(
    "incremental_append",
    lambda x: streams.append_stream(x.shape_events(stream_of(x, "events")), fresh_folder(x.spark, "append")),
    "SELECT * FROM web_events",
)
