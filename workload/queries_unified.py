"""Joins and unification, attribution, row changes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from martlet.functions import query_param
from martlet.operators import attribution, changes, conform, unify
from martlet.plans import marketing as reports
from martlet.plans import refresh
from workload.inputs import AS_OF
from workload.registry import fresh_folder, query

# ---------------------------------------------------------------- children per order
query(
    "items_agg",
    lambda x: unify.items_agg(x.line_items),
    "SELECT * REPLACE (items_total_original::DOUBLE AS items_total_original) FROM items_by_order",
)
query("items_agg_all", lambda x: unify.items_agg_all(x.line_items), "SELECT * FROM items_all")
query(
    "transactions_agg",
    lambda x: unify.transactions_agg(x.transactions),
    """
SELECT * EXCLUDE (transaction_types) REPLACE (transactions_total_amount::DOUBLE AS transactions_total_amount)
FROM transactions_by_order
""",
)
query(
    "transactions_agg_kinds",
    lambda x: unify.transactions_agg(x.transactions, kinds=True),
    """
SELECT order_id_numeric, transaction_count, transaction_types, payment_gateways, transaction_statuses
FROM transactions_by_order
""",
)
query("utm_attribution", lambda x: unify.utm_attribution(x.utm), "SELECT * FROM utm_by_order")
query(
    "refunds_agg",
    lambda x: unify.refunds_agg(x.refunds),
    "SELECT * REPLACE (refunds_total_amount::DOUBLE AS refunds_total_amount) FROM refunds_by_order",
)

# --------------------------------------------------------------------- unified tables
SHOP_MONEY = ", ".join(
    f"{c}::DOUBLE AS {c}"
    for c in (
        "order_value",
        "order_subtotal",
        "order_discounts",
        "order_tax",
        "customer_lifetime_value_shopify",
        "items_total_original",
        "transactions_total_amount",
        "refunds_total_amount",
        "order_net_value",
    )
)
query("shopify_unified", lambda x: x.shop, f"SELECT * REPLACE ({SHOP_MONEY}) FROM shop")


def stored_shop(x):
    """The unified orders over tables in buckets of the order id."""
    parts = x.shop_parts()
    customers = parts.pop("customers")
    buckets = int(x.spark.conf.get("spark.sql.shuffle.partitions"))
    stored = unify.store_order_tables(**parts, prefix=f"shop_{uuid.uuid4().hex}", buckets=buckets)
    return unify.shopify_unified_stored(stored, customers)


query("shopify_unified_stored", stored_shop, f"SELECT * REPLACE ({SHOP_MONEY}) FROM shop")
query(
    "shopify_unified_one_customer",
    lambda x: unify.shopify_unified(**x.shop_parts(), customer_match="latest"),
    f"""
SELECT * REPLACE ({SHOP_MONEY}) FROM shop
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id DESC) = 1
""",
)
CONSISTENT_MONEY = ", ".join(
    f"{c}::DOUBLE AS {c}"
    for c in (
        "order_value",
        "order_subtotal",
        "order_discounts",
        "order_tax",
        "customer_total_spent",
        "refunds_total_amount",
        "net_revenue",
    )
)
query(
    "shopify_unified_consistent",
    lambda x: x.shop_consistent,
    f"SELECT * REPLACE ({CONSISTENT_MONEY}) FROM shop_consistent",
)
query("daily_ad_spend", lambda x: x.ad_spend, "SELECT * REPLACE (spend::DOUBLE AS spend) FROM ad_days")
query(
    "daily_ad_spend_all_platforms",
    lambda x: unify.daily_ad_spend(
        {"facebook": (x.facebook, "fb_"), "tiktok": (x.tiktok, "tt_"), "amazon": (x.amazon, "amz_")}
    ),
    """
SELECT date, ad_source, spend::DOUBLE AS spend, impressions, clicks, NULL::DOUBLE AS revenue FROM ad_days
UNION ALL SELECT date, 'amazon', sum(amz_spend)::DOUBLE, sum(amz_impressions)::BIGINT, sum(amz_clicks)::BIGINT,
  sum(amz_sales)::DOUBLE FROM amazon GROUP BY 1
""",
)
query(
    "shopify_daily",
    lambda x: x.shop_daily,
    "SELECT * REPLACE (revenue::DOUBLE AS revenue, net_revenue::DOUBLE AS net_revenue) FROM shop_days",
)
MARKETING_MONEY = "revenue::DOUBLE AS revenue, net_revenue::DOUBLE AS net_revenue, ad_spend::DOUBLE AS ad_spend"
query("marketing_unified", lambda x: x.marketing, f"SELECT * REPLACE ({MARKETING_MONEY}) FROM marketing")


def renewed_marketing(x):
    """The kept table as of a run that saw other prices for orders without a source, brought up to date by the days of these orders."""
    (shop,) = x.land("shop", shop_columns=unify.DAILY_COLUMNS)
    ads = {"facebook": (x.facebook, "fb_"), "tiktok": (x.tiktok, "tt_")}
    path = fresh_folder(x.spark, "marketing-days")
    late = F.col("first_utm_source").isNull() & (F.col("order_date") >= F.lit("1998-01-01").cast("date"))
    before = shop.withColumn("order_value", F.when(~F.coalesce(late, F.lit(False)), F.col("order_value")))
    refresh.refresh_marketing(x.spark, path, before, ads)
    return refresh.refresh_marketing(x.spark, path, shop, ads, refresh.changed_days(shop.filter(late)))


query("marketing_renewed_by_day", renewed_marketing, f"SELECT * REPLACE ({MARKETING_MONEY}) FROM marketing")
query("monthly_from_renewed_days", lambda x: reports.monthly_performance(renewed_marketing(x)), "SELECT * FROM monthly")
query(
    "marketing_unified_once",
    lambda x: unify.marketing_unified(unify.shopify_daily(x.shop, by_source=False), x.ad_spend).select(
        "date", "channel", "orders", "revenue", "ad_spend"
    ),
    """
SELECT coalesce(s.date, a.date) AS date, coalesce(ch, ad_source) AS channel, coalesce(orders, 0) AS orders,
  coalesce(revenue, 0)::DOUBLE AS revenue, coalesce(spend, 0)::DOUBLE AS ad_spend
FROM (SELECT date, lower(attribution_channel) AS ch, sum(orders)::BIGINT AS orders, sum(revenue) AS revenue
  FROM shop_days GROUP BY 1, 2) s
FULL JOIN ad_days a ON a.date = s.date AND a.ad_source = ch
""",
)

# ------------------------------------------------------------------------- other joins
query(
    "order_gross_margin",
    lambda x: unify.order_gross_margin(conform.orders_base(x.clean_orders), x.line_items, x.inventory),
    """
SELECT o.order_id, o.order_value::DOUBLE AS order_value, sum(p.cost * i.quantity)::DOUBLE AS total_cost,
  (o.order_value - sum(p.cost * i.quantity))::DOUBLE AS gross_margin
FROM base_orders o JOIN line_items i ON i.numeric_id = o.order_id JOIN products p USING (product_id)
GROUP BY o.order_id, o.order_value
""",
)
query(
    "orders_with_customers",
    lambda x: unify.orders_with_customers(x.raw_orders, x.raw_customers),
    """
SELECT o.id AS order_id, o.name AS order_name, o.total_price::DOUBLE AS total_price, c.id AS customer_id,
  c.orders_count, c.total_spent::DOUBLE AS total_spent, o.email_hash
FROM hashed_orders o JOIN hashed_customers c USING (email_hash)
ORDER BY o.id, o.extracted_at, c.id, c.extracted_at LIMIT 10
""",
)
query(
    "customer_ltv",
    lambda x: unify.customer_ltv(x.raw_orders, x.raw_customers),
    """
SELECT o.email_hash, count(DISTINCT o.id) AS orders, sum(o.total_price)::DOUBLE AS order_total,
  max(c.total_spent)::DOUBLE AS customer_ltv, max(c.orders_count) AS customer_orders_count
FROM hashed_orders o LEFT JOIN hashed_customers c USING (email_hash) WHERE o.email_hash IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
)
query(
    "attribution_by_date_join",
    lambda x: unify.attribution_by_date_join(x.utm, x.ads),
    """
SELECT order_date, first_utm_source, count(*) AS orders, sum(total_price)::DOUBLE AS revenue,
  sum(spend::DECIMAL(18,2))::DOUBLE AS ad_spend,
  sum(total_price)::DOUBLE / nullif(sum(spend::DECIMAL(18,2))::DOUBLE, 0) AS roas
FROM (SELECT created_at::DATE AS order_date, first_utm_source, total_price FROM utm
  WHERE first_utm_source LIKE '%facebook%') LEFT JOIN (SELECT date_start, spend FROM ads) ON date_start = order_date
GROUP BY 1, 2
""",
)
query(
    "platform_spend_by_day",
    lambda x: unify.platform_spend_by_day(x.facebook, x.tiktok),
    """
SELECT date, sum(spend) FILTER (ad_source = 'facebook')::DOUBLE AS facebook_spend,
  sum(spend) FILTER (ad_source = 'tiktok')::DOUBLE AS tiktok_spend FROM ad_days GROUP BY 1
""",
)


def tracked_only(x):
    """Marketing table in which only tracked orders have a value: days without a tracked sale show no revenue."""
    tracked = F.coalesce(F.col("first_utm_source") == "google", F.lit(False))
    values = {c: F.when(tracked, F.col(c)).otherwise(F.lit(0)).cast(x.shop.schema[c].dataType) for c in ("order_value", "order_net_value")}
    return unify.marketing_unified(unify.shopify_daily(x.shop.withColumns(values)), x.ad_spend)


query(
    "unattributed_revenue",
    lambda x: unify.unattributed_revenue(*x.land("shop", shop_columns=unify.DAILY_COLUMNS), tracked_only(x), AS_OF, days=60),
    """
SELECT order_date AS date, sum(order_value)::DOUBLE AS total_shopify_revenue,
  0::DOUBLE AS total_marketing_revenue,
  sum(order_value)::DOUBLE AS unattributed_revenue
FROM shop WHERE order_date >= DATE '2001-08-01' - 60 GROUP BY 1
HAVING sum(order_value) > 0 AND ifnull(sum(order_value) FILTER (first_utm_source = 'google'), 0) = 0
""",
)
query(
    "zero_spend_customers_with_orders",
    lambda x: unify.zero_spend_customers_with_orders(x.clean_customers, x.clean_orders),
    """
SELECT c.id AS customer_id, c.total_spent::DOUBLE AS shopify_total_spent, count(o.id) AS actual_order_count,
  sum(o.total_price)::DOUBLE AS calculated_total_spent
FROM clean_customers c LEFT JOIN clean_orders o USING (email_hash) WHERE c.total_spent = 0
GROUP BY 1, 2 HAVING count(o.id) > 0
""",
)
query(
    "zero_spend_share",
    lambda x: unify.zero_spend_share(x.clean_customers),
    """
SELECT count(*) FILTER (total_spent = 0) AS customers_with_zero, avg((total_spent = 0)::INT) * 100 AS percentage
FROM clean_customers
""",
)
query(
    "email_match_status",
    lambda x: unify.email_match_status(x.shop_consistent),
    """
SELECT order_id, order_email_hash, customer_email_hash,
  CASE (order_email_hash IS NULL)::INT + (customer_email_hash IS NULL)::INT WHEN 2 THEN 'Both NULL'
    WHEN 1 THEN 'Partial NULL' ELSE if(order_email_hash = customer_email_hash, 'Match', 'Mismatch') END AS match_status
FROM shop_consistent
""",
)
query(
    "email_mismatch_by_customer",
    lambda x: unify.email_mismatch_by_customer(x.clean_orders, shifted(x)),
    """
SELECT o.id AS order_id, o.email_hash AS order_email, c.email_hash AS customer_email, 'MISMATCH' AS status
FROM clean_orders o JOIN clean_customers c ON c.id = o.user_id + 1 WHERE o.email_hash <> c.email_hash
""",
)


def shifted(x):
    """Customer records whose ids have slipped by one."""
    return x.clean_customers.withColumn("id", F.col("id") - 1)


query(
    "date_spine_gaps",
    lambda x: unify.date_spine_gaps(
        conform.orders_base(x.clean_orders),
        F.when(F.col("source_name") == "tiktok", F.col("order_date")),
        "2000-08-01",
        AS_OF,
    ),
    """
SELECT unnest(generate_series(DATE '2000-08-01', DATE '2001-08-01', INTERVAL 1 DAY))::DATE AS date
EXCEPT SELECT order_date FROM base_orders WHERE source_name = 'tiktok'
""",
)
query(
    "yoy_self_join",
    lambda x: unify.year_over_year(
        x.clean_orders.groupBy(F.trunc("created_at", "MM").alias("month")).agg(F.sum("total_price").alias("revenue")),
        "month",
        ["revenue"],
    ),
    """
SELECT month, revenue, max(revenue) OVER (ORDER BY month RANGE BETWEEN INTERVAL 1 YEAR PRECEDING AND
  INTERVAL 1 YEAR PRECEDING) AS ly_revenue
FROM (SELECT date_trunc('month', created_at)::DATE AS month, sum(total_price)::DOUBLE AS revenue FROM clean_orders
  GROUP BY 1)
""",
)

# ------------------------------------------------------------------------- attribution
query(
    "attribution_status",
    lambda x: attribution.classify(x.utm).select("order_id", "attribution_status"),
    """
SELECT order_id, CASE WHEN first_utm_source IS NOT NULL THEN 'HAS_UTM'
  ELSE coalesce(map {'amazon-us': 'AMAZON_NO_TRACKING', 'amazon': 'AMAZON_NO_TRACKING',
    'shopify_draft_order': 'MANUAL_ORDER', 'tiktok': 'TIKTOK_SHOP'}[sales_channel],
    if(first_landing_page IS NULL, 'UNKNOWN_CHANNEL', 'DIRECT_OR_ORGANIC')) END AS attribution_status
FROM utm
""",
)
query(
    "reclassify_unknown_channels",
    lambda x: attribution.reclassify_unknown_channels(x.utm).select("order_id", "sales_channel", "attribution_status"),
    """
SELECT order_id, sales_channel, CASE WHEN attribution_status <> 'UNKNOWN_CHANNEL' OR sales_channel IS NULL
    THEN attribution_status
  WHEN sales_channel IN ('web', 'online_store') THEN if(first_utm_source IS NULL, 'DIRECT_OR_ORGANIC', 'HAS_UTM')
  ELSE coalesce(map {'amazon-us': 'AMAZON_NO_TRACKING', 'amazon': 'AMAZON_NO_TRACKING',
    'amazon-ca': 'AMAZON_NO_TRACKING', 'amazon-uk': 'AMAZON_NO_TRACKING', 'tiktok': 'TIKTOK_SHOP', 'shop': 'SHOP_APP',
    'shopify_draft_order': 'MANUAL_ORDER', 'pos': 'POS_ORDER', 'point_of_sale': 'POS_ORDER'}[sales_channel],
    'OTHER_CHANNEL') END AS attribution_status
FROM utm
""",
)


def extract(x):
    return x.utm.filter(F.col("sales_channel").isNotNull()).select(
        "order_id", F.col("sales_channel").alias("channel_handle")
    )


query(
    "reclassify_from_extract",
    lambda x: attribution.reclassify_from_extract(
        x.utm.withColumn("sales_channel", F.lit(None).cast("string")), extract(x)
    ).select("order_id", "sales_channel", "attribution_status"),
    """
SELECT order_id, CASE WHEN attribution_status = 'UNKNOWN_CHANNEL' THEN sales_channel END AS sales_channel,
  CASE WHEN attribution_status <> 'UNKNOWN_CHANNEL' OR sales_channel IS NULL THEN attribution_status
    WHEN sales_channel = 'amazon-us' THEN 'AMAZON_NO_TRACKING' WHEN sales_channel = 'tiktok' THEN 'TIKTOK_SHOP'
    WHEN sales_channel = 'shopify_draft_order' THEN 'MANUAL_ORDER'
    WHEN sales_channel <> 'web' OR coalesce(first_landing_page, first_utm_source) IS NULL THEN 'OTHER_CHANNEL'
    WHEN first_landing_page IS NULL THEN 'HAS_UTM' ELSE 'DIRECT_OR_ORGANIC' END AS attribution_status
FROM utm
""",
)
query(
    "infer_channel_by_price",
    lambda x: attribution.infer_channel_by_price(whole_hundreds(x)).select(
        "order_id", "total_price", "sales_channel", "attribution_status"
    ),
    """
SELECT order_id, p::DOUBLE AS total_price, if(hit, 'amazon-us (inferred)', sales_channel) AS sales_channel,
  if(hit, 'AMAZON_NO_TRACKING', attribution_status) AS attribution_status
FROM (SELECT *, coalesce(sales_channel, first_utm_source, first_landing_page) IS NULL
    AND list_contains([96, 109, 121, 138, 139, 140, 149], p) AS hit
  FROM (SELECT *, (90 + floor(total_price) % 60)::DECIMAL(18,2) AS p FROM utm))
""",
)


def whole_hundreds(x):
    """Orders at retail prices between 90 and 149, the range in which marketplace prices lie."""
    return x.utm.withColumn("total_price", (F.lit(90) + F.floor("total_price") % 60).cast("decimal(18,2)"))


# ------------------------------------------------------------------------- row changes
query(
    "update_where",
    lambda x: changes.update_where(
        x.utm,
        F.col("sales_channel").isin("tiktok") & (F.col("attribution_status") == "UNKNOWN_CHANNEL"),
        {"attribution_status": F.lit("TIKTOK_SHOP")},
    ).select("order_id", "attribution_status"),
    """
SELECT order_id, if(ifnull(sales_channel, '') = 'tiktok' AND attribution_status = 'UNKNOWN_CHANNEL', 'TIKTOK_SHOP',
  attribution_status) AS attribution_status FROM utm
""",
)
query(
    "update_from",
    lambda x: changes.update_from(
        x.clean_orders.select("id", "name", F.lit(None).cast("string").alias("channel")),
        x.utm.select(F.split_part("order_id", F.lit("/"), F.lit(5)).cast("bigint").alias("id"), "sales_channel", "total_price"),
        "id",
        {"channel": F.col("src_sales_channel")},
        F.col("src_total_price") > 100000,
    ),
    """
SELECT o.id, o.name, CASE WHEN u.total_price > 100000 THEN u.sales_channel END AS channel
FROM clean_orders o LEFT JOIN utm u ON u.numeric_id = o.id
""",
)
query(
    "retention_delete",
    lambda x: changes.retention_delete(x.raw_ads, "date_start", AS_OF).select("ad_id", "date_start", "account_id", "spend"),
    "SELECT ad_id, date_start, account_id, spend FROM raw_ads WHERE date_start >= DATE '2001-08-01' - 730",
)
query(
    "batch_merge",
    lambda x: changes.batch_merge(
        x.utm.select("order_id", "sales_channel", "extracted_at"),
        x.utm.select(
            F.when(F.col("first_utm_source") == "google", F.col("order_id"))
            .otherwise(F.concat(F.lit("new "), "order_id"))
            .alias("order_id"),
            F.lit("merged").alias("sales_channel"),
            "extracted_at",
        ),
        "order_id",
        ["extracted_at"],
    ),
    """
SELECT if(first_utm_source = 'google', '', 'new ') || order_id AS order_id, 'merged' AS sales_channel, extracted_at
FROM (SELECT * REPLACE (ifnull(first_utm_source, '') AS first_utm_source) FROM utm)
UNION ALL SELECT order_id, sales_channel, extracted_at FROM utm WHERE first_utm_source IS DISTINCT FROM 'google'
""",
)


# The same changes on a table of months, of which only those with a touched row are rewritten.
def by_month(x, df, date):
    path = fresh_folder(x.spark, "months")
    df.withColumn("month", F.trunc(date, "month")).repartition("month").write.partitionBy("month").parquet(path)
    return path


def months_after(x, path, change, *columns):
    change(x.spark, path, "month")
    return x.spark.read.parquet(path).select(*columns)


query(
    "update_touched_months",
    lambda x: months_after(
        x,
        by_month(x, x.utm.select("order_id", "created_at", "sales_channel", "attribution_status"), "created_at"),
        lambda spark, path, by: changes.update_partitions(
            spark,
            path,
            by,
            F.col("sales_channel").isin("tiktok") & (F.col("created_at") < F.lit("1995-01-01").cast("timestamp_ntz")),
            {"attribution_status": F.lit("TIKTOK_SHOP")},
        ),
        "order_id",
        "attribution_status",
    ),
    """
SELECT order_id, if(ifnull(sales_channel, '') = 'tiktok' AND created_at < TIMESTAMP '1995-01-01', 'TIKTOK_SHOP',
  attribution_status) AS attribution_status FROM utm
""",
)
query(
    "update_touched_months_from",
    lambda x: months_after(
        x,
        by_month(x, x.utm.select("order_id", "created_at", F.lit(None).cast("string").alias("channel")), "created_at"),
        lambda spark, path, by: changes.update_partitions_from(
            spark,
            path,
            by,
            x.utm.filter("created_at >= TIMESTAMP_NTZ '1997-01-01 00:00:00'").select("order_id", "sales_channel", "total_price"),
            "order_id",
            {"channel": F.col("src_sales_channel")},
            F.col("src_total_price") > 100000,
        ),
        "order_id",
        "channel",
    ),
    """
SELECT order_id, CASE WHEN created_at >= TIMESTAMP '1997-01-01' AND total_price > 100000 THEN sales_channel END AS channel FROM utm
""",
)
query(
    "retention_drop_months",
    lambda x: months_after(
        x,
        by_month(x, x.raw_ads.select("ad_id", "date_start", "account_id", "spend"), "date_start"),
        lambda spark, path, by: changes.retention_drop(spark, path, by, AS_OF),
        "ad_id",
        "date_start",
        "account_id",
        "spend",
    ),
    "SELECT ad_id, date_start, account_id, spend FROM raw_ads WHERE date_trunc('month', date_start) >= DATE '2001-08-01' - 730",
)
query(
    "merge_touched_months",
    lambda x: months_after(
        x,
        by_month(x, x.utm.select("order_id", "sales_channel", "created_at"), "created_at"),
        lambda spark, path, by: changes.merge_partitions(
            spark,
            path,
            by,
            x.utm.filter("created_at < TIMESTAMP_NTZ '1994-01-01 00:00:00'").select(
                F.when(F.col("first_utm_source") == "google", F.col("order_id"))
                .otherwise(F.concat(F.lit("new "), "order_id"))
                .alias("order_id"),
                F.lit("merged").alias("sales_channel"),
                (F.col("created_at") + F.expr("INTERVAL 40 DAYS")).alias("created_at"),
                F.trunc(F.col("created_at") + F.expr("INTERVAL 40 DAYS"), "month").alias("month"),
            ),
            "order_id",
            ["created_at"],
        ),
        "order_id",
        "sales_channel",
        "created_at",
    ),
    """
SELECT if(first_utm_source = 'google', '', 'new ') || order_id AS order_id, 'merged' AS sales_channel,
  created_at + INTERVAL 40 DAY AS created_at
FROM (SELECT * REPLACE (ifnull(first_utm_source, '') AS first_utm_source) FROM utm) WHERE created_at < TIMESTAMP '1994-01-01'
UNION ALL SELECT order_id, sales_channel, created_at FROM utm
WHERE first_utm_source IS DISTINCT FROM 'google' OR created_at >= TIMESTAMP '1994-01-01'
""",
)
query(
    "query_parameter",
    lambda x: x.utm.groupBy(query_param("landing_site_ref_params", "utm_campaign").alias("utm_campaign")).agg(
        F.count("*").alias("orders")
    ),
    """
SELECT CASE WHEN contains(landing_site_ref_params, 'utm_campaign=')
  THEN split_part(landing_site_ref_params, 'utm_campaign=', 2) END AS utm_campaign, count(*) AS orders
FROM utm GROUP BY 1
""",
)
