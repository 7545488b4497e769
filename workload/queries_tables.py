"""Scans and sinks, deduplication, conformed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from martlet.functions import as_timestamp
from martlet.operators import conform, dedup
from martlet.sources import files, tables
from workload.inputs import AS_OF
from workload.oracle_views import TIES, latest
from workload.registry import fresh_folder, query

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# ------------------------------------------------------------------ scans and sinks
query("read_table", lambda x: x.table("customer"), "SELECT * FROM customer")


def backup_folder(x):
    """Order backup as newline JSON, some lines cut short, and those without a customer."""
    h = x.order_history
    customer = F.when(
        F.col("customer_email").isNotNull(),
        F.struct(
            F.col("customer_email").alias("email"),
            F.col("customer_first_name").alias("firstName"),
            F.col("customer_last_name").alias("lastName"),
        ),
    )
    line = F.to_json(F.struct("id", customer.alias("customer")))
    cut = F.col("total_price") < 2000
    folder = fresh_folder(x.spark, "backup")
    h.select(F.when(cut, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(folder)
    return files.read_json_lines(x.spark, folder)


query(
    "read_json_backup",
    lambda x: files.json_backup(backup_folder(x)),
    """
SELECT id AS order_id, customer_email, customer_first_name, customer_last_name FROM order_history
WHERE total_price >= 2000 AND customer_email IS NOT NULL
""",
)
query(
    "read_json_backup_counts",
    lambda x: files.backup_counts(backup_folder(x)),
    """
SELECT count(*) AS processed, count(*) FILTER (total_price < 2000) AS errors,
  count(*) FILTER (total_price >= 2000 AND customer_email IS NOT NULL) AS usable,
  count(*) FILTER (total_price >= 2000 AND customer_email IS NULL) AS skipped
FROM order_history
""",
)
query(
    "stage_with_schema",
    lambda x: tables.stage_with_schema(
        x.order_history,
        {"id": "string", "customer_id": "bigint", "created_at": "date", "total_price": "double", "shipping_zip": "int"},
    ),
    """
SELECT id::VARCHAR AS id, customer_id::BIGINT AS customer_id, created_at::DATE AS created_at,
  total_price::DOUBLE AS total_price, shipping_zip::INTEGER AS shipping_zip FROM order_history
""",
)
query(
    "write_table",
    lambda x: tables.write_table(x.clean_customers, fresh_folder(x.spark, "clean-customers")),
    "SELECT * REPLACE (total_spent::DOUBLE AS total_spent) FROM clean_customers",
)


def published(x):
    """Customers published under a name that an empty table held before."""
    name = f"clean_customers_{uuid.uuid4().hex}"
    tables.publish_table(x.clean_customers.limit(0), name)
    return tables.publish_table(x.clean_customers, name, check=lambda new: not new.isEmpty(), keep=0)


query(
    "publish_table",
    published,
    "SELECT * REPLACE (total_spent::DOUBLE AS total_spent) FROM clean_customers",
)
query(
    "register_view",
    lambda x: tables.register_view(
        x.email_refs,
        "pii_hash_reference",
        {c: c for c in ("email_hash_original", "email_hash_consistent", "sources", "source_count")},
    ),
    "SELECT * FROM ref_email",
)


def csv_round_trip(x):
    folder = fresh_folder(x.spark, "csv")
    tables.export_csv(x.products, folder)
    return x.spark.read.option("header", True).option("escape", '"').csv(folder)


query(
    "export_csv",
    csv_round_trip,
    "SELECT product_id::VARCHAR AS product_id, title, vendor, variants FROM products",
)


def sharded_events(x):
    folder = fresh_folder(x.spark, "shards")
    files.write_sharded(x.web_events, folder, F.col("ts").cast("date"), "2024-01-29")
    return folder


query(
    "read_sharded",
    lambda x: files.read_sharded(x.spark, sharded_events(x), "events=")
    .groupBy("shard_date", "is_intraday", "event_name")
    .agg(F.count("*").alias("event_count")),
    """
SELECT ts::DATE AS shard_date, ts >= TIMESTAMP '2024-01-29' AS is_intraday, event_name, count(*) AS event_count
FROM web_events GROUP BY ALL
""",
)
query(
    "shard_freshness",
    lambda x: files.shard_freshness(files.read_sharded(x.spark, sharded_events(x), "events=")),
    """
SELECT max(ts::DATE) FILTER (ts < TIMESTAMP '2024-01-29') AS latest_daily,
  max(ts::DATE) FILTER (ts >= TIMESTAMP '2024-01-29') AS latest_intraday FROM web_events
""",
)
query(
    "table_stats",
    lambda x: tables.table_stats(x.spark, {t: f"{x.sf_dir}/{t}.parquet" for t in GIVEN}).select(
        "table_name", "row_count", (F.col("files") > 0).alias("has_files"), (F.col("size_mb") > 0).alias("has_size")
    ),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS has_files, true AS has_size FROM {t}" for t in GIVEN
    ),
)
query(
    "table_counts_from_footers",
    lambda x: tables.footer_counts(x.spark, {t: f"{x.sf_dir}/{t}.parquet" for t in GIVEN}),
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in GIVEN),
)
query(
    "column_ranges_from_footers",
    lambda x: tables.footer_ranges(x.spark, f"{x.sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey"]),
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value FROM lineitem"
        for c in ("l_orderkey", "l_partkey")
    ),
)
SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}
query(
    "describe_schema",
    lambda x: tables.describe_schema(x.spark, {t: x.table(t) for t in GIVEN}),
    f"""
SELECT table_name, ordinal_position::INTEGER - 1 AS position, column_name, CASE data_type
  {" ".join(f"WHEN '{d}' THEN '{s}'" for d, s in SPARK_TYPES.items())} WHEN 'FLOAT[]' THEN 'array<float>'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type, is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in GIVEN)})
""",
)
PROFILE_SQL = """
SELECT '{t}' AS table_name, column_name, filled AS non_null_count
FROM (SELECT count(COLUMNS(*)) FROM {t}) UNPIVOT (filled FOR column_name IN (COLUMNS(*)))
"""
query(
    "column_profile",
    lambda x: tables.column_profile({t: x.table(t) for t in GIVEN}).select("table_name", "column_name", "non_null_count"),
    " UNION ALL ".join(PROFILE_SQL.format(t=t) for t in GIVEN),
)
EXPECTED = {"customer": ["c_custkey", "c_email", "c_mktsegment"], "orders": ["o_orderkey", "o_totalprice", "o_phone"]}
query(
    "columns_present",
    lambda x: tables.columns_present({t: x.table(t) for t in EXPECTED}, EXPECTED),
    """
SELECT table_name, column_name, n > 0 AS present, nullif(n, 0) AS non_null_count FROM (
  SELECT 'customer' AS table_name, unnest(['c_custkey', 'c_email', 'c_mktsegment']) AS column_name,
    unnest([count(c_custkey), 0, count(c_mktsegment)]) AS n FROM customer
  UNION ALL SELECT 'orders', unnest(['o_orderkey', 'o_totalprice', 'o_phone']),
    unnest([count(o_orderkey), count(o_totalprice), 0]) FROM orders)
""",
)
query(
    "preview",
    lambda x: tables.preview(
        x.clean_orders.select("id", "name", "created_at", "total_price"), 100, [F.col("created_at").desc(), "id"]
    ),
    """
SELECT id, name, created_at, total_price::DOUBLE AS total_price FROM clean_orders
ORDER BY created_at DESC, id LIMIT 100
""",
)


def ad_hoc(x):
    x.clean_orders.createOrReplaceTempView("orders_clean")
    text = "SELECT source_name, count(*) AS n, sum(total_price) AS revenue FROM orders_clean GROUP BY source_name"
    return tables.run_sql(x.spark, text, 1000)


query(
    "run_sql",
    ad_hoc,
    """
SELECT source_name, count(*) AS n, sum(total_price)::DOUBLE AS revenue, false AS truncated FROM clean_orders GROUP BY 1
""",
)


def two_syncs(x):
    """First sync holds the newer half; the second sees everything and appends what is new, late as it is."""
    folder = fresh_folder(x.spark, "sync")
    tables.sync_write(x.web_events.filter(F.col("ts") >= as_timestamp("2024-01-15 00:00:00")), folder, "ts")
    return tables.sync_write(x.web_events, folder, "ts")


query("sync_write", two_syncs, "SELECT * FROM web_events")


def two_syncs_by_day(x):
    """As `two_syncs`, into a store with a folder per day."""
    folder = fresh_folder(x.spark, "sync")
    tables.sync_write(x.web_events.filter(F.col("ts") >= as_timestamp("2024-01-15 00:00:00")), folder, "ts", by_day=True)
    return tables.sync_write(x.web_events, folder, "ts", by_day=True)


query("sync_write_by_day", two_syncs_by_day, "SELECT * FROM web_events")

# -------------------------------------------------------------------- deduplication
AD_TYPES = "SELECT * REPLACE (tie4::DOUBLE AS tie4) FROM"
query(
    "dedup_latest",
    # Both versions of an order mostly fall into one month, so the tie-break decides.
    lambda x: dedup.dedup_latest(
        x.raw_orders, ["id"], [F.date_trunc("month", "extracted_at")], ["total_price", "extracted_at"]
    ).select("id", "name", "email", "total_price", "extracted_at"),
    """
SELECT id, name, email, total_price::DOUBLE AS total_price, extracted_at FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY date_trunc('month', extracted_at) DESC, total_price DESC, extracted_at DESC) AS n FROM raw_orders) WHERE n = 1
""",
)
query("dedup_ads_base", lambda x: dedup.ads_base(x.raw_ads), f"{AD_TYPES} ads")
for _name, _fn, _dims in (
    ("dedup_ads_action_type", dedup.ads_action_type, "action_type"),
    ("dedup_ads_dma", dedup.ads_dma, "dma"),
    ("dedup_ads_platform_device", dedup.ads_platform_device, "publisher_platform, device_platform"),
    ("dedup_ads_country", lambda df: dedup.ads_breakdown(df, ["country"]), "country"),
    ("dedup_ads_breakdown", lambda df: dedup.ads_breakdown(df, ["country", "dma"]), "country, dma"),
):
    query(
        _name,
        lambda x, fn=_fn: fn(x.raw_ads),
        f"{AD_TYPES} ({latest('raw_ads', 'ad_id, date_start, account_id, ' + _dims, TIES)})",
    )
query(
    "dedup_ad_report_json",
    lambda x: x.ad_report,
    "SELECT * REPLACE (spend::DOUBLE AS spend) FROM ad_report",
)
for _level in ("adgroup", "campaign", "advertiser"):
    query(
        f"dedup_{_level}_report",
        lambda x, level=_level: dedup.report_latest(x.raw_ads_json, level).drop("metrics"),
        f"SELECT * EXCLUDE (metrics) REPLACE (tie4::DOUBLE AS tie4) FROM ({latest('raw_ads_json', f'{_level}_id, stat_time_day::DATE', TIES)})",
    )
query(
    "clean_orders",
    lambda x: x.clean_orders.drop("total_shipping_price_set"),
    """
SELECT * EXCLUDE (shipping_json) REPLACE (total_price::DOUBLE AS total_price,
  total_line_items_price::DOUBLE AS total_line_items_price, current_total_discounts::DOUBLE AS current_total_discounts,
  total_tax::DOUBLE AS total_tax) FROM clean_orders
""",
)
query(
    "clean_customers",
    lambda x: x.clean_customers,
    "SELECT * REPLACE (total_spent::DOUBLE AS total_spent) FROM clean_customers",
)
query(
    "clean_transactions",
    lambda x: dedup.clean_transactions(x.transactions),
    """
SELECT id, order_id, gateway, status, kind, amount, created_at FROM (
  SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY created_at DESC, amount DESC, gateway DESC, status DESC) AS r
  FROM transactions) WHERE r = 1 GROUP BY ALL
""",
)

# ------------------------------------------------------------------- conformed tables
MONEY_ORDER = ", ".join(f"{c}::DOUBLE AS {c}" for c in ("order_value", "order_subtotal", "order_discounts", "order_tax"))
query(
    "orders_base",
    lambda x: conform.orders_base(x.clean_orders),
    f"SELECT * REPLACE ({MONEY_ORDER}) FROM base_orders",
)
query(
    "gid_to_numeric",
    lambda x: conform.numeric_ids(x.utm, "order_id"),
    "SELECT order_id, split_part(order_id, '/', 5)::BIGINT AS numeric_id FROM utm",
)
query(
    "order_number_clean",
    lambda x: conform.order_numbers(x.clean_orders),
    """
SELECT id, name, CASE WHEN starts_with(name, '#') THEN substr(name, 2)
  WHEN starts_with(name, 'X-') THEN split_part(name, '-', 2) ELSE name END AS order_number_clean FROM clean_orders
""",
)
query(
    "order_type",
    lambda x: conform.order_type_counts(x.clean_orders),
    """
SELECT CASE left(name, 1) WHEN '#' THEN 'Shopify Standard' WHEN 'X' THEN 'Marketplace/External' ELSE 'Other' END
  AS order_type, source_name, count(*) AS order_count FROM clean_orders GROUP BY ALL
""",
)
query(
    "customers_enhanced",
    lambda x: conform.customers_enhanced(x.clean_customers),
    """
SELECT * REPLACE (customer_lifetime_value_shopify::DOUBLE AS customer_lifetime_value_shopify) FROM base_customers
""",
)
query(
    "ad_unified_facebook",
    lambda x: x.facebook,
    "SELECT * REPLACE (fb_spend::DOUBLE AS fb_spend) FROM facebook",
)
query("ad_unified_tiktok", lambda x: x.tiktok, "SELECT * REPLACE (tt_spend::DOUBLE AS tt_spend) FROM tiktok")
query(
    "ad_unified_google",
    lambda x: x.google.drop("metrics_cost_micros"),
    """
SELECT * EXCLUDE (metrics_cost_micros) REPLACE (ga_conversion_value::DOUBLE AS ga_conversion_value) FROM google
""",
)
query(
    "ad_unified_amazon",
    lambda x: x.amazon,
    "SELECT * REPLACE (amz_spend::DOUBLE AS amz_spend, amz_sales::DOUBLE AS amz_sales) FROM amazon",
)
DETAIL = {
    "spend_usd": "spend",
    "ctr_pct": "ctr",
    "cpc_usd": "cpc",
    "cpm_usd": "cpm",
    "cpa_usd": "cost_per_conversion",
    "avg_watch_time_sec": "average_video_play",
}
COUNTS = {
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
query(
    "ad_export_detail",
    lambda x: conform.ad_export_detail(x.ads_latest_json),
    "SELECT stat_time_day::DATE AS date, metrics ->> '$.campaign_name' AS campaign_name, "
    "metrics ->> '$.adgroup_name' AS adgroup_name, metrics ->> '$.ad_name' AS ad_name, "
    + ", ".join(f"(metrics ->> '$.{s}')::DECIMAL(18,2)::DOUBLE AS {d}" for d, s in DETAIL.items())
    + ", "
    + ", ".join(f"(metrics ->> '$.{s}')::BIGINT AS {d}" for d, s in COUNTS.items())
    + " FROM ads_latest_json",
)
query(
    "parse_utm_params",
    lambda x: conform.utm_parameters(x.utm),
    """
SELECT numeric_id AS order_id_numeric, landing_site_ref_params AS utm_params_raw, p['utm_source'] AS utm_source,
  p['utm_medium'] AS utm_medium, p['utm_campaign'] AS utm_campaign, p['utm_content'] AS utm_content,
  p['utm_term'] AS utm_term
FROM (SELECT *, map_from_entries(list_transform(string_split(coalesce(landing_site_ref_params, ''), '&'),
  lambda kv: row(split_part(kv, '=', 1), split_part(kv, '=', 2)))) AS p FROM utm)
""",
)
query(
    "ad_conversions_from_actions",
    lambda x: conform.ad_conversions_from_actions(x.facebook, AS_OF),
    """
SELECT fb_campaign_name, date, fb_clicks, n AS conversions, n::DOUBLE / nullif(fb_clicks, 0) * 100
  AS conversion_rate_percent
FROM (SELECT *, (fb_actions_json ->> '$[0].value')::BIGINT AS n FROM facebook)
WHERE fb_actions_json IS NOT NULL AND date >= DATE '2001-08-01' - 30
""",
)
query(
    "ad_revenue_from_roas",
    lambda x: conform.ad_revenue_from_roas(x.ads).select(
        "ad_id", "date_start", "account_id", "spend", "revenue", "profit"
    ),
    """
SELECT ad_id, date_start, account_id, s::DOUBLE AS spend, (r * s)::DOUBLE AS revenue, (r * s - s)::DOUBLE AS profit
FROM (SELECT *, spend::DECIMAL(18,2) AS s, coalesce((purchase_roas ->> '$[0].value')::DECIMAL(8,2), 0) AS r FROM ads)
""",
)
query(
    "variant_cost",
    lambda x: conform.variant_cost(x.products),
    "SELECT product_id, title, vendor, cost::DOUBLE AS cost, 'SKU-' || product_id AS sku FROM products",
)
query(
    "attribution_channel",
    lambda x: x.shop.groupBy("attribution_channel").agg(F.count("*").alias("orders")),
    """
SELECT CASE WHEN first_utm_source IS NULL THEN ifnull(source_name, 'direct') ELSE first_utm_source END
  AS attribution_channel, count(*) AS orders FROM shop GROUP BY 1
""",
)
query(
    "order_flags",
    lambda x: x.shop.select("order_id", "customer_id", "is_cancelled", "has_refund", "order_net_value"),
    """
SELECT order_id, customer_id, order_cancelled_at IS NOT NULL AS is_cancelled, refund_count IS NOT NULL AS has_refund,
  (order_value - order_discounts - ifnull(refunds_total_amount, 0))::DOUBLE AS order_net_value FROM shop
""",
)
query(
    "zero_explanations",
    lambda x: conform.zero_explanations(x.marketing)
    .groupBy("revenue_zero_explanation", "impressions_zero_explanation", "is_suspicious_zero")
    .agg(F.count("*").alias("day_rows")),
    """
SELECT CASE WHEN revenue <> 0 THEN 'Normal' WHEN ad_spend = 0 THEN 'No campaign running'
    WHEN ad_spend < 0 THEN 'Unknown - investigate' WHEN ad_clicks < 10 THEN 'Low traffic - not enough clicks'
    ELSE 'Attribution issue or conversion lag' END AS revenue_zero_explanation,
  CASE WHEN ad_impressions <> 0 OR ad_spend < 0 THEN 'Normal'
    WHEN ad_spend = 0 THEN 'Campaign paused or budget exhausted' ELSE 'Data sync issue - check Airbyte' END
    AS impressions_zero_explanation,
  (revenue = 0 AND ad_spend > 100 AND ad_clicks > 50) OR (ad_impressions = 0 AND ad_spend > 0) AS is_suspicious_zero,
  count(*) AS day_rows
FROM marketing GROUP BY ALL
""",
)
query(
    "period_labels",
    lambda x: conform.period_labels(x.monthly.select("month", "channel", "total_revenue")),
    """
SELECT month, channel, total_revenue, strftime(month, '%B %Y') AS period_label,
  strftime(month - INTERVAL 1 YEAR, '%B %Y') AS comparison_period_label, 'YoY' AS comparison_type FROM monthly
""",
)
query(
    "shipping_geo",
    lambda x: conform.shipping_geo(x.raw_orders).select(
        "id", "extracted_at", "shipping_country", "shipping_city", "shipping_province"
    ),
    """
SELECT id, extracted_at, json_extract_string(shipping_address, 'country') AS shipping_country,
  json_extract_string(shipping_address, 'city') AS shipping_city,
  json_extract_string(shipping_address, 'province') AS shipping_province FROM raw_orders
""",
)
query(
    "shape_json",
    lambda x: x.clean_orders.select("id", conform.shape_json("total_shipping_price_set").alias("shipping_info")),
    "SELECT id, shipping_json AS shipping_info FROM clean_orders",
)
