"""DuckDB side: the domain tables and layers as named SQL, plus a helper that puts
only the needed ones in front of a check query as a WITH list."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def with_views(sql: str) -> str:
    """Prefix `sql` with the views it names (and the views those name), in definition order."""
    wanted: set[str] = set()
    queue = [sql]
    while queue:
        text = re.sub(r"'[^']*'", "", queue.pop())
        for word in set(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in VIEWS and word not in wanted:
                wanted.add(word)
                queue.append(VIEWS[word])
    if not wanted:
        return sql.strip()
    listed = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = f"SELECT * FROM ({body})"
    return f"WITH {listed}\n{body}"


def hashed(col: str) -> str:
    """Normalise-and-hash of one column; NULL and '' give NULL."""
    return f"CASE WHEN {col} <> '' THEN sha256(lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))) END"


def latest(source: str, keys: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


# ------------------------------------------------------------------ shop extracts
view(
    "customer_base",
    """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 10 = 8 THEN ''
       WHEN c_custkey % 3 = 0 THEN '  CUST' || e || '@Example.COM '
       ELSE 'cust' || e || '@example.com' END AS email,
  CASE WHEN c_custkey % 4 <> 0 THEN '+1555' || lpad(c_custkey::VARCHAR, 7, '0') END AS phone,
  CASE WHEN c_custkey % 9 <> 0 THEN 'First' || (c_custkey % 50) END AS first_name,
  'Last' || (c_custkey % 200) AS last_name,
  CASE WHEN c_custkey % 5 <> 2 THEN '[' || addr || ']' END AS addresses,
  CASE WHEN c_custkey % 6 <> 1 THEN addr END AS default_address,
  CASE WHEN c_custkey % 2 = 0 THEN 'enabled' ELSE 'disabled' END AS state,
  c_mktsegment AS tags,
  (c_custkey % 4)::BIGINT AS orders_count,
  CASE WHEN c_custkey % 6 = 0 THEN 0::DECIMAL(18,2) ELSE c_acctbal::DECIMAL(18,2) END AS total_spent,
  c_custkey % 5 <> 0 AS accepts_marketing,
  c_custkey % 3 <> 0 AS verified_email,
  CASE WHEN c_custkey % 3 = 0 THEN '{"state":"subscribed","consent_updated_at":"2000-01-01"}' END
    AS email_marketing_consent,
  CASE WHEN c_custkey % 7 = 0 THEN '{"state":"not_subscribed","consent_updated_at":"2000-02-02"}' END
    AS sms_marketing_consent,
  TIMESTAMP '1995-01-02 00:00:00' AS created_at
FROM (
  SELECT *, CASE WHEN c_custkey % 97 = 1 THEN c_custkey - 1 ELSE c_custkey END AS e,
    '{"country":"' || n_name || '","city":"City' || (c_custkey % 30) || '","province":"P' || (c_custkey % 12) || '"}'
      AS addr
  FROM customer JOIN nation ON n_nationkey = c_nationkey
)
""",
)
view(
    "raw_customers",
    """
SELECT * EXCLUDE (x) REPLACE (CASE WHEN x = 2 THEN tags ELSE 'OLD' END AS tags),
  CASE WHEN x = 2 THEN TIMESTAMP '2001-08-01' ELSE TIMESTAMP '2001-07-01' END AS extracted_at,
  CASE WHEN x = 2 THEN TIMESTAMP '2001-07-31' ELSE TIMESTAMP '2001-06-30' END AS updated_at
FROM customer_base JOIN (VALUES (1), (2)) v(x) ON x = 2 OR tags = 'BUILDING'
""",
)
view(
    "raw_orders",
    """
SELECT o_orderkey AS id,
  'gid://shopify/Order/' || o_orderkey AS admin_graphql_api_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'X-' || o_orderkey || '-1' WHEN o_orderkey % 11 = 0 THEN 'D' || o_orderkey
       ELSE '#' || o_orderkey END AS name,
  CASE WHEN o_orderkey % 13 <> 0 THEN upper(email) END AS email,
  CASE WHEN o_orderkey % 13 <> 0 THEN upper(email) END AS contact_email,
  phone,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN ''
       ELSE '10.0.' || (o_custkey % 5) || '.' || (o_custkey % 40) END AS browser_ip,
  CASE WHEN o_orderkey % 17 = 0 THEN '{"email":"' || email || '","first_name":"' || first_name || '"}' END AS customer,
  o_custkey AS user_id,
  default_address AS billing_address, default_address AS shipping_address,
  CASE o_orderkey % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'tiktok' WHEN 2 THEN 'shopify_draft_order' END AS source_name,
  o_orderstatus AS financial_status,
  CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
  CASE WHEN o_orderkey % 50 = 0 THEN 'test' ELSE o_orderpriority END AS tags,
  'USD' AS currency,
  CASE WHEN o_orderkey % 3 = 0 THEN '/p/' || (o_orderkey % 10) END AS landing_site,
  CASE WHEN o_orderkey % 7 = 0 THEN 'https://search.example.com' END AS referring_site,
  CASE WHEN o_orderkey % 40 = 0 THEN 0::DECIMAL(18,2)
       ELSE (o_totalprice::DECIMAL(18,2) + x - 2)::DECIMAL(18,2) END AS total_price,
  o_totalprice::DECIMAL(18,2) AS total_line_items_price,
  CASE WHEN o_orderkey % 80 = 0 THEN o_totalprice::DECIMAL(18,2)
       ELSE (o_orderkey % 7)::DECIMAL(18,2) END AS current_total_discounts,
  (o_orderkey % 9)::DECIMAL(18,2) AS total_tax,
  '{"amount":"' || (o_orderkey % 9)::DECIMAL(18,2) || '","currency":"USD"}' AS shipping_json,
  o_orderdate AS created_at,
  o_orderdate + INTERVAL 1 HOUR AS processed_at,
  CASE WHEN o_orderkey % 20 = 0 THEN o_orderdate + INTERVAL 1 DAY END AS cancelled_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY END AS closed_at,
  CASE WHEN o_orderkey % 20 = 0 THEN 'customer' END AS cancel_reason,
  o_orderdate + to_days(x) AS extracted_at
FROM orders JOIN (SELECT id AS c_id, email, phone, first_name, default_address FROM customer_base) ON c_id = o_custkey
JOIN (VALUES (1), (2)) v(x) ON x = 2 OR o_orderpriority = '1-URGENT'
""",
)
view(
    "order_history",
    """
SELECT o_orderkey AS id, '#' || o_orderkey AS name, o_orderdate AS created_at, 'USD' AS currency_code,
  o_totalprice::DECIMAL(18,2) AS total_price, o_custkey::VARCHAR AS customer_id, email AS customer_email,
  first_name AS customer_first_name, last_name AS customer_last_name,
  default_address ->> '$.country' AS shipping_country, default_address ->> '$.city' AS shipping_city,
  lpad((o_orderkey % 1000)::VARCHAR, 5, '0') AS shipping_zip
FROM orders JOIN (SELECT id AS c_id, email, first_name, last_name, default_address FROM customer_base)
  ON c_id = o_custkey
""",
)
view(
    "line_items",
    """
SELECT 'gid://shopify/Order/' || l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
  'SKU-' || l_partkey AS sku, p_name AS title, l_quantity::BIGINT AS quantity,
  l_extendedprice::DECIMAL(18,2) AS original_total, l_orderkey AS numeric_id
FROM lineitem JOIN part ON p_partkey = l_partkey
""",
)
view(
    "transactions",
    """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
  CASE l_returnflag WHEN 'A' THEN 'shopify_payments' WHEN 'N' THEN 'paypal' ELSE 'gift_card' END AS gateway,
  CASE l_linestatus WHEN 'F' THEN 'success' ELSE 'pending' END AS status,
  CASE WHEN l_linenumber % 2 = 0 THEN 'sale' ELSE 'capture' END AS kind,
  l_extendedprice::DECIMAL(18,2)::VARCHAR AS amount, l_shipdate AS created_at
FROM lineitem
""",
)
view(
    "refunds",
    """
SELECT l_orderkey AS order_id,
  CASE WHEN l_linenumber = 1 THEN '[]' ELSE '[{"amount":"' || l_quantity::DECIMAL(18,2) || '"}]' END AS transactions_json,
  l_shipdate AS created_at
FROM lineitem WHERE l_returnflag = 'R'
""",
)
view(
    "utm",
    """
SELECT *, upper(sales_channel) AS sales_channel_name, first_landing_page AS last_landing_page FROM (
SELECT o_orderkey AS numeric_id, 'gid://shopify/Order/' || o_orderkey AS order_id, '#' || o_orderkey AS order_name,
  o_orderdate AS created_at, o_totalprice::DECIMAL(18,2) AS total_price,
  CASE o_orderkey % 6 WHEN 0 THEN 'facebook' WHEN 1 THEN 'tiktok' WHEN 2 THEN 'google' WHEN 3 THEN 'Facebook' END
    AS first_utm_source,
  CASE WHEN o_orderkey % 6 < 4 THEN 'cpc' END AS first_utm_medium,
  CASE WHEN o_orderkey % 6 < 4 THEN 'c' || (o_orderkey % 12) END AS first_utm_campaign,
  NULL::VARCHAR AS first_utm_content, NULL::VARCHAR AS first_utm_term,
  CASE WHEN o_orderkey % 3 = 0 THEN 'https://example.com/p/' || (o_orderkey % 10) END AS first_landing_page,
  CASE WHEN o_orderkey % 7 = 0 THEN 'https://search.example.com' END AS first_referrer_url,
  o_orderdate AS first_visit_at,
  CASE o_orderkey % 5 WHEN 0 THEN 'facebook' WHEN 1 THEN 'email' END AS last_utm_source,
  CASE WHEN o_orderkey % 5 = 0 THEN 'cpc' END AS last_utm_medium,
  CASE WHEN o_orderkey % 5 = 0 THEN 'c' || (o_orderkey % 12) END AS last_utm_campaign,
  o_orderdate AS last_visit_at,
  CASE WHEN o_orderkey % 6 < 4 THEN 'utm_source=s' || (o_orderkey % 6) || '&utm_medium=cpc&utm_campaign=c'
    || (o_orderkey % 12) END AS landing_site_ref_params,
  (['amazon-us','tiktok','shop','web','shopify_draft_order','pos','marketplace','amazon-ca'])[(o_orderkey % 10) + 1]
    AS sales_channel,
  CASE WHEN o_orderkey % 4 = 3 THEN 'HAS_UTM' ELSE 'UNKNOWN_CHANNEL' END AS attribution_status,
  (o_orderkey % 3 + 1)::BIGINT AS customer_order_index, (o_orderkey % 30)::BIGINT AS days_to_conversion,
  o_orderdate + INTERVAL 1 DAY AS extracted_at
FROM orders)
""",
)
view(
    "products",
    """
SELECT p_partkey AS product_id, p_name AS title, p_brand AS vendor,
  '[{"sku":"SKU-' || p_partkey || '","cost":"' || p_size::DECIMAL(18,2) || '"}]' AS variants,
  p_size::DECIMAL(18,2) AS cost
FROM part
""",
)

# -------------------------------------------------------------------- ad extracts
view(
    "raw_ads",
    """
SELECT (l_suppkey % 3)::VARCHAR AS account_id, 'account ' || (l_suppkey % 3) AS account_name,
  (l_partkey % 5)::VARCHAR AS campaign_id,
  (['uk_prospecting','eu_remarketing','Catalogue_smart','brand_search','boosting'])[(l_partkey % 5) + 1] AS campaign_name,
  (l_partkey % 10)::VARCHAR AS adset_id, 'adset ' || (l_partkey % 10) AS adset_name,
  (l_partkey % 40)::VARCHAR AS ad_id, 'ad ' || (l_partkey % 40) AS ad_name,
  n_name AS country, 'dma' || (l_partkey % 4) AS dma,
  CASE WHEN l_partkey % 3 = 0 THEN 'purchase' ELSE 'add_to_cart' END AS action_type,
  CASE WHEN l_suppkey % 2 = 0 THEN 'facebook' ELSE 'instagram' END AS publisher_platform,
  CASE WHEN l_partkey % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_platform,
  l_shipdate::DATE AS date_start, l_shipdate::DATE AS date_stop,
  l_extendedprice::DECIMAL(18,2)::VARCHAR AS spend,
  l_quantity::BIGINT * 100 AS impressions, l_quantity::BIGINT % 7 AS clicks, l_quantity::BIGINT * 50 AS reach,
  CASE WHEN l_linenumber % 4 <> 0 THEN '[{"action_type":"purchase","value":"' || (l_linenumber % 4) || '.5"}]' END
    AS purchase_roas,
  '[{"action_type":"purchase","value":"' || (l_linenumber % 3) || '"}]' AS actions,
  l_linenumber AS extract_no, l_orderkey AS tie1, l_partkey AS tie2, l_suppkey AS tie3,
  l_extendedprice::DECIMAL(18,2) AS tie4
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
""",
)
view(
    "raw_ads_json",
    """
SELECT l_partkey % 30 AS ad_id, l_partkey % 10 AS adgroup_id, l_partkey % 5 AS campaign_id, 7::BIGINT AS advertiser_id,
  l_shipdate AS stat_time_day,
  json_object('campaign_name', (['prospecting','remarketing','Catalog','search','misc'])[(l_partkey % 5) + 1]
      || (l_partkey % 5),
    'adgroup_name', 'group' || (l_partkey % 10), 'ad_name', 'ad' || (l_partkey % 30),
    'spend', l_extendedprice::DECIMAL(18,2)::VARCHAR, 'impressions', (l_quantity::BIGINT * 100)::VARCHAR,
    'clicks', (l_quantity::BIGINT % 7)::VARCHAR, 'conversion', (l_linenumber % 3)::VARCHAR,
    'complete_payment', (l_linenumber % 2)::VARCHAR, 'cost_per_conversion', l_tax::DECIMAL(18,2)::VARCHAR,
    'cpc', l_tax::DECIMAL(18,2)::VARCHAR, 'cpm', l_discount::DECIMAL(18,2)::VARCHAR,
    'ctr', l_discount::DECIMAL(18,2)::VARCHAR, 'reach', (l_quantity::BIGINT * 50)::VARCHAR,
    'video_play_actions', (l_quantity::BIGINT * 10)::VARCHAR, 'video_views_p25', (l_quantity::BIGINT * 8)::VARCHAR,
    'video_views_p50', (l_quantity::BIGINT * 6)::VARCHAR, 'video_views_p75', (l_quantity::BIGINT * 4)::VARCHAR,
    'video_views_p100', (l_quantity::BIGINT * 2)::VARCHAR,
    'average_video_play', l_discount::DECIMAL(18,2)::VARCHAR, 'likes', (l_quantity::BIGINT % 11)::VARCHAR,
    'comments', (l_quantity::BIGINT % 3)::VARCHAR, 'shares', (l_quantity::BIGINT % 5)::VARCHAR,
    'engagements', (l_quantity::BIGINT % 13)::VARCHAR)::VARCHAR AS metrics,
  l_linenumber AS extract_no, l_orderkey AS tie1, l_partkey AS tie2, l_suppkey AS tie3,
  l_extendedprice::DECIMAL(18,2) AS tie4
FROM lineitem
""",
)
view(
    "campaign_stats",
    """
SELECT l_shipdate::DATE AS segments_date, l_suppkey AS campaign_id,
  (['MOBILE','DESKTOP','TABLET'])[(l_linenumber % 3) + 1] AS segments_device,
  CASE WHEN l_linestatus = 'F' THEN 'SEARCH' ELSE 'DISPLAY' END AS segments_ad_network_type,
  (l_extendedprice::DECIMAL(18,2) * 10000)::BIGINT AS metrics_cost_micros,
  l_quantity::BIGINT * 20 AS metrics_impressions, l_quantity::BIGINT % 5 AS metrics_clicks,
  (l_linenumber % 2)::BIGINT AS metrics_conversions, l_extendedprice::DECIMAL(18,2) AS metrics_conversions_value
FROM lineitem
""",
)
view(
    "campaigns",
    """
SELECT s_suppkey AS campaign_id, s_name AS campaign_name,
  CASE WHEN s_nationkey % 3 = 0 THEN 'PAUSED' ELSE 'ENABLED' END AS campaign_status
FROM supplier WHERE s_acctbal >= 0
""",
)
view(
    "sponsored",
    """
SELECT l_linestatus AS report, l_shipdate::DATE AS date, l_suppkey AS campaign_id, s_name AS campaign_name,
  l_quantity::BIGINT * 20 AS impressions, l_quantity::BIGINT % 5 AS clicks, l_extendedprice::DECIMAL(18,2) AS cost,
  (l_linenumber % 2)::BIGINT AS conversions, (l_extendedprice::DECIMAL(18,2) * l_linenumber)::DECIMAL(18,2) AS sales
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
""",
)

# --------------------------------------------------------------- events and syncs
view(
    "web_events",
    """
SELECT event_id, ts, user_id AS user_pseudo_id,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_item' WHEN 'signup' THEN 'add_to_cart'
    ELSE event_type END AS event_name, value, props
FROM events
""",
)
view(
    "attempts",
    """
SELECT event_id // 3 AS job_id, event_id % 3 AS attempt_no,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
  ts AS created_at, ts + to_seconds(event_id % 600 + 1) AS ended_at,
  (props ->> '$.k')::BIGINT AS k, (props ->> '$.k')::BIGINT * 11 AS records
FROM events
""",
)
view(
    "sync_jobs",
    "SELECT job_id, 'conn' || (job_id % 3) AS connection, min(created_at) AS created_at FROM attempts GROUP BY job_id",
)
view(
    "tables_now",
    """
SELECT if(ts >= TIMESTAMP '2024-01-08', '', 'archive_') || event_name || '_' || strftime(ts, '%Y%m%d%H') AS table_name,
  count(*) FILTER (value >= 20) AS row_count, min(ts) AS created_at, max(ts) AS last_extracted_at
FROM web_events WHERE ts < TIMESTAMP '2024-01-31' GROUP BY 1
""",
)
view(
    "tables_baseline",
    """
SELECT event_name || '_' || strftime(ts, '%Y%m%d%H') AS table_name,
  count(*) FILTER (value >= 60 OR value < 2) AS row_count, min(ts) AS created_at
FROM web_events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1
""",
)

# -------------------------------------------------------------------- clean layer
view(
    "clean_orders",
    f"""
SELECT * EXCLUDE (email, contact_email, phone, billing_address, shipping_address),
  {hashed('email')} AS email_hash, {hashed('phone')} AS phone_hash
FROM ({latest('raw_orders', 'id', 'extracted_at DESC')})
""",
)
view(
    "clean_customers",
    f"""
SELECT * EXCLUDE (email, phone, last_name, addresses, default_address),
  {hashed('email')} AS email_hash, {hashed('phone')} AS phone_hash, {hashed('first_name')} AS first_name_hash,
  {hashed('last_name')} AS last_name_hash, sha256(addresses) AS addresses_hash,
  sha256(default_address) AS default_address_hash
FROM ({latest('raw_customers', 'id', 'extracted_at DESC')})
""",
)
view("hashed_orders", f"SELECT *, {hashed('email')} AS email_hash FROM raw_orders")
view("hashed_customers", f"SELECT *, {hashed('email')} AS email_hash FROM raw_customers")
view("hashed_history", f"SELECT *, {hashed('customer_email')} AS email_hash FROM order_history")
TIES = "extract_no DESC, tie1 DESC, tie2 DESC, tie3 DESC, tie4 DESC"
view("ads", latest("raw_ads", "ad_id, date_start, account_id", TIES))
view("ads_latest_json", latest("raw_ads_json", "ad_id, stat_time_day::DATE", TIES))


def metric(name: str, kind: str) -> str:
    return f"(metrics ->> '$.{name}')::{kind}"


view(
    "ad_report",
    f"""
SELECT ad_id, adgroup_id, campaign_id, advertiser_id, stat_time_day::DATE AS report_date,
  {metric('spend', 'DECIMAL(18,2)')} AS spend, {metric('impressions', 'BIGINT')} AS impressions,
  {metric('clicks', 'BIGINT')} AS clicks, {metric('conversion', 'BIGINT')} AS conversions,
  {metric('complete_payment', 'BIGINT')} AS purchases, {metric('cost_per_conversion', 'DOUBLE')} AS cost_per_conversion,
  {metric('cpc', 'DOUBLE')} AS cpc, {metric('cpm', 'DOUBLE')} AS cpm, {metric('ctr', 'DOUBLE')} AS ctr,
  {metric('reach', 'BIGINT')} AS reach
FROM ads_latest_json
""",
)
# Latest report rows with the metrics most reports sum up.
view(
    "ad_metrics",
    f"""
SELECT stat_time_day::DATE AS day, metrics ->> '$.campaign_name' AS campaign_name, metrics ->> '$.ad_name' AS ad_name,
  {metric('spend', 'DECIMAL(18,2)')} AS spend, {metric('impressions', 'BIGINT')} AS impressions,
  {metric('clicks', 'BIGINT')} AS clicks, {metric('conversion', 'BIGINT')} AS conversions,
  {metric('complete_payment', 'BIGINT')} AS purchases, {metric('video_play_actions', 'BIGINT')} AS video_plays,
  {metric('likes', 'BIGINT')} AS likes, {metric('shares', 'BIGINT')} AS shares, {metric('comments', 'BIGINT')} AS comments,
  metrics
FROM ads_latest_json
""",
)

# ------------------------------------------------------------------ unified layer
view(
    "facebook",
    """
SELECT account_id || '_' || date_start || '_' || coalesce(campaign_id, 'unknown') AS fb_row_id,
  account_id AS fb_account_id, account_name AS fb_account_name, campaign_id AS fb_campaign_id,
  campaign_name AS fb_campaign_name, adset_id AS fb_adset_id, adset_name AS fb_adset_name, ad_id AS fb_ad_id,
  ad_name AS fb_ad_name, date_start AS date, date_start, date_stop, spend::DECIMAL(18,2) AS fb_spend,
  impressions AS fb_impressions, clicks AS fb_clicks, reach AS fb_reach,
  clicks::DOUBLE / nullif(impressions, 0) * 100 AS fb_ctr_percent,
  spend::DOUBLE / nullif(clicks, 0) AS fb_cpc, spend::DOUBLE / nullif(impressions, 0) * 1000 AS fb_cpm,
  actions AS fb_actions_json, extract_no AS fb_last_sync_at
FROM ads WHERE date_start IS NOT NULL
""",
)
view(
    "tiktok",
    """
SELECT report_date || '_' || coalesce(campaign_id::VARCHAR, 'unknown') AS tt_row_id, report_date AS date,
  campaign_id AS tt_campaign_id, adgroup_id AS tt_adgroup_id, ad_id AS tt_ad_id, spend AS tt_spend,
  impressions AS tt_impressions, clicks AS tt_clicks, conversions AS tt_conversions,
  clicks::DOUBLE / nullif(impressions, 0) * 100 AS tt_ctr_percent, spend::DOUBLE / nullif(clicks, 0) AS tt_cpc,
  spend::DOUBLE / nullif(impressions, 0) * 1000 AS tt_cpm,
  conversions::DOUBLE / nullif(clicks, 0) * 100 AS tt_conversion_rate, spend::DOUBLE / nullif(conversions, 0) AS tt_cpa
FROM ad_report WHERE report_date IS NOT NULL
""",
)
view(
    "google",
    """
SELECT segments_date || '_' || coalesce(campaign_id::VARCHAR, 'unknown') AS ga_row_id, segments_date AS date,
  campaign_id AS ga_campaign_id, campaign_name AS ga_campaign_name, campaign_status AS ga_campaign_status,
  segments_device AS ga_device, segments_ad_network_type AS ga_network_type, cost AS ga_spend,
  metrics_impressions AS ga_impressions, metrics_clicks AS ga_clicks, metrics_conversions AS ga_conversions,
  metrics_conversions_value AS ga_conversion_value,
  metrics_clicks::DOUBLE / nullif(metrics_impressions, 0) * 100 AS ga_ctr_percent,
  cost / nullif(metrics_clicks, 0) AS ga_cpc, cost / nullif(metrics_impressions, 0) * 1000 AS ga_cpm,
  metrics_conversions::DOUBLE / nullif(metrics_clicks, 0) * 100 AS ga_conversion_rate,
  cost / nullif(metrics_conversions, 0) AS ga_cpa, metrics_conversions_value::DOUBLE / nullif(cost, 0) AS ga_roas,
  metrics_cost_micros
FROM (SELECT *, metrics_cost_micros::DOUBLE / 1000000 AS cost FROM campaign_stats WHERE segments_date IS NOT NULL)
LEFT JOIN campaigns USING (campaign_id)
""",
)
view(
    "amazon",
    """
SELECT date || '_' || campaign_id || CASE report WHEN 'O' THEN '_brand' ELSE '' END AS amz_row_id, date,
  campaign_id AS amz_campaign_id, campaign_name AS amz_campaign_name, impressions AS amz_impressions,
  clicks AS amz_clicks, cost AS amz_spend, conversions AS amz_conversions, sales AS amz_sales,
  clicks::DOUBLE / nullif(impressions, 0) * 100 AS amz_ctr_percent, cost::DOUBLE / nullif(clicks, 0) AS amz_cpc,
  cost::DOUBLE / nullif(impressions, 0) * 1000 AS amz_cpm, sales::DOUBLE / nullif(cost, 0) AS amz_roas,
  cost::DOUBLE / nullif(conversions, 0) AS amz_cpa
FROM sponsored WHERE date IS NOT NULL
""",
)
view(
    "base_orders",
    """
SELECT id AS order_id, id AS order_id_numeric, email_hash AS order_email_hash, created_at::DATE AS order_date,
  CASE WHEN name[1] = '#' THEN name[2:] WHEN name[1:2] = 'X-' THEN split_part(name, '-', 2) ELSE name END
    AS order_number_clean,
  source_name, financial_status, fulfillment_status, name AS order_name, created_at AS order_created_at,
  processed_at AS order_processed_at, cancelled_at AS order_cancelled_at, closed_at AS order_closed_at, cancel_reason,
  tags AS order_tags, currency AS order_currency, landing_site, referring_site, user_id AS shopify_customer_id,
  total_price AS order_value, total_line_items_price AS order_subtotal, current_total_discounts AS order_discounts,
  total_tax AS order_tax, shipping_json AS shipping_info, extracted_at AS order_last_sync_at
FROM clean_orders WHERE created_at IS NOT NULL
""",
)
view(
    "base_customers",
    """
SELECT id AS customer_id, email_hash AS customer_email_hash, state AS customer_state,
  first_name AS customer_first_name, tags AS customer_tags, created_at AS customer_created_at,
  orders_count AS customer_order_count_shopify, verified_email AS customer_email_verified,
  accepts_marketing AS customer_accepts_marketing,
  email_marketing_consent ->> '$.consent_updated_at' AS email_consent_date,
  sms_marketing_consent ->> '$.consent_updated_at' AS sms_consent_date,
  email_marketing_consent ->> '$.state' AS email_consent_status,
  sms_marketing_consent ->> '$.state' AS sms_consent_status,
  total_spent AS customer_lifetime_value_shopify, extracted_at AS customer_last_sync_at
FROM clean_customers
""",
)
view(
    "items_by_order",
    """
SELECT numeric_id AS order_id_numeric, count(*) AS items_count, sum(quantity)::BIGINT AS total_quantity,
  array_to_string(list_sort(list_distinct(list(sku))), ', ') AS skus,
  array_to_string(list_sort(list_distinct(list(title))), ', ') AS product_titles,
  sum(original_total) AS items_total_original
FROM line_items GROUP BY 1
""",
)
view(
    "transactions_by_order",
    """
SELECT order_id AS order_id_numeric, count(*) AS transaction_count,
  string_agg(DISTINCT gateway, ', ' ORDER BY gateway) AS payment_gateways,
  string_agg(DISTINCT status, ', ' ORDER BY status) AS transaction_statuses,
  string_agg(DISTINCT kind, ', ' ORDER BY kind) AS transaction_types,
  sum(amount::DECIMAL(18,2)) AS transactions_total_amount,
  min(created_at) AS first_transaction_at, max(created_at) AS last_transaction_at
FROM transactions GROUP BY 1
""",
)
view(
    "refunds_by_order",
    """
SELECT order_id AS order_id_numeric, count(*) AS refund_count,
  sum((transactions_json ->> '$[0].amount')::DECIMAL(18,2)) AS refunds_total_amount, max(created_at) AS last_refund_at
FROM refunds GROUP BY 1
""",
)
view(
    "utm_by_order",
    """
SELECT numeric_id AS order_id_numeric, sales_channel, sales_channel_name, attribution_status, first_utm_source,
  first_utm_medium, first_utm_campaign, first_utm_content, first_utm_term, first_landing_page, first_referrer_url,
  first_visit_at, last_utm_source, last_utm_medium, last_utm_campaign, last_landing_page, last_visit_at,
  customer_order_index, days_to_conversion, extracted_at AS utm_extracted_at
FROM utm
""",
)
view(
    "shop",
    """
SELECT o.*, c.* EXCLUDE (customer_email_hash, customer_last_sync_at),
  coalesce(i.items_count, 0) AS items_count, i.total_quantity, i.skus, i.product_titles, i.items_total_original,
  t.* EXCLUDE (order_id_numeric, transaction_types), u.* EXCLUDE (order_id_numeric, utm_extracted_at),
  r.* EXCLUDE (order_id_numeric),
  o.order_cancelled_at IS NOT NULL AS is_cancelled, coalesce(r.refund_count > 0, false) AS has_refund,
  o.order_value - coalesce(o.order_discounts, 0) - coalesce(r.refunds_total_amount, 0) AS order_net_value,
  coalesce(u.first_utm_source, o.source_name, 'direct') AS attribution_channel
FROM base_orders o
LEFT JOIN base_customers c ON c.customer_email_hash = o.order_email_hash
LEFT JOIN items_by_order i USING (order_id_numeric) LEFT JOIN transactions_by_order t USING (order_id_numeric)
LEFT JOIN utm_by_order u USING (order_id_numeric) LEFT JOIN refunds_by_order r USING (order_id_numeric)
""",
)
view(
    "shop_days",
    """
SELECT order_date AS date, attribution_channel, first_utm_source, count(*) AS orders, sum(order_value) AS revenue,
  sum(order_net_value) AS net_revenue, count(DISTINCT customer_id) AS unique_customers
FROM shop WHERE order_date IS NOT NULL GROUP BY ALL
""",
)
view(
    "ad_days",
    """
SELECT date, ad_source, sum(spend) AS spend, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks
FROM (SELECT date, 'facebook' AS ad_source, fb_spend AS spend, fb_impressions AS impressions, fb_clicks AS clicks
      FROM facebook
      UNION ALL SELECT date, 'tiktok', tt_spend, tt_impressions, tt_clicks FROM tiktok)
GROUP BY ALL
""",
)
view(
    "marketing",
    """
SELECT *, revenue::DOUBLE / nullif(ad_spend::DOUBLE, 0) AS roas, ad_spend::DOUBLE / nullif(orders, 0) AS cpa,
  revenue::DOUBLE / nullif(orders, 0) AS avg_order_value, ad_clicks::DOUBLE / nullif(ad_impressions, 0) * 100
    AS ctr_percent, orders::DOUBLE / nullif(ad_clicks, 0) * 100 AS conversion_rate
FROM (
  SELECT coalesce(s.date, a.date) || '_' || coalesce(attribution_channel, ad_source, 'unknown') AS row_id,
    coalesce(s.date, a.date) AS date, coalesce(attribution_channel, ad_source, 'organic') AS channel,
    first_utm_source AS utm_source, coalesce(orders, 0) AS orders, coalesce(revenue, 0) AS revenue,
    coalesce(net_revenue, 0) AS net_revenue, coalesce(unique_customers, 0) AS unique_customers,
    coalesce(spend, 0) AS ad_spend, coalesce(impressions, 0) AS ad_impressions, coalesce(clicks, 0) AS ad_clicks
  FROM shop_days s FULL JOIN ad_days a ON s.date = a.date AND lower(attribution_channel) = lower(ad_source))
""",
)

# -------------------------------------------------------------------- report layer
view(
    "daily_metrics",
    """
SELECT order_date AS date, count(DISTINCT order_id) AS orders, sum(order_value)::DOUBLE AS gross_revenue,
  sum(order_net_value)::DOUBLE AS net_revenue, sum(order_value)::DOUBLE / count(order_value) AS aov,
  sum(order_discounts)::DOUBLE AS total_discounts, sum(order_tax)::DOUBLE AS total_tax,
  count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT customer_id) FILTER (customer_order_count_shopify > 1) AS returning_customers,
  count(DISTINCT customer_id) FILTER (customer_order_count_shopify > 1)::DOUBLE
    / nullif(count(DISTINCT customer_id), 0) * 100 AS returning_customer_pct,
  sum(items_count)::BIGINT AS total_items, sum(total_quantity)::BIGINT AS total_units,
  sum(items_count)::DOUBLE / count(items_count) AS avg_items_per_order,
  count(DISTINCT order_id) FILTER (first_utm_source = 'facebook') AS facebook_orders,
  count(DISTINCT order_id) FILTER (first_utm_source = 'google') AS google_orders,
  count(DISTINCT order_id) FILTER (first_utm_source = 'tiktok') AS tiktok_orders,
  count(DISTINCT order_id) FILTER (first_utm_source IS NULL) AS direct_orders,
  count(DISTINCT order_id) FILTER (is_cancelled) AS cancelled_orders,
  count(DISTINCT order_id) FILTER (has_refund) AS refunded_orders,
  sum(CASE WHEN has_refund THEN refunds_total_amount ELSE 0 END)::DOUBLE AS total_refund_amount,
  sum(transaction_count)::DOUBLE / nullif(count(transaction_count), 0) AS avg_transactions_per_order,
  sum(transactions_total_amount)::DOUBLE AS total_transaction_amount
FROM shop WHERE order_date IS NOT NULL GROUP BY 1
""",
)
view(
    "monthly",
    """
SELECT date_trunc('month', date)::DATE AS month, channel, sum(ad_spend)::DOUBLE AS total_spend,
  sum(ad_spend)::DOUBLE / count(*) AS avg_daily_spend, sum(revenue)::DOUBLE AS total_revenue,
  sum(net_revenue)::DOUBLE AS total_net_revenue, sum(revenue)::DOUBLE / count(*) AS avg_daily_revenue,
  sum(orders)::BIGINT AS total_orders, sum(orders)::DOUBLE / count(*) AS avg_daily_orders,
  sum(unique_customers)::BIGINT AS total_customers, sum(ad_impressions)::BIGINT AS total_impressions,
  sum(ad_clicks)::BIGINT AS total_clicks, round(avg(ctr_percent), 10) AS avg_ctr,
  sum(revenue)::DOUBLE / nullif(sum(ad_spend)::DOUBLE, 0) AS roas, sum(ad_spend)::DOUBLE / nullif(sum(orders), 0) AS cpa,
  sum(revenue)::DOUBLE / nullif(sum(orders), 0) AS aov,
  sum(net_revenue)::DOUBLE / nullif(sum(ad_spend)::DOUBLE, 0) AS mer,
  sum(ad_spend)::DOUBLE / nullif(sum(revenue)::DOUBLE, 0) * 100 AS marketing_pct_of_revenue,
  (sum(revenue) - sum(ad_spend))::DOUBLE AS contribution_margin,
  (sum(revenue) - sum(ad_spend))::DOUBLE / nullif(sum(revenue)::DOUBLE, 0) * 100 AS contribution_margin_pct
FROM marketing WHERE date IS NOT NULL GROUP BY 1, 2
""",
)
view(
    "products_monthly",
    """
SELECT date_trunc('month', order_date)::DATE AS month, product_titles AS product_name,
  sum(orders)::BIGINT AS total_orders, sum(units)::BIGINT AS total_units, sum(gross)::DOUBLE AS gross_revenue,
  sum(net)::DOUBLE AS net_revenue, round(avg(price), 10) AS avg_price, sum(net)::DOUBLE / nullif(sum(units), 0)
    AS revenue_per_unit
FROM (SELECT product_titles, order_date, count(DISTINCT order_id) AS orders, sum(total_quantity) AS units,
        sum(items_total_original) AS gross, sum(items_total_original - coalesce(order_discounts, 0)) AS net,
        avg(items_total_original::DOUBLE / nullif(total_quantity, 0)) AS price
      FROM shop WHERE product_titles <> '' GROUP BY 1, 2)
GROUP BY 1, 2
""",
)
view(
    "months",
    """
SELECT date_trunc('month', date)::DATE AS month, sum(revenue)::DOUBLE AS gross_revenue,
  sum(net_revenue)::DOUBLE AS net_revenue, sum(ad_spend)::DOUBLE AS marketing_spend, sum(orders)::BIGINT AS orders,
  sum(unique_customers)::BIGINT AS customers, round(avg(avg_order_value), 10) AS aov,
  sum(revenue)::DOUBLE / nullif(sum(ad_spend)::DOUBLE, 0) AS roas, sum(ad_spend)::DOUBLE / nullif(sum(orders), 0) AS cpa,
  (sum(net_revenue) - sum(ad_spend))::DOUBLE AS pre_marketing_contribution,
  sum(ad_spend)::DOUBLE / nullif(sum(net_revenue)::DOUBLE, 0) * 100 AS marketing_pct
FROM marketing GROUP BY 1
""",
)
view(
    "executive",
    """
SELECT m.*, l.gross_revenue AS ly_gross_revenue, l.net_revenue AS ly_net_revenue,
  l.marketing_spend AS ly_marketing_spend, l.orders AS ly_orders, l.customers AS ly_customers,
  (m.gross_revenue - l.gross_revenue) / nullif(l.gross_revenue, 0) * 100 AS gross_revenue_yoy,
  (m.net_revenue - l.net_revenue) / nullif(l.net_revenue, 0) * 100 AS net_revenue_yoy,
  (m.marketing_spend - l.marketing_spend) / nullif(l.marketing_spend, 0) * 100 AS marketing_spend_yoy,
  (m.orders - l.orders)::DOUBLE / nullif(l.orders, 0) * 100 AS orders_yoy,
  (m.roas - l.roas) / nullif(l.roas, 0) * 100 AS roas_yoy
FROM months m LEFT JOIN months l ON m.month = l.month + INTERVAL 1 YEAR
""",
)
view(
    "channel_mix",
    """
SELECT channel, sum(ad_spend)::DOUBLE AS total_spend, sum(revenue)::DOUBLE AS total_revenue,
  sum(orders)::BIGINT AS total_orders, sum(revenue)::DOUBLE / nullif(sum(ad_spend)::DOUBLE, 0) AS roas,
  sum(ad_spend)::DOUBLE / nullif((sum(sum(ad_spend)) OVER ())::DOUBLE, 0) * 100 AS spend_share_pct,
  sum(revenue)::DOUBLE / nullif((sum(sum(revenue)) OVER ())::DOUBLE, 0) * 100 AS revenue_share_pct
FROM marketing WHERE date >= DATE '2001-08-01' - INTERVAL 30 DAY GROUP BY channel
""",
)

# ------------------------------------------------------------- PII reference layer
REFS = {
    "ref_email": (
        "email_hash",
        [("clean_customers", "email_hash", "shopify_customers"), ("clean_orders", "email_hash", "shopify_orders")],
    ),
    "ref_phone": (
        "phone_hash",
        [("clean_customers", "phone_hash", "shopify_customers"), ("clean_orders", "phone_hash", "shopify_orders")],
    ),
    "ref_first_name": ("first_name_hash", [("clean_customers", "first_name_hash", "shopify_customers")]),
    "ref_last_name": ("last_name_hash", [("clean_customers", "last_name_hash", "shopify_customers")]),
    "ref_address": (
        "address_hash",
        [
            ("clean_customers", "addresses_hash", "shopify_customers_addresses"),
            ("clean_customers", "default_address_hash", "shopify_customers_default_address"),
        ],
    ),
    "ref_ip": ("ip", [("clean_orders", "browser_ip", "shopify_orders")]),
}
for _name, (_base, _sources) in REFS.items():
    _hash = "ip_hash_consistent" if _base == "ip" else f"{_base}_consistent"
    _rows = " UNION ALL ".join(f"SELECT {c} AS v, '{s}' AS source FROM {t} WHERE {c} <> ''" for t, c, s in _sources)
    view(
        _name,
        f"SELECT v AS {_base}_original, sha256(v) AS {_hash}, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources,"
        f" count(DISTINCT source) AS source_count FROM ({_rows}) GROUP BY v",
    )
view(
    "ref_master",
    " UNION ALL ".join(
        f"SELECT '{n[4:]}' AS pii_field, {b}_original AS original_value, "
        f"{'ip_hash_consistent' if b == 'ip' else b + '_consistent'} AS consistent_hash, sources, source_count FROM {n}"
        for n, (b, _) in REFS.items()
    ),
)
view(
    "items_all",
    """
SELECT numeric_id AS order_id_numeric, count(*) AS items_count, string_agg(title, ', ' ORDER BY title) AS product_titles,
  string_agg(sku, ', ' ORDER BY sku) AS product_skus, sum(quantity)::BIGINT AS total_quantity
FROM line_items GROUP BY 1
""",
)
view(
    "utm_params",
    """
SELECT numeric_id AS order_id_numeric, landing_site_ref_params AS utm_params_raw,
  nullif(regexp_extract(landing_site_ref_params, 'utm_source=([^&]+)', 1), '') AS utm_source,
  nullif(regexp_extract(landing_site_ref_params, 'utm_medium=([^&]+)', 1), '') AS utm_medium,
  nullif(regexp_extract(landing_site_ref_params, 'utm_campaign=([^&]+)', 1), '') AS utm_campaign,
  nullif(regexp_extract(landing_site_ref_params, 'utm_content=([^&]+)', 1), '') AS utm_content,
  nullif(regexp_extract(landing_site_ref_params, 'utm_term=([^&]+)', 1), '') AS utm_term
FROM utm
""",
)
view(
    "shop_consistent",
    """
SELECT o.* REPLACE (coalesce(po.email_hash_consistent, o.order_email_hash) AS order_email_hash),
  coalesce(pc.email_hash_consistent, c.customer_email_hash) AS customer_email_hash, c.customer_id, c.customer_state,
  c.customer_first_name, c.customer_tags, c.customer_created_at, c.customer_order_count_shopify,
  c.customer_lifetime_value_shopify AS customer_total_spent, c.customer_email_verified, c.customer_accepts_marketing,
  c.customer_last_sync_at, coalesce(i.items_count, 0) AS items_count, i.product_titles, i.product_skus,
  coalesce(i.total_quantity, 0) AS total_quantity, coalesce(t.transaction_count, 0) AS transaction_count,
  t.transaction_types, t.payment_gateways, t.transaction_statuses, u.* EXCLUDE (order_id_numeric),
  coalesce(r.refund_count, 0) AS refund_count, coalesce(r.refunds_total_amount, 0) AS refunds_total_amount,
  r.last_refund_at, o.order_value - coalesce(r.refunds_total_amount, 0) AS net_revenue
FROM base_orders o LEFT JOIN base_customers c ON c.customer_email_hash = o.order_email_hash
LEFT JOIN ref_email po ON po.email_hash_original = o.order_email_hash
LEFT JOIN ref_email pc ON pc.email_hash_original = c.customer_email_hash
LEFT JOIN items_all i USING (order_id_numeric) LEFT JOIN transactions_by_order t USING (order_id_numeric)
LEFT JOIN utm_params u USING (order_id_numeric) LEFT JOIN refunds_by_order r USING (order_id_numeric)
""",
)

# ------------------------------------------------------------------ reconciliation
view(
    "api_daily",
    """
SELECT account_id, campaign_id, date_start,
  sum((spend::DECIMAL(18,2) * CASE campaign_id WHEN '1' THEN 1.01 WHEN '2' THEN 1.05 ELSE 1.00 END)::DECIMAL(18,2))
    ::VARCHAR AS spend,
  sum(impressions)::BIGINT::VARCHAR AS impressions, CASE WHEN sum(clicks) > 0 THEN sum(clicks)::BIGINT::VARCHAR END
    AS clicks
FROM ads WHERE campaign_id <> '3' GROUP BY 1, 2, 3
""",
)
