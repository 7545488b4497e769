"""Personal data: hashing, nullifying, masking, references, restore; and the checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.functions import EMPTY_SHA256, hash_pii
from martlet.operators import hash_checks, pii, unify
from workload.oracle_views import REFS, hashed
from workload.registry import query

# ------------------------------------------------------------------------------ hash
query(
    "hash_pii",
    lambda x: x.raw_customers.select("id", "extracted_at", hash_pii("email").alias("email_hash")),
    """
SELECT id, extracted_at, CASE WHEN email IS NULL OR email = '' THEN NULL ELSE sha256(lower(trim(email))) END
  AS email_hash FROM raw_customers
""",
)


def half_hashed(x):
    """Raw orders part way through the job: earlier rows are hashed, later ones wait."""
    done = F.col("created_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    return x.raw_orders.withColumn("email_hash", F.when(done, hash_pii("email")))


HALF = f"SELECT *, CASE WHEN created_at < TIMESTAMP '1999-01-01' THEN {hashed('email')} END AS email_hash FROM raw_orders"

query(
    "hash_missing",
    lambda x: pii.hash_missing(half_hashed(x), "email", "email_hash").select("id", "extracted_at", "email_hash"),
    f"SELECT id, extracted_at, coalesce(email_hash, {hashed('email')}) AS email_hash FROM ({HALF})",
)
query(
    "ensure_column",
    lambda x: pii.ensure_column(x.order_history.select("id", "name"), "email_hash"),
    "SELECT id, name, NULL::VARCHAR AS email_hash FROM order_history",
)
query(
    "nullify_preflight",
    lambda x: pii.nullify_preflight(
        {
            "order_history": (x.hashed_history, "customer_email"),
            "raw_orders": (half_hashed(x), "email"),
            "raw_customers": (x.hashed_customers, "email"),
        }
    ),
    f"""
SELECT 'order_history' AS table_name, count(customer_email) AS emails_to_nullify,
  count(*) FILTER (customer_email <> '' AND email_hash IS NULL) AS would_lose_data FROM hashed_history
UNION ALL SELECT 'raw_orders', count(email), count(*) FILTER (email <> '' AND email_hash IS NULL) FROM ({HALF})
UNION ALL SELECT 'raw_customers', count(email), count(*) FILTER (email <> '' AND email_hash IS NULL) FROM hashed_customers
""",
)
query(
    "nullify_pii",
    lambda x: pii.nullify_pii(half_hashed(x), ["email", "contact_email", "phone"], "email_hash").select(
        "id", "extracted_at", "email", "contact_email", "phone", "email_hash"
    ),
    f"""
SELECT id, extracted_at, if(email_hash IS NULL, email, NULL) AS email,
  if(email_hash IS NULL, contact_email, NULL) AS contact_email, if(email_hash IS NULL, phone, NULL) AS phone, email_hash
FROM ({HALF})
""",
)
query(
    "hash_struct",
    lambda x: pii.hash_columns(
        x.raw_customers, {"addresses": "addresses_hash", "default_address": "default_address_hash"}, ["id", "extracted_at"]
    ),
    """
SELECT id, extracted_at, sha256(addresses) AS addresses_hash, sha256(default_address) AS default_address_hash
FROM raw_customers
""",
)
query(
    "drop_pii",
    lambda x: pii.drop_pii(x.order_history, ["customer_email", "customer_first_name", "customer_last_name", "absent"]),
    """
SELECT * EXCLUDE (customer_email, customer_first_name, customer_last_name)
  REPLACE (total_price::DOUBLE AS total_price) FROM order_history
""",
)

# -------------------------------------------------------------------------- preserve


def emails_lost(x):
    """A re-extract in which one order in seven no longer has its email."""
    gone = F.col("id") % 7 == 0
    raw = x.raw_orders.withColumn("email", F.when(~gone, F.col("email")))
    return pii.clean_orders(raw)


def names_lost(x):
    raw = x.raw_customers.withColumns(
        {
            "email": F.when(F.col("id") % 7 != 0, F.col("email")),
            "addresses": F.when(F.col("id") % 3 != 0, F.col("addresses")),
        }
    )
    return pii.clean_customers(raw)


query(
    "preserve_hashes",
    lambda x: pii.preserve_order_hashes(emails_lost(x), x.clean_orders).select("id", "email_hash", "phone_hash"),
    "SELECT id, email_hash, phone_hash FROM clean_orders",
)
query(
    "preserve_hashes_customers",
    lambda x: pii.preserve_customer_hashes(names_lost(x), x.clean_customers).select("id", *pii.CUSTOMER_HASHES),
    """
SELECT id, email_hash, phone_hash, last_name_hash, first_name_hash, default_address_hash,
  CASE WHEN id % 3 <> 0 OR id % 7 = 0 OR email_hash IS NULL OR phone_hash IS NULL OR first_name_hash IS NULL
    THEN addresses_hash END AS addresses_hash
FROM clean_customers
""",
)


def older_lost(x):
    """A backup in which older orders have another id."""
    kept = F.col("created_at") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return x.order_history.withColumn("id", F.when(kept, F.col("id")).otherwise(-F.col("id") - 1))


query(
    "restore_pii",
    lambda x: pii.restore_pii(
        pii.nullify_pii(x.hashed_history, ["customer_email", "customer_first_name"], "email_hash"),
        older_lost(x),
        "id",
        ["customer_email", "customer_first_name"],
    ).select("id", "customer_email", "customer_first_name", "email_hash"),
    """
SELECT id, CASE WHEN created_at >= TIMESTAMP '1998-01-01' OR email_hash IS NULL THEN customer_email END AS customer_email,
  CASE WHEN created_at >= TIMESTAMP '1998-01-01' OR email_hash IS NULL THEN customer_first_name END
    AS customer_first_name, email_hash
FROM hashed_history
""",
)

# ------------------------------------------------------------------------------ mask
query(
    "anon_orders",
    lambda x: pii.anon_orders(x.order_history),
    """
SELECT id, name, created_at, currency_code, total_price::DOUBLE AS total_price,
  sha256(ifnull(customer_id, '')) AS customer_id_hash, sha256(lower(ifnull(customer_email, ''))) AS customer_email_hash,
  left(customer_first_name, 1) || '***' AS customer_first_name_masked,
  left(customer_last_name, 1) || '***' AS customer_last_name_masked, shipping_country, shipping_city, shipping_zip
FROM order_history
""",
)
query(
    "anon_customers",
    lambda x: pii.anon_customers(x.raw_customers),
    """
SELECT id, created_at, updated_at, orders_count, total_spent::DOUBLE AS total_spent,
  sha256(lower(ifnull(email, ''))) AS email_hash, left(first_name, 1) || '***' AS first_name_masked,
  left(last_name, 1) || '***' AS last_name_masked, state, tags, accepts_marketing, verified_email FROM raw_customers
""",
)
query(
    "anon_live_orders",
    lambda x: pii.anon_live_orders(x.raw_orders),
    """
SELECT id, name, created_at, processed_at, currency, financial_status, fulfillment_status,
  total_price::DOUBLE AS total_price, total_tax::DOUBLE AS total_tax, sha256(lower(ifnull(email, ''))) AS email_hash,
  source_name, landing_site, referring_site, tags, shipping_address ->> '$.country' AS shipping_country,
  shipping_address ->> '$.city' AS shipping_city, shipping_address ->> '$.province' AS shipping_province FROM raw_orders
""",
)
query(
    "customer_id_mapping",
    lambda x: pii.customer_id_mapping(x.order_history),
    """
SELECT DISTINCT email_hash, sha256(customer_id) AS customer_id_hash FROM hashed_history WHERE email_hash IS NOT NULL
""",
)

# ------------------------------------------------------------------- reference tables
query("pii_ref_email", lambda x: x.email_refs, "SELECT * FROM ref_email")
query("pii_ref_phone", lambda x: pii.ref_phone(x.clean_customers, x.clean_orders), "SELECT * FROM ref_phone")
query("pii_ref_first_name", lambda x: pii.ref_first_name(x.clean_customers), "SELECT * FROM ref_first_name")
query("pii_ref_last_name", lambda x: pii.ref_last_name(x.clean_customers), "SELECT * FROM ref_last_name")
query("pii_ref_address", lambda x: pii.ref_address(x.clean_customers), "SELECT * FROM ref_address")
query("pii_ref_ip", lambda x: pii.ref_ip(x.clean_orders), "SELECT * FROM ref_ip")


def master(x):
    return pii.master_reference(x.clean_customers, x.clean_orders)


query("pii_master_reference", master, "SELECT * FROM ref_master")
# Every hash has a reference row, so the looked-up value is the second hash of the first.
query(
    "apply_pii_refs",
    lambda x: pii.apply_references(x.clean_orders, x.clean_customers, master(x)),
    """
SELECT o.id, sha256(o.email_hash) AS order_email_hash, sha256(o.phone_hash) AS order_phone_hash,
  sha256(c.first_name_hash) AS customer_first_name_hash, sha256(c.last_name_hash) AS customer_last_name_hash,
  sha256(o.browser_ip) AS browser_ip_hash
FROM clean_orders o LEFT JOIN clean_customers c ON c.id = o.user_id
""",
)
query(
    "customer_profile",
    lambda x: pii.customer_profile(x.clean_customers, master(x)),
    """
SELECT id AS customer_id, e.email_hash_consistent AS email_hash, p.phone_hash_consistent AS phone_hash,
  f.first_name_hash_consistent AS first_name_hash, l.last_name_hash_consistent AS last_name_hash,
  a.address_hash_consistent AS address_hash, if(email_hash IS NULL, 'No', 'Has') || ' Email' AS email_status,
  if(c.phone_hash IS NULL, 'No', 'Has') || ' Phone' AS phone_status,
  if(c.addresses_hash IS NULL, 'No', 'Has') || ' Address' AS address_status,
  len(list_filter([c.email_hash, c.phone_hash, c.first_name_hash, c.last_name_hash, c.addresses_hash],
    lambda v: v IS NOT NULL)) AS profile_completeness_score
FROM clean_customers c LEFT JOIN ref_email e ON e.email_hash_original = c.email_hash
LEFT JOIN ref_phone p ON p.phone_hash_original = c.phone_hash
LEFT JOIN ref_first_name f ON f.first_name_hash_original = c.first_name_hash
LEFT JOIN ref_last_name l ON l.last_name_hash_original = c.last_name_hash
LEFT JOIN ref_address a ON a.address_hash_original = c.addresses_hash
""".replace("if(email_hash IS NULL", "if(c.email_hash IS NULL"),
)
query(
    "fraud_by_ip",
    lambda x: pii.fraud_by_ip(x.clean_orders),
    """
SELECT *, CASE WHEN unique_emails > 5 AND unique_phones > 5 THEN 'High Risk - Many accounts from same IP'
  WHEN unique_emails > 3 THEN 'Medium Risk - Multiple accounts' ELSE 'Normal' END AS fraud_risk
FROM (SELECT ip_hash_consistent, count(DISTINCT email_hash) AS unique_emails, count(DISTINCT phone_hash)
    AS unique_phones, count(*) AS order_count
  FROM clean_orders LEFT JOIN ref_ip ON ip_original = browser_ip WHERE browser_ip IS NOT NULL GROUP BY 1)
WHERE unique_emails > 1 OR unique_phones > 1
""",
)

# ---------------------------------------------------------------------------- audits
query(
    "pii_exposure",
    lambda x: pii.standard_exposure(x.raw_orders, x.raw_customers, x.clean_orders, x.clean_customers),
    """
SELECT *, if(exposed = 0, 'PASS', 'FAIL') AS status FROM (
  SELECT ifnull(t, 'OVERALL') AS table_name, ifnull(f, 'all') AS pii_field, sum(bad)::BIGINT AS exposed,
    count(*) AS total_rows
  FROM (
    SELECT 'orders' AS t, unnest(['email','contact_email','phone','browser_ip','customer_json']) AS f,
      unnest([ifnull(contains(email, '@'), false)::INT, ifnull(contains(contact_email, '@'), false)::INT,
        ifnull(length(phone) > 3, false)::INT, ifnull(browser_ip <> '', false)::INT,
        ifnull(contains(customer ->> '$.email', '@'), false)::INT]) AS bad FROM raw_orders
    UNION ALL
    SELECT 'customers', unnest(['email','phone','first_name','last_name']),
      unnest([ifnull(contains(email, '@'), false)::INT, ifnull(length(phone) > 3, false)::INT,
        ifnull(first_name <> '', false)::INT, ifnull(last_name <> '', false)::INT]) FROM raw_customers
    UNION ALL
    SELECT 'orders_clean', unnest(['customer_email_in_json','customer_name_in_json']),
      unnest([ifnull(contains(customer ->> '$.email', '@'), false)::INT,
        ifnull((customer ->> '$.first_name') <> '', false)::INT]) FROM clean_orders
    UNION ALL
    SELECT 'customers_clean', 'first_name', ifnull(first_name <> '', false)::INT FROM clean_customers
  ) GROUP BY GROUPING SETS ((t, f), ()))
""",
)
query(
    "pii_exposure_documents",
    lambda x: pii.pii_exposure({"documents": (x.table("documents"), {"text": pii.looks_like_email("text")})}),
    """
SELECT unnest(['documents', 'OVERALL']) AS table_name, unnest(['text', 'all']) AS pii_field, exposed, total_rows,
  if(exposed = 0, 'PASS', 'FAIL') AS status
FROM (SELECT count(*) FILTER (contains(text, '@')) AS exposed, count(*) AS total_rows FROM documents)
""",
)
query(
    "pii_non_null_audit",
    lambda x: pii.pii_non_null_audit(
        {
            "raw_orders": (x.raw_orders, ["email", "phone"]),
            "raw_customers": (x.raw_customers, ["email", "phone", "first_name", "last_name"]),
        }
    ),
    """
SELECT t AS table_name, f AS pii_field, count(v) AS non_null_count, count(*) AS total_rows,
  count(v)::DOUBLE / count(*) * 100 AS pii_exposure_pct
FROM (SELECT 'raw_orders' AS t, unnest(['email','phone']) AS f, unnest([email, phone]) AS v FROM raw_orders
  UNION ALL SELECT 'raw_customers', unnest(['email','phone','first_name','last_name']),
    unnest([email, phone, first_name, last_name]) FROM raw_customers)
GROUP BY 1, 2
""",
)
SCANNED = {
    "raw_orders": {"email": "email", "phone": "phone", "shipping_address": "json_address", "nickname": "name"},
    "raw_customers": {"email": "email", "first_name": "name", "last_name": "name"},
}
SCAN_SQL = """
SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS pii_type, count({c}) AS rows_with_data,
  array_to_string(list_sort(list(left({c}, 30)) FILTER ({c} <> ''))[:3], ' | ') AS samples FROM {t}
"""
query(
    "pii_column_scan",
    lambda x: pii.pii_column_scan({"raw_orders": x.raw_orders, "raw_customers": x.raw_customers}, SCANNED),
    " UNION ALL ".join(
        SCAN_SQL.format(t=t, c=c, k=k) for t, cols in SCANNED.items() for c, k in cols.items() if c != "nickname"
    ),
)

# ---------------------------------------------------------------------- hash checks


def clean_tables(x):
    return {"orders_clean": x.clean_orders, "customers_clean": x.clean_customers}


BOTH = (
    "(SELECT 'orders_clean' AS table_name, email_hash AS h FROM clean_orders "
    "UNION ALL SELECT 'customers_clean', email_hash FROM clean_customers)"
)
query(
    "hash_format",
    lambda x: hash_checks.hash_format(clean_tables(x)),
    f"""
SELECT *, CASE WHEN wrong > 0 THEN 'FAIL' WHEN missing < total * 0.01 THEN 'PASS' ELSE 'WARNING' END AS status
FROM (SELECT table_name, count(*) AS total, count(*) FILTER (length(h) = 64) AS correct,
  count(*) FILTER (h <> '' AND length(h) <> 64) AS wrong, count(*) FILTER (coalesce(h, '') = '') AS missing
  FROM {BOTH} GROUP BY 1)
""",
)
query(
    "hash_match_rate",
    lambda x: hash_checks.hash_match_rate(x.clean_orders, x.clean_customers),
    f"""
SELECT *, CASE WHEN match_rate >= 70 THEN 'PASS' WHEN match_rate >= 50 THEN 'WARNING' ELSE 'FAIL' END AS status
FROM (SELECT len(o) AS order_hashes, len(c) AS customer_hashes, len(list_intersect(o, c)) AS matched,
    len(list_intersect(o, c))::DOUBLE / len(o) * 100 AS match_rate
  FROM (SELECT (SELECT list(DISTINCT email_hash) FILTER (email_hash <> '{EMPTY_SHA256}') FROM clean_orders) AS o,
    (SELECT list(DISTINCT email_hash) FILTER (email_hash <> '{EMPTY_SHA256}') FROM clean_customers) AS c))
""",
)
query(
    "hash_normalisation_test",
    lambda x: hash_checks.hash_normalisation(x.raw_customers),
    """
SELECT count(*) AS values_tested, count(*) AS equal_hashes, 0 AS different_hashes, 'PASS' AS result
FROM raw_customers WHERE email <> ''
""",
)
query(
    "cross_table_hash_consistency",
    lambda x: hash_checks.cross_table_consistency(half_hashed(x), x.hashed_customers),
    f"""
SELECT count(DISTINCT oe) AS total_common_emails, count(*) FILTER (oh = ch) AS matching_hashes,
  count(*) FILTER (oh IS DISTINCT FROM ch) AS mismatched_hashes,
  if(count(*) FILTER (oh IS DISTINCT FROM ch) = 0, 'PASS', 'FAIL') AS test_result
FROM (SELECT DISTINCT email, email_hash AS oh, lower(trim(email)) AS oe FROM ({HALF}) WHERE email <> '')
JOIN (SELECT DISTINCT email, email_hash AS ch, lower(trim(email)) AS ce FROM hashed_customers WHERE email <> '')
  ON oe = ce
""",
)
query(
    "cross_table_hash_list",
    lambda x: hash_checks.cross_table_list(x.hashed_orders, x.hashed_customers),
    """
SELECT oe AS email, min(oh) AS order_hash, min(ch) AS customer_hash,
  CASE WHEN min(oh) = min(ch) THEN 'MATCH' ELSE 'MISMATCH' END AS status
FROM (SELECT DISTINCT lower(trim(email)) AS oe, email_hash AS oh FROM hashed_orders WHERE email <> '')
JOIN (SELECT DISTINCT lower(trim(email)) AS ce, email_hash AS ch FROM hashed_customers WHERE email <> '') ON oe = ce
GROUP BY 1 ORDER BY 1 LIMIT 20
""",
)
query(
    "hash_overlap",
    lambda x: hash_checks.hash_overlap(x.raw_orders, x.raw_customers),
    """
SELECT (SELECT count(DISTINCT email_hash) FROM hashed_orders) AS unique_orders_emails,
  (SELECT count(DISTINCT email_hash) FROM hashed_customers) AS unique_customers_emails,
  (SELECT count(*) FROM (SELECT email_hash FROM hashed_orders WHERE email_hash IS NOT NULL
    INTERSECT SELECT email_hash FROM hashed_customers)) AS matching_emails_across_tables
""",
)


def masked_tables(x):
    """Masked views hash a missing email as '', which is what the empty-hash check looks for."""
    return {
        "orders_anon": pii.anon_live_orders(x.raw_orders),
        "customers_anon": pii.anon_customers(x.raw_customers),
    }


query(
    "empty_hash_rate",
    lambda x: hash_checks.empty_hash_rate(masked_tables(x)),
    """
SELECT table_name, empty_hash_count, total_count, empty_hash_count::DOUBLE / total_count * 100 AS pct_empty,
  if(empty_hash_count < total_count * 0.05, 'PASS', 'WARNING - high empty rate') AS result
FROM (SELECT 'orders_anon' AS table_name, count(*) FILTER (ifnull(email, '') = '') AS empty_hash_count,
    count(*) AS total_count FROM raw_orders
  UNION ALL SELECT 'customers_anon', count(*) FILTER (ifnull(email, '') = ''), count(*) FROM raw_customers)
""",
)
query(
    "hash_coverage",
    lambda x: hash_checks.hash_coverage(clean_tables(x)),
    f"""
SELECT *, has_hash::DOUBLE / total_rows * 100 AS pct_coverage,
  if(has_hash > total_rows * 0.95, 'PASS', 'FAIL - low coverage') AS result
FROM (SELECT table_name, count(*) AS total_rows, count(h) AS has_hash FROM {BOTH} GROUP BY 1)
""",
)
query(
    "hash_coverage_detail",
    lambda x: hash_checks.hash_coverage_detail(
        {
            "raw_orders": (half_hashed(x), "email"),
            "raw_customers": (x.hashed_customers, "email"),
            "order_history": (x.hashed_history, "customer_email"),
        }
    ),
    f"""
SELECT table_name, count(*) AS total_rows, count(e) AS rows_with_email, count(h) AS rows_with_hash,
  count(*) FILTER (e IS NOT NULL AND h IS NULL) AS unhashed_emails,
  count(*) FILTER (e IS NULL AND h IS NOT NULL) AS hash_without_email,
  count(*) FILTER (e IS NOT NULL AND h IS NOT NULL)::DOUBLE / count(e) * 100 AS pct_hashed
FROM (SELECT 'raw_orders' AS table_name, nullif(email, '') AS e, email_hash AS h FROM ({HALF})
  UNION ALL SELECT 'raw_customers', nullif(email, ''), email_hash FROM hashed_customers
  UNION ALL SELECT 'order_history', nullif(customer_email, ''), email_hash FROM hashed_history)
GROUP BY 1
""",
)
query(
    "unhashed_emails",
    lambda x: hash_checks.unhashed_emails(half_hashed(x), "raw_orders"),
    f"""
SELECT 'raw_orders' AS table_name, id, email, created_at FROM ({HALF})
WHERE email <> '' AND email_hash IS NULL ORDER BY id, extracted_at LIMIT 10
""",
)
query(
    "unique_email_vs_hash",
    lambda x: hash_checks.unique_email_vs_hash({"raw_orders": x.hashed_orders, "raw_customers": x.hashed_customers}),
    """
SELECT 'raw_orders' AS table_name, count(DISTINCT lower(trim(email))) AS unique_emails,
  count(DISTINCT email_hash) AS unique_hashes FROM hashed_orders WHERE email <> ''
UNION ALL SELECT 'raw_customers', count(DISTINCT lower(trim(email))), count(DISTINCT email_hash)
FROM hashed_customers WHERE email <> ''
""",
)
query(
    "post_nullify_verify",
    lambda x: hash_checks.post_nullify_verify(
        {
            "raw_orders": (pii.nullify_pii(half_hashed(x), ["email"], "email_hash"), "email"),
            "raw_customers": (pii.nullify_pii(x.hashed_customers, ["email"], "email_hash"), "email"),
        }
    ),
    f"""
SELECT *, if(remaining_emails = 0 AND hashes_preserved > 0, 'PASS', 'FAIL') AS status FROM (
  SELECT 'raw_orders' AS table_name, count(*) AS total_rows,
    count(*) FILTER (email <> '' AND email_hash IS NULL) AS remaining_emails, count(email_hash) AS hashes_preserved
  FROM ({HALF})
  UNION ALL SELECT 'raw_customers', count(*), count(*) FILTER (email <> '' AND email_hash IS NULL), count(email_hash)
  FROM hashed_customers)
""",
)
query(
    "restore_verify",
    lambda x: hash_checks.restore_verify(x.hashed_history, ["customer_email", "customer_first_name", "customer_last_name"]),
    """
SELECT count(*) AS total_rows, count(customer_email) AS with_customer_email,
  count(customer_first_name) AS with_customer_first_name, count(customer_last_name) AS with_customer_last_name,
  count(email_hash) AS with_hash FROM hashed_history
""",
)
query(
    "ref_null_check",
    lambda x: hash_checks.ref_null_check(master(x)),
    " UNION ALL ".join(
        f"SELECT '{n[4:]}' AS table_name, count(*) AS total_rows, count(*) - count({b}_original) AS null_original, "
        f"0 AS null_consistent FROM {n}"
        for n, (b, _) in REFS.items()
    ),
)
query(
    "ref_summary",
    lambda x: hash_checks.ref_summary(master(x)),
    """
SELECT pii_field, count(*) AS unique_values, sum(source_count)::BIGINT AS total_occurrences,
  avg(source_count) AS avg_sources_per_value FROM ref_master GROUP BY 1
""",
)
query(
    "ref_multi_source",
    lambda x: hash_checks.ref_multi_source(master(x)),
    "SELECT pii_field, count(*) AS values_in_multiple_sources FROM ref_master WHERE source_count > 1 GROUP BY 1",
)
query(
    "cross_source_customers",
    lambda x: hash_checks.cross_source_customers(x.email_refs),
    """
SELECT email_hash_consistent, source_count AS platforms_count, sources AS platforms FROM ref_email
WHERE source_count > 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
)
query(
    "ref_one_to_one",
    lambda x: hash_checks.ref_one_to_one(x.email_refs),
    """
SELECT count(*) AS total_hashes, count(DISTINCT email_hash_original) AS unique_emails,
  count(DISTINCT email_hash_consistent) AS unique_consistent_hashes FROM ref_email
""",
)
query(
    "null_preservation",
    lambda x: hash_checks.null_preservation(x.shop_consistent),
    """
SELECT count(*) AS total_orders, count(*) - count(order_email_hash) AS null_order_emails,
  count(*) - count(customer_email_hash) AS null_customer_emails,
  (count(*) - count(order_email_hash))::DOUBLE / count(*) * 100 AS null_order_email_pct,
  (count(*) - count(customer_email_hash))::DOUBLE / count(*) * 100 AS null_customer_email_pct FROM shop_consistent
""",
)
query(
    "distinct_hash_union",
    lambda x: hash_checks.distinct_hash_union(x.shop_consistent),
    """
SELECT (SELECT count(*) FROM (SELECT order_email_hash FROM shop_consistent WHERE order_email_hash IS NOT NULL
    UNION SELECT customer_email_hash FROM shop_consistent WHERE customer_email_hash IS NOT NULL)) AS total_unique_hashes,
  count(DISTINCT order_email_hash) AS unique_order_hashes, count(DISTINCT customer_email_hash) AS unique_customer_hashes
FROM shop_consistent
""",
)
query(
    "hash_frequency_anomaly",
    lambda x: hash_checks.hash_frequency_anomaly(pii.anon_live_orders(x.raw_orders), "email_hash", 200),
    """
SELECT email_hash, count(*) AS occurrence_count FROM (SELECT sha256(lower(ifnull(email, ''))) AS email_hash FROM raw_orders)
GROUP BY 1 HAVING count(*) > 200
""",
)
query(
    "pii_null_rates",
    lambda x: hash_checks.pii_null_rates(x.clean_customers),
    """
SELECT k AS pii_type, count(*) AS total_customers, count(v) AS has_value, count(*) - count(v) AS is_null,
  (count(*) - count(v))::DOUBLE / count(*) * 100 AS null_pct
FROM (SELECT unnest(['Email','Phone','First Name','Last Name','Address']) AS k,
  unnest([email_hash, phone_hash, first_name_hash, last_name_hash, addresses_hash]) AS v FROM clean_customers)
GROUP BY 1
""",
)
query(
    "orphan_orders",
    lambda x: unify.orphan_orders(x.clean_orders, emailless(x), EMPTY_SHA256).select("id", "name", "email_hash"),
    """
SELECT id, name, email_hash FROM clean_orders WHERE email_hash IS NOT NULL
  AND email_hash NOT IN (SELECT email_hash FROM clean_customers WHERE email_hash IS NOT NULL AND tags <> 'MACHINERY')
""",
)


def emailless(x):
    """Customers, one segment of whom have lost their email, so that some orders have no customer."""
    return x.clean_customers.withColumn("email_hash", F.when(F.col("tags") != "MACHINERY", F.col("email_hash")))
