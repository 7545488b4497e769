"""The same comparison on tables in which one order, product, supplier, day, customer and user
holds a third of all rows."""

import glob
import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from martlet.operators import attribution, changes, unify
from tests.compare import ROOT, difference, duck

NAMES = """
items_agg items_agg_all transactions_agg refunds_agg shopify_unified shopify_unified_consistent marketing_unified
order_gross_margin orders_with_customers customer_ltv attribution_by_date_join apply_pii_refs fraud_by_ip
pii_master_reference cross_table_hash_consistency dedup_ads_base dedup_advertiser_report clean_transactions
shopify_daily_metrics product_performance check_price_format check_duplicates reconcile stream_dedup
stream_upsert_latest budget_exhausted
""".split()

THIRD = "CASE WHEN rn % 3 = 0 THEN {hot} ELSE {col} END AS {col}"
HOT = {
    "lineitem": {"l_orderkey": "1", "l_partkey": "1", "l_suppkey": "1", "l_shipdate": "TIMESTAMP '2001-07-25'"},
    "orders": {"o_custkey": "2", "o_orderdate": "TIMESTAMP '2001-07-25'"},
    "events": {"user_id": "1"},
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for path in glob.glob(f"{ROOT}/sf0.001/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        if name not in HOT:
            shutil.copy(path, folder)
            continue
        replaced = ", ".join(THIRD.format(hot=h, col=c) for c, h in HOT[name].items())
        con.execute(
            f"COPY (SELECT * EXCLUDE (rn) REPLACE ({replaced}) FROM (SELECT *, row_number() OVER () AS rn FROM '{path}')) "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_when_skewed(spark, skewed, name):
    assert difference(contract.queries()[name](spark, skewed), duck(skewed), contract.oracle_sql()[name]) is None


# ------------------------------------------------------------------ NULL keys, rows per task
@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and partitions stay as they are dealt."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def evenly_dealt(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) <= 1.3 * sum(sizes) / len(sizes)


def third_without(spark, key, other):
    n = F.col("id")
    return spark.range(9000).select(n.alias(other), F.when(n % 3 > 0, n).alias(key), F.lit("x").alias("v"))


def test_orders_without_numeric_id_do_not_meet(shuffled):
    child = shuffled.range(9000).select(F.col("id").alias("order_id_numeric"), F.lit(1).alias("items"))
    joined = unify._with_child(third_without(shuffled, "order_id_numeric", "order_id"), child)
    assert joined.count() == 9000 and joined.filter("items = 1").count() == 6000 and evenly_dealt(joined)


def test_updates_of_rows_without_key_do_not_meet(shuffled):
    source = shuffled.range(9000).select(F.col("id").alias("k"), F.lit("new").alias("w"))
    updated = changes.update_from(third_without(shuffled, "k", "id"), source, "k", {"v": F.col("src_w")})
    assert updated.columns == ["id", "k", "v"] and updated.filter("v = 'new'").count() == 6000 and evenly_dealt(updated)


def test_extract_rows_without_order_do_not_meet(shuffled):
    utm = third_without(shuffled, "order_id", "created_at").select(
        "*", F.lit(None).cast("string").alias("sales_channel"), F.lit("UNKNOWN_CHANNEL").alias("attribution_status"),
        F.lit("/p").alias("first_landing_page"), F.lit(None).cast("string").alias("first_utm_source"),
    )
    extract = shuffled.range(9000).select(F.col("id").alias("order_id"), F.lit("web").alias("channel_handle"))
    found = attribution.reclassify_from_extract(utm, extract)
    assert found.filter("sales_channel = 'web'").count() == 6000 and evenly_dealt(found)
