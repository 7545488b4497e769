"""Orders and children in equal buckets: same rows as without, and nothing moves for the child joins."""

import pytest
from pyspark.sql import functions as F

from martlet.operators import unify
from martlet.sources import tables
from tests.compare import ROOT
from workload.inputs import Inputs


@pytest.fixture(scope="module")
def parts(spark):
    return Inputs(spark, f"{ROOT}/sf0.001").shop_parts()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_child_joins_move_nothing(no_broadcast, parts):
    children = {k: v for k, v in parts.items() if k != "customers"}
    stored = unify.store_order_tables(**children, prefix="shop_moved", buckets=4)
    joined = stored["orders"]
    for part in ("items", "transactions", "utm", "refunds"):
        joined = unify._with_child(joined, stored[part])
    assert shuffles(joined) == []
    assert joined.count() == parts["orders"].count()

    unified = unify.shopify_unified_stored(stored, parts["customers"])
    assert not [line for line in shuffles(unified) if "_order#" in line]
    plain = unify.shopify_unified(**parts)
    assert sorted(unified.columns) == sorted(plain.columns)
    assert unified.select(plain.columns).exceptAll(plain).isEmpty() and plain.exceptAll(unified.select(plain.columns)).isEmpty()


def test_orders_move_once_for_grouped_children(no_broadcast, parts):
    """Without stored tables each child is grouped by the id where it is joined: one shuffle per table on the id."""
    plan = unify.shopify_unified(**parts)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(_order#" in line]
    assert len(moved) == 2  # the orders, and the attribution rows, which nothing groups


def test_orders_without_number_spread_over_buckets_and_match_nothing(spark):
    n = F.col("id")
    orders = spark.range(6000).select(n.alias("order_id"), F.when(n % 3 > 0, n).alias("order_id_numeric"))
    child = spark.range(6000).select(F.when(n % 2 > 0, n).otherwise(-n - 1).alias("order_id_numeric"), F.lit(1).alias("v"))
    keyed = orders.withColumn("_order", unify.order_key())
    assert keyed.filter("order_id_numeric IS NULL AND _order >= 0").isEmpty()
    assert keyed.select("_order").distinct().count() == 6000
    stored = tables.write_bucketed(keyed, "spread_orders", "_order", 8)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * 6000 / 8
    joined = unify._with_child(stored, child)
    assert joined.count() == 6000 and joined.filter("v = 1").count() == 2000


def test_bucketed_table_is_replaced_and_may_be_empty(spark):
    tables.write_bucketed(spark.range(100), "refilled", "id", 4)
    assert tables.write_bucketed(spark.range(0), "refilled", "id", 4).count() == 0
    assert tables.write_bucketed(spark.range(7), "refilled", "id", 2).count() == 7
