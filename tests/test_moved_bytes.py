"""Hashes are packed on their way through shuffles, and wide rows move no more often than the joins need."""

import hashlib

import pytest
from pyspark.sql import functions as F

from martlet.functions import packed, unpacked
from martlet.operators import dedup, pii, unify

DIGEST = hashlib.sha256(b"x").hexdigest()
ODD = [None, "", "\x01", DIGEST, DIGEST.upper(), DIGEST[:-1], DIGEST[:-1] + "\n", DIGEST + "\n", "1" * 64, "é" * 32, "10.0.0.1"]


def sha(text):
    return None if text is None else hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def planned(spark):
    """Joins shuffle, and plans show what is read again instead of shuffled again."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def exchanges(df, key):
    """Distinct shuffles by `key` in the plan; such as are read again are listed once."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in lines if f" Exchange hashpartitioning({key}#" in line and "Reused" not in line]


def test_packed_texts_come_back(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ODD)], "i int, v string").repartition(3)
    back = df.select("i", "v", packed("v").alias("p")).select("i", "v", unpacked("p").alias("b"), F.length("p").alias("n")).collect()
    assert {r.i: r.b for r in back} == dict(enumerate(ODD))
    assert {r.n for r in back if r.v in (DIGEST, "1" * 64)} == {33}
    assert df.select(packed("v").alias("p")).distinct().count() == len(set(ODD))


ORDER = "id long, user_id long, email_hash string, phone_hash string, browser_ip string"


def references(spark):
    a, b = sha("a"), sha("b")
    orders = [(1, 10, a, b, "10.0.0.1"), (2, 10, None, None, ""), (3, None, a, None, None), (4, 12, "plain", b, "10.0.0.1"),
              (None, 11, a, None, "10.0.0.2")]
    customers = [(10, sha("First"), sha("Last")), (11, None, "odd"), (12, None, None)]
    o = spark.createDataFrame(orders, ORDER)
    c = spark.createDataFrame(customers, "id long, first_name_hash string, last_name_hash string")
    return o, c, a, b


def test_references_applied_to_every_row(spark):
    """Values without a reference keep their own, an address the hash of its own; rows without values or id are kept."""
    o, c, a, b = references(spark)
    known = [("email", a), ("phone", b), ("first_name", sha("First")), ("ip", "10.0.0.1"), ("phone", "plain")]
    master = spark.createDataFrame([(f, v, sha(v)) for f, v in known], "pii_field string, original_value string, consistent_hash string")
    out = {r.id: tuple(r)[1:] for r in pii.apply_references(o, c, master).collect()}
    assert out == {
        1: (sha(a), sha(b), sha(sha("First")), sha("Last"), sha("10.0.0.1")),
        2: (None, None, sha(sha("First")), sha("Last"), sha("")),
        3: (sha(a), None, None, None, None),
        4: ("plain", sha(b), None, None, sha("10.0.0.1")),
        None: (sha(a), None, None, "odd", sha("10.0.0.2")),
    }


def test_references_read_one_shuffle_of_the_orders(planned):
    n = F.col("id")
    hashed = {f"{c}_hash": F.sha2(n.cast("string"), 256) for c in ("email", "phone")}
    own = F.nullif(n.cast("string"), F.lit("-"))
    raw = planned.range(100).withColumns({"extracted_at": n % 3, "user_id": n % 7, "browser_ip": n.cast("string"), **hashed}).withColumn("id", own)
    orders = dedup.dedup_latest(raw, ["id"], ["extracted_at"], ["user_id", "browser_ip", *hashed])
    names = ("email", "phone", "first_name", "last_name", "addresses", "default_address")
    customers = planned.range(7).withColumns({f"{c}_hash": F.sha2(F.lit(c), 256) for c in names})
    applied = pii.apply_references(orders, customers, pii.master_reference(customers, orders))
    assert applied.count() == 100 and len(exchanges(applied, "id")) == 1


def moves_of(df, column):
    """Shuffles whose rows carry `column`."""

    def nodes(plan):
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    found = nodes(df._jdf.queryExecution().executedPlan())
    return sum(n.nodeName() == "Exchange" and f"{column}#" in n.output().mkString(",") for n in found)


def shop(spark):
    """Orders: one twice, one without email, two without any id, one whose hash nobody has; two customers share a hash."""
    a, b = sha("a"), sha("b")
    keys = [(1, 1, a), (1, 1, a), (1, 1, b), (2, 2, None), (None, None, a), (None, None, b), (3, 3, "odd"), (4, None, sha("c"))]
    n, money = "CAST(NULL AS TIMESTAMP)", "CAST(10 AS DECIMAL(18,2))"
    orders = spark.createDataFrame(keys, "order_id long, order_id_numeric long, order_email_hash string").selectExpr(
        "*", "concat('tag', order_email_hash) AS order_tags", "'web' AS source_name", f"{n} AS order_cancelled_at", f"{money} AS order_value", f"{money} AS order_discounts"
    ).repartition(3)
    people = [(7, a), (8, a), (9, "odd"), (10, None), (11, sha("d"))]
    customers = spark.createDataFrame(people, "customer_id long, customer_email_hash string").selectExpr(
        "*", *[f"'{c}' AS {c}" for c in ("customer_state", "customer_first_name", "customer_tags")], f"{n} AS customer_created_at",
        "1L AS customer_order_count_shopify", f"{money} AS customer_lifetime_value_shopify", "true AS customer_email_verified",
        "true AS customer_accepts_marketing", "now() AS customer_last_sync_at",
    )
    lines = spark.createDataFrame([(1, None, "t"), (1, "s", None), (1, "s", "t"), (3, None, None)], "o long, sku string, title string")
    items = lines.selectExpr("'gid/' || o AS order_id", "'gid/' || o AS admin_graphql_api_order_id", "sku", "title", "2L AS quantity",
                             f"{money} AS original_total")
    paid = spark.createDataFrame([(1, "x", None, "k"), (1, "x", "b", "k"), (1, None, "a", "k")], "order_id long, gateway string, status string, kind string")
    paid = paid.selectExpr("*", "'1.50' AS amount", "now() AS created_at")
    back = spark.createDataFrame([(3, '[{"amount":"4.00"}]')], "order_id long, transactions string").selectExpr("*", "now() AS created_at")
    return orders, customers, items, paid, back


def test_orders_meet_customers_by_narrow_rows(planned):
    orders, customers, items, paid, back = shop(planned)
    utm = planned.createDataFrame([(1, "u"), (3, None)], "order_id_numeric long, first_utm_source string").withColumn("utm_extracted_at", F.lit(1))
    out = unify.shopify_unified(orders, customers, unify.items_agg(items), unify.transactions_agg(paid), utm, unify.refunds_agg(back))
    a, b = sha("a"), sha("b")
    given = out.select("order_id", "order_email_hash", "customer_id", "items_count", "skus", "product_titles", "payment_gateways",
                       "transaction_statuses", "attribution_channel")
    first = (3, "s", "t", "x", "a, b", "u")
    none = (0, None, None, None, None, "web")
    expected = [(1, a, 7, *first), (1, a, 8, *first)] * 2 + [(1, b, None, *first), (2, None, None, *none), (None, a, 7, *none),
                (None, a, 8, *none), (None, b, None, *none), (3, "odd", 9, 1, None, None, None, None, "web"), (4, sha("c"), None, *none)]
    assert sorted(map(str, map(tuple, given.collect()))) == sorted(map(str, expected))
    assert moves_of(out, "order_tags") == 2  # once above here to deal the rows, once to the key of the order


def test_consistent_orders_meet_references_by_narrow_rows(planned):
    orders, customers, items, paid, back = shop(planned)
    utm = planned.createDataFrame([(1, "u")], "order_id_numeric long, utm_source string")
    refs = planned.createDataFrame([(sha("a"), sha(sha("a")))], "email_hash_original string, email_hash_consistent string")
    out = unify.shopify_unified_consistent(
        orders, customers, refs, unify.items_agg_all(items), unify.transactions_agg(paid, kinds=True), utm, unify.refunds_agg(back)
    )
    given = out.select("order_id", "order_email_hash", "customer_email_hash", "customer_id", "product_titles", "transaction_types", "net_revenue")
    a, b = sha(sha("a")), sha("b")
    first, none = ("t, t", "k", "10.00"), (None, None, "10.00")
    expected = [(1, a, a, 7, *first), (1, a, a, 8, *first)] * 2 + [(1, b, None, None, *first), (2, None, None, None, *none),
                (None, a, a, 7, *none), (None, a, a, 8, *none), (None, b, None, None, *none), (3, "odd", "odd", 9, None, None, "6.00"),
                (4, sha("c"), None, None, *none)]
    found = [(*tuple(r)[:-1], str(r.net_revenue)) for r in given.collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert moves_of(out, "order_tags") == 2
