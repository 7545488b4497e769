"""Join the conformed extracts into unified order and marketing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import as_date, digits, divide, hash_pii, json_decimal, money, packed, percent, unpacked
from martlet.operators.conform import attribution_channel, order_flags
from martlet.operators.dedup import dedup_latest
from martlet.operators.joins import left_join_spread
from martlet.sources.tables import write_bucketed


# ------------------------------------------------------------- children per order
def distinct_lists(*cols: str) -> list[Column]:
    """Per column the distinct values of a group as one sorted 'a, b, c' text, NULL if there is none; sets are merged map-side.

    One set holds the distinct rows of all the columns: a group of few rows crosses the shuffle narrower than with a set for each.
    """
    rows = F.collect_set(F.struct(*cols))
    # array_join leaves NULLs out.
    return [_null_if_empty(F.array_join(F.array_sort(F.array_distinct(rows[c])), ", ")) for c in cols]


def repeated_list(pairs: Column) -> Column:
    """(value, count) pairs as one sorted text with every repeat written out."""
    return F.array_join(
        F.flatten(F.transform(F.array_sort(pairs), lambda p: F.array_repeat(p["v"], p["n"].cast("int")))), ", "
    )


def _null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def items_agg(line_items: DataFrame) -> DataFrame:
    """Line items per order: counts, totals, distinct SKUs and titles."""
    items = line_items.filter(F.col("order_id").isNotNull())
    skus, titles = distinct_lists("sku", "title")
    return items.groupBy(digits("order_id").alias("order_id_numeric")).agg(
        F.count("*").alias("items_count"),
        F.sum("quantity").alias("total_quantity"),
        skus.alias("skus"),
        titles.alias("product_titles"),
        F.sum("original_total").alias("items_total_original"),
    )


def items_agg_all(line_items: DataFrame) -> DataFrame:
    """Line items per order with every title and SKU listed, repeats included.

    Equal (order, title, SKU) rows are counted first, so a busy order crosses the
    second shuffle as its distinct products, not as its rows. There the counted rows are
    dealt by order as they are, which is narrower than lists begun on the way.
    """
    counted = (
        line_items.filter(F.col("admin_graphql_api_order_id").isNotNull())
        .groupBy(digits("admin_graphql_api_order_id").alias("order_id_numeric"), "title", "sku")
        .agg(F.count("*").alias("n"), F.sum(F.col("quantity").cast("bigint")).alias("quantity"))
    )

    def listed(col: str) -> Column:
        pair = F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), F.col("n").alias("n")))
        return _null_if_empty(repeated_list(F.collect_list(pair)))

    return counted.repartition("order_id_numeric").groupBy("order_id_numeric").agg(
        F.sum("n").alias("items_count"),
        listed("title").alias("product_titles"),
        listed("sku").alias("product_skus"),
        F.sum("quantity").alias("total_quantity"),
    )


def transactions_agg(transactions: DataFrame, kinds: bool = False) -> DataFrame:
    """Payments per order. `kinds` gives the variant with transaction types and no amounts."""
    groups = transactions.filter(F.col("order_id").isNotNull()).groupBy(F.col("order_id").alias("order_id_numeric"))
    lists = {"payment_gateways": "gateway", "transaction_statuses": "status"}
    if kinds:
        lists = {"transaction_types": "kind", **lists}
    aggs = [F.count("*").alias("transaction_count")]
    aggs += [listed.alias(dst) for dst, listed in zip(lists, distinct_lists(*lists.values()))]
    if not kinds:
        aggs += [
            F.sum(money("amount")).alias("transactions_total_amount"),
            F.min("created_at").alias("first_transaction_at"),
            F.max("created_at").alias("last_transaction_at"),
        ]
    return groups.agg(*aggs)


def refunds_agg(refunds: DataFrame) -> DataFrame:
    """Refunds per order; the amount is the first transaction of each refund, if any."""
    return (
        refunds.filter(F.col("order_id").isNotNull())
        .groupBy(F.col("order_id").alias("order_id_numeric"))
        .agg(
            F.count("*").alias("refund_count"),
            F.sum(json_decimal("transactions", "$[0].amount")).alias("refunds_total_amount"),
            F.max("created_at").alias("last_refund_at"),
        )
    )


FIRST_TOUCH = ("source", "medium", "campaign", "content", "term")
LAST_TOUCH = ("source", "medium", "campaign")


def utm_attribution(utm: DataFrame) -> DataFrame:
    """First- and last-touch attribution keyed by the numeric order id."""
    return utm.filter(F.col("order_id").isNotNull()).select(
        digits("order_id").alias("order_id_numeric"),
        "sales_channel",
        "sales_channel_name",
        "attribution_status",
        *[f"first_utm_{c}" for c in FIRST_TOUCH],
        "first_landing_page",
        "first_referrer_url",
        "first_visit_at",
        *[f"last_utm_{c}" for c in LAST_TOUCH],
        "last_landing_page",
        "last_visit_at",
        "customer_order_index",
        "days_to_conversion",
        F.col("extracted_at").alias("utm_extracted_at"),
    )


# ------------------------------------------------------------------- unified orders
def order_key() -> Column:
    """The numeric id of an order; one without any (marketplace orders have other names) gets a negative number of its own."""
    own = -1 - F.pmod(F.xxhash64("order_id"), F.lit((1 << 63) - 1))
    return F.coalesce(F.col("order_id_numeric"), own)


def _with_child(orders: DataFrame, child: DataFrame) -> DataFrame:
    """Left join of a table with a row per order, on the numeric id.

    Numeric ids are read from runs of digits, so none is negative: orders without one match nothing and are spread by
    their own id. All sides keep the number itself as their key: a child that was grouped by it, or is stored in
    buckets of it, is joined where it lies, and the orders move once for all children.
    """
    if "_order" not in orders.columns:
        orders = orders.withColumn("_order", order_key())
    keyed = child.filter(F.col("order_id_numeric") >= 0).withColumnRenamed("order_id_numeric", "_order")
    return orders.join(keyed, "_order", "left")


def _equal(a: Column, b: Column) -> Column:
    """Equal values, NULLs too, in a form that Spark does not take for a join key, by which it would move both sides."""
    return ((a >= b) & (a <= b)) | (a.isNull() & b.isNull())


def _with_email_tables(orders: DataFrame, *tables: DataFrame) -> DataFrame:
    """Left join of orders with tables that have the email hash as `_hash`, packed. Orders keep theirs packed, as `_email`.

    Only order keys and hashes move to the tables, and come back with what they found; the wide rows of the orders move
    once, to the key `_order` where all other joins meet them. Orders without an email have nothing to look up. The narrow
    rows are distinct, so an order that comes twice finds its rows once each time.
    """
    orders = orders.withColumns({"_order": order_key(), "_email": packed("order_email_hash")}).drop("order_email_hash")
    found = orders.filter(F.col("_email").isNotNull()).select(
        F.col("order_id").alias("_found_id"), F.col("_order").alias("_found"), F.col("_email").alias("_hash")
    ).distinct()
    for table in tables:
        found = found.join(table.filter(F.col("_hash").isNotNull()), "_hash", "inner" if len(tables) == 1 else "left")
    same = (
        (F.col("_order") == F.col("_found"))
        & _equal(F.col("order_id"), F.col("_found_id"))
        & (F.col("_email") >= F.col("_hash"))
        & (F.col("_email") <= F.col("_hash"))
    )
    return orders.join(found, same, "left").drop("_found_id", "_found", "_hash")


def _emails_as_text(joined: DataFrame, columns: list[str]) -> DataFrame:
    """`_email` as `order_email_hash` again, and the columns of the orders first."""
    named = joined.withColumn("order_email_hash", unpacked("_email")).drop("_email")
    return named.select(*columns, *[c for c in named.columns if c not in columns])


def one_customer_per_hash(customers: DataFrame) -> DataFrame:
    return dedup_latest(customers, ["customer_email_hash"], ["customer_last_sync_at", "customer_id"])


def shopify_unified(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    transactions: DataFrame,
    utm: DataFrame,
    refunds: DataFrame,
    customer_match: str = "all",
) -> DataFrame:
    """Orders with customer, items, payments, attribution and refunds beside them.

    Child tables come in aggregated per order, so only the customer join can add rows:
    with `customer_match="all"` an order repeats for every customer that shares its
    email hash; "latest" keeps one customer per hash and so one row per order.

    Orders meet customers first, by way of their keys and hashes alone. The joins on the order id share
    one partitioning with the aggregates that feed them.
    """
    if customer_match not in ("all", "latest"):
        raise ValueError(f"customer_match must be 'all' or 'latest', not {customer_match!r}")
    if customer_match == "latest":
        customers = one_customer_per_hash(customers)
    c = customers.drop("customer_last_sync_at").withColumn("_hash", packed("customer_email_hash")).drop("customer_email_hash")
    joined = _with_email_tables(orders, c)
    for child in (items, transactions, utm.drop("utm_extracted_at"), refunds):
        joined = _with_child(joined, child)
    return _flagged(_emails_as_text(joined, orders.columns))


def _flagged(joined: DataFrame) -> DataFrame:
    return order_flags(joined.drop("_order")).withColumns(
        {
            "items_count": F.coalesce("items_count", F.lit(0).cast("bigint")),
            "attribution_channel": attribution_channel(F.col("first_utm_source"), F.col("source_name")),
        }
    )


def store_order_tables(
    orders: DataFrame,
    items: DataFrame,
    transactions: DataFrame,
    utm: DataFrame,
    refunds: DataFrame,
    prefix: str,
    buckets: int,
) -> dict[str, DataFrame]:
    """Orders and their children as catalogue tables `<prefix>_<part>`, in equal buckets of the order's numeric id.

    Storing them costs a shuffle each, once. Whatever joins them on the id afterwards, `shopify_unified_stored` above
    all, moves none of them, today or on any later run. Choose `buckets` so that one bucket fits a task.
    """
    stored = {"orders": write_bucketed(orders.withColumn("_order", order_key()), f"{prefix}_orders", "_order", buckets)}
    children = {"items": items, "transactions": transactions, "utm": utm, "refunds": refunds}
    for part, child in children.items():
        stored[part] = write_bucketed(child, f"{prefix}_{part}", "order_id_numeric", buckets)
    return stored


def shopify_unified_stored(stored: dict[str, DataFrame], customers: DataFrame) -> DataFrame:
    """`shopify_unified` (all customers of a hash) over the tables of `store_order_tables`.

    The children come first here: they lie in the orders' own buckets, so the only shuffle is that of the customer join.
    """
    joined = stored["orders"]
    for child in (stored["items"], stored["transactions"], stored["utm"].drop("utm_extracted_at"), stored["refunds"]):
        joined = _with_child(joined, child)
    c = customers.drop("customer_last_sync_at")
    return _flagged(left_join_spread(joined, c, "order_email_hash", "customer_email_hash", "order_id"))


def shopify_unified_consistent(
    orders: DataFrame,
    customers: DataFrame,
    refs: DataFrame,
    items: DataFrame,
    transactions: DataFrame,
    utm: DataFrame,
    refunds: DataFrame,
) -> DataFrame:
    """Variant with consistent hashes, parsed tracking parameters and zero defaults.

    One lookup serves both sides: orders and customers match on the same hash, so the
    consistent hash of the order is the customer's too.
    """
    c = customers.select(
        packed("customer_email_hash").alias("_hash"),
        "customer_id",
        F.lit(True).alias("_matched"),
        "customer_state",
        "customer_first_name",
        "customer_tags",
        "customer_created_at",
        "customer_order_count_shopify",
        F.col("customer_lifetime_value_shopify").alias("customer_total_spent"),
        "customer_email_verified",
        "customer_accepts_marketing",
        "customer_last_sync_at",
    )
    pairs = refs.select(packed("email_hash_original").alias("_hash"), packed("email_hash_consistent").alias("_consistent"))
    joined = _with_email_tables(orders, pairs, c)
    for child in (items, transactions, utm, refunds):
        joined = _with_child(joined, child)
    joined = _emails_as_text(joined, orders.columns).withColumn("_consistent", unpacked("_consistent"))
    zero = {
        n: F.coalesce(n, F.lit(0).cast("bigint"))
        for n in ("items_count", "total_quantity", "transaction_count", "refund_count")
    }
    refunded = F.coalesce(F.col("refunds_total_amount"), F.lit(0).cast("decimal(18,2)"))
    return joined.withColumns(
        {
            **zero,
            "customer_email_hash": F.when(F.col("_matched"), F.coalesce("_consistent", "order_email_hash")),
            "order_email_hash": F.coalesce("_consistent", "order_email_hash"),
            "net_revenue": F.col("order_value") - refunded,
            "refunds_total_amount": refunded,
        }
    ).drop("_consistent", "_matched", "_order")


# -------------------------------------------------------------------- daily and master
def daily_ad_spend(platforms: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per day and platform: spend, impressions, clicks (and attributed sales where a platform has them).

    `platforms` maps the source name to its unified table and column prefix.
    """
    out = None
    for source, (df, prefix) in platforms.items():
        aggs = [F.sum(f"{prefix}{c}").alias(c) for c in ("spend", "impressions", "clicks")]
        if f"{prefix}sales" in df.columns:
            aggs.append(F.sum(f"{prefix}sales").alias("revenue"))
        one = df.groupBy("date").agg(*aggs).withColumn("ad_source", F.lit(source))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.select("date", "ad_source", *[c for c in out.columns if c not in ("date", "ad_source")])


# Columns of the unified orders that `shopify_daily` reads.
DAILY_COLUMNS = ("order_date", "attribution_channel", "first_utm_source", "order_value", "order_net_value", "customer_id")


def shopify_daily(shop: DataFrame, by_source: bool = True) -> DataFrame:
    """Orders per day, channel and first source. `by_source=False` groups by lower-cased channel only."""
    keys: list = [F.col("order_date").alias("date")]
    if by_source:
        keys += [F.col("attribution_channel"), F.col("first_utm_source")]
    else:
        keys += [F.lower("attribution_channel").alias("attribution_channel")]
    return (
        shop.filter(F.col("order_date").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("orders"),
            F.sum("order_value").alias("revenue"),
            F.sum("order_net_value").alias("net_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def marketing_unified(shop_daily: DataFrame, ad_spend: DataFrame) -> DataFrame:
    """Full outer join of daily sales and daily spend on day and channel, with ratios.

    A channel whose name is spelt in several ways, or that has several first sources,
    has several sales rows a day, and the day's spend stands beside each of them.
    `shopify_daily(..., by_source=False)` gives one row per day and channel instead.
    """
    s = shop_daily.withColumn("_channel", F.lower("attribution_channel")).withColumnRenamed("date", "_sale_day")
    a = ad_spend.select(
        F.col("date").alias("_ad_day"),
        "ad_source",
        F.lower("ad_source").alias("_source"),
        "spend",
        "impressions",
        "clicks",
    )
    j = s.join(a, (s["_sale_day"] == a["_ad_day"]) & (s["_channel"] == a["_source"]), "full_outer")
    day = F.coalesce("_sale_day", "_ad_day")
    or_zero = lambda c, kind: F.coalesce(F.col(c), F.lit(0).cast(kind))
    source = F.col("first_utm_source") if "first_utm_source" in shop_daily.columns else F.lit(None).cast("string")
    flat = j.select(
        F.concat(
            day.cast("string"), F.lit("_"), F.coalesce("attribution_channel", "ad_source", F.lit("unknown"))
        ).alias("row_id"),
        day.alias("date"),
        F.coalesce("attribution_channel", "ad_source", F.lit("organic")).alias("channel"),
        source.alias("utm_source"),
        or_zero("orders", "bigint").alias("orders"),
        or_zero("revenue", "decimal(28,2)").alias("revenue"),
        or_zero("net_revenue", "decimal(28,2)").alias("net_revenue"),
        or_zero("unique_customers", "bigint").alias("unique_customers"),
        or_zero("spend", "decimal(28,2)").alias("ad_spend"),
        or_zero("impressions", "bigint").alias("ad_impressions"),
        or_zero("clicks", "bigint").alias("ad_clicks"),
    )
    c = F.col
    return flat.withColumns(
        {
            "roas": divide(c("revenue"), c("ad_spend")),
            "cpa": divide(c("ad_spend"), c("orders")),
            "avg_order_value": divide(c("revenue"), c("orders")),
            "ctr_percent": percent(c("ad_clicks"), c("ad_impressions")),
            "conversion_rate": percent(c("orders"), c("ad_clicks")),
        }
    )


# --------------------------------------------------------------------- other joins
def order_gross_margin(orders: DataFrame, line_items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Order value less the average cost of what was sold; orders need at least one costed item.

    Quantities are summed per order and product before the cost is looked up.
    """
    cost = inventory.groupBy("product_id").agg(
        divide(F.sum("cost"), F.count("cost")).cast("decimal(18,6)").alias("avg_cost")
    )
    sold = line_items.groupBy(digits("order_id").alias("order_id"), "product_id").agg(
        F.sum("quantity").alias("quantity")
    )
    spent = (
        sold.join(cost, "product_id")
        .groupBy("order_id")
        .agg(F.sum(F.col("avg_cost") * F.col("quantity").cast("decimal(18,0)")).alias("total_cost"))
    )
    return orders.select("order_id", "order_value").join(spent, "order_id").select(
        "order_id", "order_value", "total_cost", (F.col("order_value") - F.col("total_cost")).alias("gross_margin")
    )


def orders_with_customers(raw_orders: DataFrame, raw_customers: DataFrame, n: int = 10) -> DataFrame:
    """First `n` (order, customer) matches on the computed email hash, by order then customer id.

    Only the first `n` matched orders and, per hash, the first `n` customers can be in
    the answer, so the join never pairs up a busy hash in full.
    """
    o = raw_orders.select(
        F.col("id").alias("order_id"),
        F.col("name").alias("order_name"),
        "total_price",
        "extracted_at",
        hash_pii("email").alias("email_hash"),
    ).filter(F.col("email_hash").isNotNull())
    c = raw_customers.select(
        F.col("id").alias("customer_id"),
        "orders_count",
        "total_spent",
        F.col("extracted_at").alias("customer_extracted_at"),
        hash_pii("email").alias("email_hash"),
    ).filter(F.col("email_hash").isNotNull())
    order = ["order_id", "extracted_at"]
    first_orders = o.join(c.select("email_hash").distinct(), "email_hash", "left_semi").orderBy(*order).limit(n)
    per_hash = Window.partitionBy("email_hash").orderBy("customer_id", "customer_extracted_at")
    first_customers = (
        c.join(first_orders.select("email_hash").distinct(), "email_hash", "left_semi")
        .withColumn("_rn", F.row_number().over(per_hash))
        .filter(F.col("_rn") <= n)
    )
    return (
        first_orders.join(first_customers, "email_hash")
        .orderBy(*order, "customer_id", "customer_extracted_at")
        .limit(n)
        .select("order_id", "order_name", "total_price", "customer_id", "orders_count", "total_spent", "email_hash")
    )


def customer_ltv(raw_orders: DataFrame, raw_customers: DataFrame, n: int | None = 10) -> DataFrame:
    """Per email hash: orders, their total, highest customer spend; busiest `n`.

    The published query sums order totals over the join, so a hash shared by k
    customer rows counts each order k times. Both sides are aggregated per hash
    before the join and the total is multiplied by k, which gives the same figure.
    """
    o = (
        raw_orders.select("id", "total_price", hash_pii("email").alias("email_hash"))
        .filter(F.col("email_hash").isNotNull())
        .groupBy("email_hash")
        .agg(F.count_distinct("id").alias("orders"), F.sum("total_price").alias("_total"))
    )
    c = (
        raw_customers.select("total_spent", "orders_count", hash_pii("email").alias("email_hash"))
        .filter(F.col("email_hash").isNotNull())
        .groupBy("email_hash")
        .agg(
            F.count("*").alias("_k"),
            F.max("total_spent").alias("customer_ltv"),
            F.max("orders_count").alias("customer_orders_count"),
        )
    )
    out = o.join(c, "email_hash", "left").select(
        "email_hash",
        "orders",
        (F.col("_total") * F.coalesce("_k", F.lit(1)).cast("decimal(18,0)")).alias("order_total"),
        "customer_ltv",
        "customer_orders_count",
    )
    return out if n is None else out.orderBy(F.col("orders").desc(), "email_hash").limit(n)


def attribution_by_date_join(utm: DataFrame, ads: DataFrame, source_like: str = "%facebook%") -> DataFrame:
    """Orders joined to ad rows on the day alone, as the published query has it.

    Every order of a day meets every ad row of that day, so revenue and spend come
    out multiplied; `marketing_unified` is the figure to use. The multiplied sums are
    computed from per-day totals, without building the pairs.
    """
    sales = (
        utm.filter(F.col("first_utm_source").like(source_like))
        .groupBy(F.col("created_at").cast("date").alias("order_date"), "first_utm_source")
        .agg(F.count("*").alias("n"), F.sum("total_price").alias("value"))
    )
    spend = ads.groupBy(F.col("date_start").alias("order_date")).agg(
        F.count("*").alias("k"), F.sum(money("spend")).alias("spend")
    )
    j = sales.join(spend, "order_date", "left")
    times = F.coalesce("k", F.lit(1))
    revenue = F.col("value") * times.cast("decimal(18,0)")
    ad_spend = F.col("spend") * F.col("n").cast("decimal(18,0)")
    return j.select(
        "order_date",
        "first_utm_source",
        (F.col("n") * times).alias("orders"),
        revenue.alias("revenue"),
        ad_spend.alias("ad_spend"),
        divide(revenue, ad_spend).alias("roas"),
    )


def platform_spend_by_day(facebook: DataFrame, tiktok: DataFrame) -> DataFrame:
    f = facebook.groupBy("date").agg(F.sum("fb_spend").alias("facebook_spend"))
    t = tiktok.groupBy("date").agg(F.sum("tt_spend").alias("tiktok_spend"))
    return f.join(t, "date", "full_outer")


def unattributed_revenue(shop: DataFrame, marketing: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Days with shop revenue but none in the marketing table."""
    since = F.date_sub(as_date(as_of), days)
    s = (
        shop.filter(F.col("order_date") >= since)
        .groupBy(F.col("order_date").alias("date"))
        .agg(F.sum("order_value").alias("total_shopify_revenue"))
    )
    m = marketing.filter(F.col("date") >= since).groupBy("date").agg(F.sum("revenue").alias("total_marketing_revenue"))
    seen = F.coalesce(F.col("total_marketing_revenue"), F.lit(0))
    return (
        s.join(m, "date", "left")
        .filter((F.col("total_shopify_revenue") > 0) & (seen == 0))
        .withColumn("unattributed_revenue", F.col("total_shopify_revenue") - seen)
    )


def zero_spend_customers_with_orders(clean_customers: DataFrame, clean_orders: DataFrame) -> DataFrame:
    """Customers said to have spent nothing who do have orders under their email hash."""
    zero = clean_customers.filter(F.col("total_spent") == 0).select(
        F.col("id").alias("customer_id"), F.col("total_spent").alias("shopify_total_spent"), "email_hash"
    )
    per_hash = (
        clean_orders.filter(F.col("email_hash").isNotNull())
        .groupBy("email_hash")
        .agg(F.count("id").alias("actual_order_count"), F.sum("total_price").alias("calculated_total_spent"))
    )
    return zero.join(per_hash, "email_hash").drop("email_hash")


def zero_spend_share(clean_customers: DataFrame) -> DataFrame:
    zero = F.count_if(F.col("total_spent") == 0)
    return clean_customers.agg(
        zero.alias("customers_with_zero"), percent(zero, F.count("*")).alias("percentage")
    )


def email_match_status(shop: DataFrame, order_hash: str = "order_email_hash", customer_hash: str = "customer_email_hash"):
    o, c = F.col(order_hash), F.col(customer_hash)
    return shop.select(
        "order_id",
        o.alias("order_email_hash"),
        c.alias("customer_email_hash"),
        F.when(o == c, "Match")
        .when(o.isNull() & c.isNull(), "Both NULL")
        .when(o.isNull() | c.isNull(), "Partial NULL")
        .otherwise("Mismatch")
        .alias("match_status"),
    )


def email_mismatch_by_customer(clean_orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    """Orders whose email hash differs from that of the customer record they point to."""
    o = clean_orders.filter(F.col("email_hash").isNotNull()).select(
        F.col("id").alias("order_id"), "user_id", F.col("email_hash").alias("order_email")
    )
    c = clean_customers.filter(F.col("email_hash").isNotNull()).select(
        F.col("id").alias("user_id"), F.col("email_hash").alias("customer_email")
    )
    return (
        o.join(c, "user_id")
        .filter(F.col("order_email") != F.col("customer_email"))
        .select("order_id", "order_email", "customer_email", F.lit("MISMATCH").alias("status"))
    )


def orphan_orders(clean_orders: DataFrame, clean_customers: DataFrame, empty_hash: str) -> DataFrame:
    """Orders with an email hash no customer has."""
    o = clean_orders.filter(F.col("email_hash").isNotNull() & (F.col("email_hash") != empty_hash))
    return o.join(clean_customers.select("email_hash"), "email_hash", "left_anti")


def date_spine_gaps(df: DataFrame, day: Column, start, end) -> DataFrame:
    """Days between `start` and `end` (both included) on which `df` has no row."""
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(as_date(start), as_date(end), F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    present = df.filter(day.between(as_date(start), as_date(end))).select(day.alias("date")).distinct()
    return spine.join(present, "date", "left_anti")


def year_over_year(df: DataFrame, month: str, metrics: list[str], prefix: str = "ly_") -> DataFrame:
    """Each month beside the same month a year before, without reading the input twice.

    A row stands once under its own month and once, as history, under the month a
    year on; regrouping by month brings the two together. `df` holds one row per month.
    """
    current = F.struct(F.lit(False).alias("past"), F.col(month).alias("_m"))
    past = F.struct(F.lit(True).alias("past"), F.add_months(month, 12).alias("_m"))
    doubled = df.withColumn("_s", F.explode(F.array(current, past)))
    others = [c for c in df.columns if c != month]
    now = [F.max(F.when(~F.col("_s.past"), F.col(c))).alias(c) for c in others]
    before = [F.max(F.when(F.col("_s.past"), F.col(c))).alias(prefix + c) for c in metrics]
    return (
        doubled.groupBy(F.col("_s._m").alias(month))
        .agg(F.max(~F.col("_s.past")).alias("_seen"), *now, *before)
        .filter("_seen")
        .drop("_seen")
    )
