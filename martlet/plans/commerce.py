"""Order reports over the unified order table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import as_date, as_timestamp, divide, month_of, percent


def _flag(c: Column) -> Column:
    return F.max(F.coalesce(c, F.lit(False)))


def average(c: str) -> Column:
    """Mean of a column as sum over count, so it does not depend on row order."""
    return divide(F.sum(c), F.count(c))


def _by_key(shop: DataFrame, keys: dict[str, str], values: list[str]) -> DataFrame:
    """Each row once per key kind, with `kind`, `key` and values, so several distinct counts come from one reading.

    Values belong to the kind named first; the others carry NULLs, which add nothing.
    """
    first = next(iter(keys))
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(c).cast("string").alias("key"),
            *[(F.col(v) if kind == first else F.lit(None).cast(shop.schema[v].dataType)).alias(v) for v in values],
        )
        for kind, c in keys.items()
    ]
    other = [c for c in shop.columns if c not in values]
    return shop.select(*other, F.explode(F.array(*entries)).alias("e")).select(*other, "e.*")


METRIC_SUMS = ("order_value", "order_net_value", "order_discounts", "order_tax", "items_count", "total_quantity")
METRIC_SUMS += ("transaction_count", "transactions_total_amount")
# Columns of the unified orders that `shopify_daily_metrics` reads.
METRIC_COLUMNS = ("order_date", "order_id", "customer_id", "first_utm_source", "is_cancelled", "has_refund")
METRIC_COLUMNS += ("customer_order_count_shopify", "refunds_total_amount", *METRIC_SUMS)
# Columns of the unified orders that `product_performance` reads.
PRODUCT_COLUMNS = ("product_titles", "order_date", "order_id", "total_quantity", "items_total_original", "order_discounts")


def shopify_daily_metrics(shop: DataFrame) -> DataFrame:
    """Daily order figures.

    Eight distinct counts in one aggregate would copy every row eight times, and a branch per counted thing would build
    the order table anew. Instead each row counts twice, for its order and for its customer: rows of an order or
    customer are brought together first, then added up per day.
    """
    sums, source, order = METRIC_SUMS, F.col("first_utm_source"), F.col("kind") == "order"
    dated = shop.filter(F.col("order_date").isNotNull()).select(*METRIC_COLUMNS)
    rows = _by_key(dated, {"order": "order_id", "customer": "customer_id"}, [*sums, "refunds_total_amount"])
    per_key = rows.groupBy("order_date", "kind", "key").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("order_value").alias("_values"),
        F.count("items_count").alias("_items"),
        F.count("transaction_count").alias("_with_transactions"),
        F.sum(F.when(F.col("has_refund"), F.col("refunds_total_amount")).when(order, F.lit(0))).alias("refunds"),
        *[_flag(source == s).alias(s) for s in ("facebook", "google", "tiktok")],
        _flag(source.isNull()).alias("direct"),
        _flag(F.col("is_cancelled")).alias("cancelled"),
        _flag(F.col("has_refund")).alias("refunded"),
        _flag(F.col("customer_order_count_shopify") > 1).alias("returning"),
    )
    known = (F.col("kind") == "customer") & F.col("key").isNotNull()
    daily = per_key.groupBy("order_date").agg(
        F.count_if(order).alias("orders"),
        F.sum("order_value").alias("gross_revenue"),
        F.sum("order_net_value").alias("net_revenue"),
        divide(F.sum("order_value"), F.sum("_values")).alias("aov"),
        F.sum("order_discounts").alias("total_discounts"),
        F.sum("order_tax").alias("total_tax"),
        F.sum("items_count").alias("total_items"),
        F.sum("total_quantity").alias("total_units"),
        divide(F.sum("items_count"), F.sum("_items")).alias("avg_items_per_order"),
        *[
            F.count_if(order & F.col(c)).alias(f"{c}_orders")
            for c in ("facebook", "google", "tiktok", "direct", "cancelled", "refunded")
        ],
        F.sum("refunds").alias("total_refund_amount"),
        divide(F.sum("transaction_count"), F.sum("_with_transactions")).alias("avg_transactions_per_order"),
        F.sum("transactions_total_amount").alias("total_transaction_amount"),
        F.count_if(known).alias("unique_customers"),
        F.count_if(known & F.col("returning")).alias("returning_customers"),
    )
    share = percent(F.col("returning_customers"), F.col("unique_customers"))
    return daily.withColumn("returning_customer_pct", share).withColumnRenamed("order_date", "date")


def shopify_daily_metrics_lite(shop: DataFrame) -> DataFrame:
    """Short variant; here the returning share, and cancelled and refunded, count order rows."""
    order = F.col("kind") == "order"
    rows = {
        "cancelled_orders": F.col("is_cancelled"),
        "refunded_orders": F.col("has_refund"),
        "_returning": F.col("customer_order_count_shopify") > 1,
    }
    sums = ["order_value", "order_net_value"]
    used = ["order_date", "order_id", "customer_id", "is_cancelled", "has_refund", "customer_order_count_shopify"]
    dated = shop.filter(F.col("order_date").isNotNull()).select(*used, *sums)
    keyed = _by_key(dated, {"order": "order_id", "customer": "customer_id"}, sums)
    per_key = keyed.groupBy("order_date", "kind", "key").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("order_value").alias("_values"),
        *[F.count_if(order & cond).alias(name) for name, cond in rows.items()],
    )
    daily = per_key.groupBy("order_date").agg(
        F.count_if(order).alias("orders"),
        F.sum("order_value").alias("gross_revenue"),
        F.sum("order_net_value").alias("net_revenue"),
        divide(F.sum("order_value"), F.sum("_values")).alias("aov"),
        *[F.sum(name).alias(name) for name in rows],
        F.count_if(~order & F.col("key").isNotNull()).alias("unique_customers"),
    )
    return daily.select(
        F.col("order_date").alias("date"),
        "orders",
        "gross_revenue",
        "net_revenue",
        "aov",
        "unique_customers",
        percent(F.col("_returning"), F.col("unique_customers")).alias("returning_customer_pct"),
        "cancelled_orders",
        "refunded_orders",
    )


def product_performance(shop: DataFrame) -> DataFrame:
    """Products per month, from products per day (the average price is the mean of daily means)."""
    net = F.col("items_total_original") - F.coalesce("order_discounts", F.lit(0))
    unit_price = divide(F.col("items_total_original"), F.col("total_quantity"))
    daily = (
        shop.filter(F.col("product_titles") != "")
        .groupBy("product_titles", "order_date")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("total_quantity").alias("units"),
            F.sum("items_total_original").alias("gross"),
            F.sum(net).alias("net"),
            F.avg(unit_price).alias("price"),
        )
    )
    return daily.groupBy(month_of("order_date").alias("month"), F.col("product_titles").alias("product_name")).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("units").alias("total_units"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("net").alias("net_revenue"),
        F.round(F.avg("price"), 10).alias("avg_price"),
        divide(F.sum("net"), F.sum("units")).alias("revenue_per_unit"),
    )


def top_products(shop: DataFrame, as_of, n: int = 20) -> DataFrame:
    net = F.col("items_total_original") - F.coalesce("order_discounts", F.lit(0))
    return (
        shop.filter(F.col("product_titles").isNotNull() & (F.col("order_date") >= F.add_months(as_date(as_of), -1)))
        .groupBy(F.col("product_titles").alias("product_name"))
        .agg(
            F.sum("items_total_original").alias("gross_revenue"),
            F.sum(net).alias("net_revenue"),
            F.sum("total_quantity").alias("units_sold"),
        )
        .withColumn("avg_price_per_unit", divide(F.col("net_revenue"), F.col("units_sold")))
        .orderBy(F.col("net_revenue").desc(), "product_name")
        .limit(n)
    )


def top_products_monthly(product_months: DataFrame, as_of, n: int = 10) -> DataFrame:
    return (
        product_months.filter(F.col("month") >= F.add_months(as_date(as_of), -1))
        .groupBy("product_name")
        .agg(F.sum("gross_revenue").alias("revenue"), F.sum("total_units").alias("units"))
        .orderBy(F.col("revenue").desc(), "product_name")
        .limit(n)
    )


def sales_trend(daily_metrics: DataFrame, as_of, months: int = 13) -> DataFrame:
    return (
        daily_metrics.filter(F.col("date") >= F.add_months(as_date(as_of), -months))
        .groupBy(month_of("date").alias("month"))
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("gross_revenue").alias("gross_revenue"),
        )
    )


def unified_orders_daily(shop: DataFrame, since) -> DataFrame:
    return (
        shop.filter(F.col("order_date") >= as_date(since))
        .groupBy("order_date")
        .agg(
            F.count("*").alias("orders"),
            F.sum("order_value").alias("revenue"),
            F.sum("order_net_value").alias("net_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def daily_revenue(clean_orders: DataFrame, as_of, days: int = 30) -> DataFrame:
    day = F.col("created_at").cast("date")
    return (
        clean_orders.filter(day >= F.date_sub(as_date(as_of), days))
        .groupBy(day.alias("date"))
        .agg(F.count("*").alias("orders"), F.sum("total_price").alias("revenue"))
    )


def recent_orders_utm(shop_consistent: DataFrame, as_of, days: int = 7, n: int = 100) -> DataFrame:
    return (
        shop_consistent.filter(
            (F.col("order_created_at") >= F.date_sub(as_date(as_of), days).cast("timestamp_ntz"))
            & (F.col("order_value") > 0)
        )
        .orderBy(F.col("order_created_at").desc(), "order_id", "customer_id")
        .limit(n)
        .select(
            "order_id", "order_created_at", "order_value", "utm_source", "utm_medium", "utm_campaign", "customer_id"
        )
    )


def guest_vs_registered(shop: DataFrame, hash_col: str = "order_email_hash") -> DataFrame:
    return shop.groupBy(
        F.when(F.col(hash_col).isNull(), "NULL (Guest Checkout)").otherwise("Has Email Hash").alias("email_status")
    ).agg(
        F.count("*").alias("order_count"),
        average("order_value").alias("avg_order_value"),
        F.sum("order_value").alias("total_revenue"),
    )


# --------------------------------------------------------------- attribution reports
def customer_journey(utm: DataFrame) -> DataFrame:
    return (
        utm.filter(F.col("first_utm_source").isNotNull())
        .groupBy("first_utm_source", "last_utm_source")
        .agg(
            F.count("*").alias("orders"),
            average("days_to_conversion").alias("avg_days_to_convert"),
            F.sum("total_price").alias("total_revenue"),
        )
    )


def new_vs_returning(utm: DataFrame) -> DataFrame:
    kind = F.when(F.col("customer_order_index") == 1, "New Customer").otherwise("Returning")
    return utm.groupBy(kind.alias("customer_type"), "first_utm_source").agg(
        F.count("*").alias("orders"), F.sum("total_price").alias("revenue"), average("total_price").alias("aov")
    )


def revenue_by_attribution_status(utm: DataFrame) -> DataFrame:
    return utm.groupBy("attribution_status").agg(
        F.count("*").alias("order_count"),
        F.sum("total_price").alias("total_revenue"),
        average("total_price").alias("avg_order_value"),
    )


def channel_by_month(utm: DataFrame, since) -> DataFrame:
    return (
        utm.filter(F.col("created_at") >= as_timestamp(since))
        .groupBy(F.date_format("created_at", "yyyy-MM").alias("month"), "sales_channel")
        .agg(F.count("*").alias("orders"), F.sum("total_price").alias("revenue"))
    )


def orders_without_channel_by_year(utm: DataFrame) -> DataFrame:
    return (
        utm.filter(F.col("sales_channel").isNull())
        .groupBy(F.year("created_at").cast("bigint").alias("year"))
        .agg(F.count("*").alias("orders_without_channel"))
    )


def attribution_status_distribution(utm: DataFrame, by_channel: bool = False) -> DataFrame:
    keys = ["attribution_status", "sales_channel"] if by_channel else ["attribution_status"]
    return utm.groupBy(*keys).agg(F.count("*").alias("order_count"))


def unknown_channel_profile(utm: DataFrame, n: int = 20) -> DataFrame:
    return (
        utm.filter(F.col("attribution_status") == "UNKNOWN_CHANNEL")
        .groupBy("sales_channel")
        .agg(
            F.count("*").alias("order_count"),
            F.min("created_at").alias("first_order"),
            F.max("created_at").alias("last_order"),
        )
        .orderBy(F.col("order_count").desc(), F.col("sales_channel").asc_nulls_first())
        .limit(n)
    )


def unknown_channel_samples(utm: DataFrame, n: int = 20) -> DataFrame:
    return (
        utm.filter(F.col("attribution_status") == "UNKNOWN_CHANNEL")
        .orderBy(F.col("created_at").desc(), "order_id")
        .limit(n)
        .select("order_id", "order_name", "created_at", "total_price")
    )


def revenue_by_utm_source(utm: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        utm.filter(
            F.col("first_utm_source").isNotNull()
            & (F.col("created_at").cast("date") >= F.date_sub(as_date(as_of), days))
        )
        .groupBy("first_utm_source")
        .agg(F.count("*").alias("orders"), F.sum("total_price").alias("revenue"))
    )


def utm_coverage(shop_consistent: DataFrame, as_of, days: int = 30) -> DataFrame:
    recent = shop_consistent.filter(F.col("order_date") >= F.date_sub(as_date(as_of), days))
    with_utm = F.count("utm_source")
    return recent.agg(
        F.count("*").alias("total_orders"),
        with_utm.alias("orders_with_utm"),
        percent(with_utm, F.count("*")).alias("utm_coverage_pct"),
    )


def utm_extract_status(utm: DataFrame, as_of) -> DataFrame:
    day_before = as_timestamp(as_of) - F.expr("INTERVAL 24 HOUR")
    return utm.agg(
        F.max("extracted_at").alias("last_extraction"),
        F.count_if(F.col("created_at") >= day_before).alias("recent_orders"),
    )


# ------------------------------------------------------------------- whole-table totals
def order_totals(history: DataFrame) -> DataFrame:
    """Whole-table summary; days and customers are counted in one reading."""
    dated = history.select(F.col("created_at").cast("date").alias("day"), "customer_id", "total_price", F.lit(1).alias("one"))
    keyed = _by_key(dated, {"day": "day", "customer": "customer_id"}, ["total_price", "one"])
    per_key = keyed.groupBy("kind", "key").agg(F.sum("one").alias("n"), F.sum("total_price").alias("value"))
    known, is_day = F.col("key").isNotNull(), F.col("kind") == "day"
    day = F.when(is_day, F.col("key").cast("date"))
    return per_key.agg(
        F.sum("n").alias("total_orders"),
        F.count_if(is_day & known).alias("days"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.sum("value").alias("total_revenue"),
        F.count_if(~is_day & known).alias("unique_customers"),
    )


def utm_totals(utm: DataFrame) -> DataFrame:
    day = F.col("created_at").cast("date")
    return utm.agg(
        F.count("*").alias("total_records"),
        F.count("first_utm_source").alias("with_utm"),
        percent(F.count("first_utm_source"), F.count("*")).alias("utm_rate"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.sum("total_price").alias("total_revenue"),
    )


# Columns of the unified orders that `shop_verify` reads.
VERIFY_COLUMNS = ("order_id", "customer_id", "order_value", "order_net_value")


def shop_verify(shop: DataFrame) -> DataFrame:
    values = ["order_value", "order_net_value", "one"]
    narrow = shop.select(*VERIFY_COLUMNS, F.lit(1).alias("one"))
    keyed = _by_key(narrow, {"order": "order_id", "customer": "customer_id"}, values)
    per_key = keyed.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in values])
    distinct = lambda kind: F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())
    return per_key.agg(
        F.lit("shopify_unified").alias("table_name"),
        F.sum("one").alias("row_count"),
        distinct("order").alias("unique_orders"),
        F.sum("order_value").alias("total_gmv"),
        F.sum("order_net_value").alias("total_net_gmv"),
        distinct("customer").alias("unique_customers"),
    )


# ---------------------------------------------------------------------------- segments
def customer_segments(shop: DataFrame) -> DataFrame:
    """New and returning customers: how many, what they bought, and their shares."""
    kind = F.when(F.col("customer_order_count_shopify") > 1, "Returning").otherwise("New")
    per_customer = (
        shop.filter(F.col("customer_id").isNotNull())
        .groupBy(kind.alias("segment"), "customer_id")
        .agg(F.count("*").alias("n"), F.sum("order_net_value").alias("net"), F.sum("order_value").alias("value"))
    )
    per_segment = per_customer.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.sum("n").alias("orders"),
        F.sum("net").alias("revenue"),
        divide(F.sum("value"), F.sum("n")).alias("aov"),
    )
    share = lambda c: percent(F.col(c), F.sum(c).over(Window.partitionBy()))  # noqa: E731  over two rows
    return per_segment.withColumns({"customer_share_pct": share("customers"), "revenue_share_pct": share("revenue")})


def region_performance(shop_geo: DataFrame, as_of, n: int = 5) -> DataFrame:
    """Busiest regions over the last year, with the change on the year before."""
    day, end = F.col("order_date"), as_date(as_of)
    this_year = day > F.add_months(end, -12)
    last_year = ~this_year & (day > F.add_months(end, -24))
    value = lambda cond: F.sum(F.when(cond, F.col("order_value")))
    per_region = (
        shop_geo.filter(F.col("shipping_province").isNotNull() & (this_year | last_year))
        .groupBy(F.col("shipping_province").alias("region"))
        .agg(
            value(this_year).alias("revenue"),
            F.count_if(this_year).alias("orders"),
            value(last_year).alias("_before"),
        )
    )
    return (
        per_region.select(
            "region",
            "revenue",
            "orders",
            divide(F.col("revenue"), F.col("orders")).alias("aov"),
            percent(F.col("revenue") - F.col("_before"), F.col("_before")).alias("yoy_pct"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "region")
        .limit(n)
    )


def event_funnel(events: DataFrame, steps=("page_view", "view_item", "add_to_cart", "purchase")) -> DataFrame:
    return (
        events.filter(F.col("event_name").isin(*steps))
        .groupBy("event_name")
        .agg(F.count("*").alias("event_count"), F.count_distinct("user_pseudo_id").alias("unique_users"))
    )


def conversion_source_split(conversions: DataFrame, as_of, days: int = 7, event: str = "purchase") -> DataFrame:
    recent = conversions.filter(
        (F.col("event_name") == event) & (F.col("date") >= F.date_sub(as_date(as_of), days))
    )
    return recent.agg(
        F.count("*").alias("total_purchases"),
        F.count_if(F.col("attribution_source") == "pixel").alias("pixel_purchases"),
        F.count_if(F.col("attribution_source") == "api").alias("api_purchases"),
    )
