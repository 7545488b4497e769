"""Sales-channel classification as expressions: no row leaves codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.joins import left_join_spread

from martlet.functions import has_text

UNKNOWN = "UNKNOWN_CHANNEL"

# Channel handles and the status they stand for.
STATUS_BY_CHANNEL = {
    "AMAZON_NO_TRACKING": ("amazon-us", "amazon", "amazon-ca", "amazon-uk"),
    "TIKTOK_SHOP": ("tiktok",),
    "SHOP_APP": ("shop",),
    "MANUAL_ORDER": ("shopify_draft_order",),
    "POS_ORDER": ("pos", "point_of_sale"),
}
ONLINE = ("web", "online_store")

# Prices typical of marketplace orders.
MARKETPLACE_PRICES = (96, 109, 121, 138, 139, 140, 149)


def attribution_status(source: Column, channel: Column, landing_page: Column) -> Column:
    """Status of a newly extracted order: tracking first, then channel, then landing page."""
    return (
        F.when(has_text(source), "HAS_UTM")
        .when(channel.isin("amazon-us", "amazon"), "AMAZON_NO_TRACKING")
        .when(channel == "shopify_draft_order", "MANUAL_ORDER")
        .when(channel == "tiktok", "TIKTOK_SHOP")
        .when(has_text(landing_page), "DIRECT_OR_ORGANIC")
        .otherwise(UNKNOWN)
    )


def classify(utm: DataFrame) -> DataFrame:
    return utm.withColumn(
        "attribution_status",
        attribution_status(F.col("first_utm_source"), F.col("sales_channel"), F.col("first_landing_page")),
    )


def reclassify_unknown_channels(utm: DataFrame) -> DataFrame:
    """Give rows still unknown a status from their channel; rows without a channel stay unknown."""
    channel = F.col("sales_channel")
    known = None
    for status, handles in STATUS_BY_CHANNEL.items():
        cond = channel.isin(*handles)
        known = F.when(cond, status) if known is None else known.when(cond, status)
    online = F.when(F.col("first_utm_source").isNotNull(), "HAS_UTM").otherwise("DIRECT_OR_ORGANIC")
    known = known.when(channel.isin(*ONLINE), online).when(channel.isNotNull(), "OTHER_CHANNEL").otherwise(UNKNOWN)
    status = F.col("attribution_status")
    return utm.withColumn("attribution_status", F.when(status == UNKNOWN, known).otherwise(status))


def reclassify_from_extract(utm: DataFrame, extract: DataFrame) -> DataFrame:
    """Set channel and status of unknown orders from an extract of (order_id, channel_handle)."""
    handle = F.col("channel_handle")
    web = handle == "web"
    found = (
        F.when(handle.isin("amazon-us", "amazon"), "AMAZON_NO_TRACKING")
        .when(handle == "shopify_draft_order", "MANUAL_ORDER")
        .when(handle == "tiktok", "TIKTOK_SHOP")
        .when(web & F.col("first_landing_page").isNotNull(), "DIRECT_OR_ORGANIC")
        .when(web & F.col("first_utm_source").isNotNull(), "HAS_UTM")
        .otherwise("OTHER_CHANNEL")
    )
    hit = (F.col("attribution_status") == UNKNOWN) & F.col("_hit")
    e = extract.select(F.col("order_id").alias("_extract_id"), "channel_handle", F.lit(True).alias("_hit"))
    return (
        left_join_spread(utm, e, "order_id", "_extract_id")
        .withColumn("sales_channel", F.when(hit, handle).otherwise(F.col("sales_channel")))
        .withColumn("attribution_status", F.when(hit, found).otherwise(F.col("attribution_status")))
        .drop("channel_handle", "_hit")
    )


def infer_channel_by_price(utm: DataFrame, prices: Sequence[float] = MARKETPLACE_PRICES) -> DataFrame:
    """Orders without channel, source or landing page at a marketplace price are taken to be marketplace orders."""
    bare = (
        F.col("sales_channel").isNull() & F.col("first_utm_source").isNull() & F.col("first_landing_page").isNull()
    )
    hit = bare & F.col("total_price").isin(*prices)
    return utm.withColumns(
        {
            "sales_channel": F.when(hit, "amazon-us (inferred)").otherwise(F.col("sales_channel")),
            "attribution_status": F.when(hit, "AMAZON_NO_TRACKING").otherwise(F.col("attribution_status")),
        }
    )
