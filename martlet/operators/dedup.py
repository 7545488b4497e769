"""Keep the latest version of each record of an append-only extract.

`row_number() = 1` makes Catalyst put a group limit on both sides of the shuffle,
so a map task sends at most one row per key: a key that holds a third of all rows
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import json_decimal, json_long, json_text

# Fixed value: hash buckets of keys whose lowest latest version is sent to every task, about 50 bytes each.
BUCKETS = 1 << 20
# Lowest value of a whole-number type, and how many values it has with NULL.
WHOLE = {"tinyint": (-(1 << 7), (1 << 8) + 1), "smallint": (-(1 << 15), (1 << 16) + 1), "int": (-(1 << 31), (1 << 32) + 1), "bigint": (-(1 << 63), (1 << 64) + 1)}


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    version: Sequence[str | Column],
    tiebreak: Sequence[str | Column] = (),
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the highest `version`, ties settled by `tiebreak` (also descending).

    `order_by` gives another order, the first row of which is kept.
    """
    order = order_by or [(F.col(c) if isinstance(c, str) else c).desc() for c in [*version, *tiebreak]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def order_code(df: DataFrame, order: Sequence[str]) -> Column | None:
    """The leading whole-number columns of a descending order as one DECIMAL(38,0), NULLs lowest; None if the first is not whole.

    A row with a higher code comes first; rows with equal codes are told apart by the columns that no longer fit.
    """
    code, span = None, 1
    kinds, whole = dict(df.dtypes), lambda n: F.lit(str(n)).cast("decimal(20,0)")
    for c in order:
        lowest, values = WHOLE.get(kinds[c], (0, 10**38))
        if span * values >= 10**38:
            break
        digit = F.coalesce((F.col(c).cast("decimal(20,0)") - whole(lowest - 1)).cast("decimal(20,0)"), whole(0))
        code, span = digit if code is None else (code * whole(values) + digit).cast("decimal(38,0)"), span * values
    return None if code is None else code.cast("decimal(38,0)")


def only_late(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """`df` without most of the rows that are not the latest of their key; the latest of every key stays.

    Wide rows of which most are old versions would all be sorted to find the latest. A first pass over the keys and the order alone finds
    the highest code per key, in a hash table and without a sort, and the lowest of these per hash bucket. A row below that of its
    bucket cannot be the latest of its key, whichever keys share the bucket. There are `BUCKETS` buckets however many keys there
    are, so they can be sent to every task; with many keys to a bucket more old rows stay, never fewer latest ones.
    """
    code = order_code(df, order)
    if code is None:
        return df
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    named = [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)]
    highest = df.groupBy(*named, bucket.alias("_bucket")).agg(F.max(code).alias("_code"))
    lowest = highest.groupBy("_bucket").agg(F.min("_code").alias("_least"))
    here = df.withColumns({"_own": bucket, "_code": code})
    kept = here.join(F.broadcast(lowest), F.col("_own") == F.col("_bucket")).filter("_code >= _least")
    return kept.select(*df.columns)


AD_KEY = ("ad_id", "date_start", "account_id")
VERSION = ("extract_no",)
TIES = ("tie1", "tie2", "tie3", "tie4")


def ads_base(raw_ads: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Ad insights: one row per ad, day and account, plus any breakdown dimensions."""
    keys = [*AD_KEY, *extra_keys]
    return dedup_latest(only_late(raw_ads, keys, [*VERSION, *TIES]), keys, VERSION, TIES)


def ads_action_type(raw_ads: DataFrame) -> DataFrame:
    return ads_base(raw_ads, ["action_type"])


def ads_dma(raw_ads: DataFrame) -> DataFrame:
    return ads_base(raw_ads, ["dma"])


def ads_platform_device(raw_ads: DataFrame) -> DataFrame:
    return ads_base(raw_ads, ["publisher_platform", "device_platform"])


def ads_breakdown(raw_ads: DataFrame, dims: Sequence[str]) -> DataFrame:
    return ads_base(raw_ads, dims)


def report_latest(raw: DataFrame, level: str) -> DataFrame:
    """Latest report row per day at one level: ad, adgroup, campaign or advertiser."""
    day = F.col("stat_time_day").cast("date")
    keys = [f"{level}_id", day]
    return dedup_latest(only_late(raw, keys, [*VERSION, *TIES]), keys, VERSION, TIES)


def ad_report_latest(raw: DataFrame) -> DataFrame:
    return report_latest(raw, "ad")


def ad_report_json(raw: DataFrame) -> DataFrame:
    """Latest ad report rows with the JSON metrics as typed columns."""
    m = "metrics"
    return report_latest(raw, "ad").select(
        "ad_id",
        "adgroup_id",
        "campaign_id",
        "advertiser_id",
        F.col("stat_time_day").cast("date").alias("report_date"),
        json_decimal(m, "$.spend").alias("spend"),
        json_long(m, "$.impressions").alias("impressions"),
        json_long(m, "$.clicks").alias("clicks"),
        json_long(m, "$.conversion").alias("conversions"),
        json_long(m, "$.complete_payment").alias("purchases"),
        *[json_text(m, f"$.{k}").cast("double").alias(k) for k in ("cost_per_conversion", "cpc", "cpm", "ctr")],
        json_long(m, "$.reach").alias("reach"),
    )


def clean_transactions(transactions: DataFrame) -> DataFrame:
    return dedup_latest(transactions, ["id"], ["created_at"], ["amount", "gateway", "status", "kind"])
