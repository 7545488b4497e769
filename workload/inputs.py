"""Domain tables derived from the given Parquet tables.

The given tables are a generic order/customer/event set. Each property maps them
onto one extract the jobs work on (orders, customers, ad reports, ...), always
over every row. `oracle_views.py` holds the same mapping as DuckDB SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import as_timestamp, json_decimal, json_long, money
from martlet.operators import conform, dedup, pii, unify
from martlet.plans import commerce, marketing
from martlet.session import shared_folder
from martlet.sources import tables

# Dates every report is asked for; the jobs never look at the clock.
AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"
BASELINE_AS_OF = "2024-01-15 00:00:00"


def txt(c: Column) -> Column:
    return c.cast("string")


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def pick(key: Column, choices: dict[int, str]) -> Column:
    out = None
    for k, v in choices.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


def versions(old_exists: Column) -> Column:
    """Extract numbers of a row: always 2, and 1 too where an older copy exists."""
    return F.explode(F.when(old_exists, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(2))))


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.sf_dir, name)

    def land(self, *names: str, shop_columns: Sequence[str] | None = None) -> list[DataFrame]:
        """Layers written once and read back, for queries that use them more than once.

        Layers asked for later, also in this call, build on the landed ones. Of the unified orders `shop_columns` are landed,
        those that the query reads: others would be carried through every join on the way, text lists above all.
        """
        for name in names:
            folder = f"{shared_folder(self.spark)}/layer-{name}-{uuid.uuid4().hex}"
            layer = getattr(self, name)
            if name == "shop" and shop_columns is not None:
                layer = layer.select(*dict.fromkeys(shop_columns))
            self.__dict__[name] = tables.write_table(layer, folder)
        return [getattr(self, name) for name in names]

    # ------------------------------------------------------------ shop extracts
    @staticmethod
    def customer_columns() -> dict[str, Column]:
        """Customer fields over the columns of customer and nation joined."""
        key = F.col("c_custkey")
        owner = F.when(key % 97 == 1, key - 1).otherwise(key)
        address = cat(
            '{"country":"', F.col("n_name"), '","city":"City', txt(key % 30), '","province":"P', txt(key % 12), '"}'
        )
        return {
            "id": key,
            "email": F.when(key % 10 == 7, None)
            .when(key % 10 == 8, "")
            .when(key % 3 == 0, cat("  CUST", txt(owner), "@Example.COM "))
            .otherwise(cat("cust", txt(owner), "@example.com")),
            "phone": F.when(key % 4 != 0, cat("+1555", F.lpad(txt(key), 7, "0"))),
            "first_name": F.when(key % 9 != 0, cat("First", txt(key % 50))),
            "last_name": cat("Last", txt(key % 200)),
            "addresses": F.when(key % 5 != 2, cat("[", address, "]")),
            "default_address": F.when(key % 6 != 1, address),
            "state": F.when(key % 2 == 0, "enabled").otherwise("disabled"),
            "tags": F.col("c_mktsegment"),
            "orders_count": key % 4,
            "total_spent": F.when(key % 6 == 0, F.lit(0)).otherwise(F.col("c_acctbal")).cast("decimal(18,2)"),
            "accepts_marketing": key % 5 != 0,
            "verified_email": key % 3 != 0,
            "email_marketing_consent": F.when(
                key % 3 == 0, '{"state":"subscribed","consent_updated_at":"2000-01-01"}'
            ),
            "sms_marketing_consent": F.when(
                key % 7 == 0, '{"state":"not_subscribed","consent_updated_at":"2000-02-02"}'
            ),
            "created_at": as_timestamp("1995-01-02 00:00:00"),
        }

    def with_nation(self, df: DataFrame, key: str) -> DataFrame:
        return df.join(self.table("nation").select(F.col("n_nationkey").alias(key), "n_name"), key)

    def with_customer(self, orders: DataFrame, *fields: str) -> DataFrame:
        """Orders with customer fields beside them, named `c_<field>`.

        One dimension joins at a time: Spark sizes a join of two dimensions as their
        product, and would then pick the wrong side to send around.
        """
        j = self.with_nation(orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey")), "c_nationkey")
        columns = self.customer_columns()
        return j.select(*orders.columns, *[columns[f].alias(f"c_{f}") for f in fields])

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self.customers_from(self.table("customer"))

    def customers_from(self, customer: DataFrame) -> DataFrame:
        """Customer extract over the customer table, batch or stream; the nations are 25 rows."""
        c = self.with_nation(customer, "c_nationkey")
        base = c.select(*[col.alias(name) for name, col in self.customer_columns().items()])
        v = base.withColumn("extract_no", versions(F.col("tags") == "BUILDING"))
        latest = F.col("extract_no") == 2
        return (
            v.withColumn("tags", F.when(latest, F.col("tags")).otherwise("OLD"))
            .withColumn(
                "extracted_at",
                F.when(latest, as_timestamp("2001-08-01 00:00:00")).otherwise(as_timestamp("2001-07-01 00:00:00")),
            )
            .withColumn("updated_at", F.col("extracted_at") - F.expr("INTERVAL 1 DAY"))
            .drop("extract_no")
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        fields = ("email", "phone", "first_name", "default_address")
        return self.shape_orders(self.with_customer(self.table("orders"), *fields))

    @staticmethod
    def shape_orders(o: DataFrame) -> DataFrame:
        key, price, day = F.col("o_orderkey"), money("o_totalprice"), F.col("o_orderdate")
        v = o.withColumn("extract_no", versions(F.col("o_orderpriority") == "1-URGENT"))
        latest = F.col("extract_no") == 2
        email = F.when(key % 13 != 0, F.upper("c_email"))
        cancelled = key % 20 == 0
        return v.select(
            key.alias("id"),
            cat("gid://shopify/Order/", txt(key)).alias("admin_graphql_api_id"),
            F.when(key % 5 == 0, cat("X-", txt(key), "-1"))
            .when(key % 11 == 0, cat("D", txt(key)))
            .otherwise(cat("#", txt(key)))
            .alias("name"),
            email.alias("email"),
            email.alias("contact_email"),
            F.col("c_phone").alias("phone"),
            F.when(key % 8 == 0, None)
            .when(key % 8 == 1, "")
            .otherwise(cat("10.0.", txt(F.col("o_custkey") % 5), ".", txt(F.col("o_custkey") % 40)))
            .alias("browser_ip"),
            F.when(key % 17 == 0, cat('{"email":"', F.col("c_email"), '","first_name":"', F.col("c_first_name"), '"}')).alias(
                "customer"
            ),
            F.col("o_custkey").alias("user_id"),
            F.col("c_default_address").alias("billing_address"),
            F.col("c_default_address").alias("shipping_address"),
            pick(key % 4, {0: "web", 1: "tiktok", 2: "shopify_draft_order"}).alias("source_name"),
            F.col("o_orderstatus").alias("financial_status"),
            F.when(F.col("o_orderstatus") == "F", "fulfilled").alias("fulfillment_status"),
            F.when(key % 50 == 0, "test").otherwise(F.col("o_orderpriority")).alias("tags"),
            F.lit("USD").alias("currency"),
            F.when(key % 3 == 0, cat("/p/", txt(key % 10))).alias("landing_site"),
            F.when(key % 7 == 0, "https://search.example.com").alias("referring_site"),
            (F.when(key % 40 == 0, F.lit(0)).otherwise(price + F.col("extract_no") - 2))
            .cast("decimal(18,2)")
            .alias("total_price"),
            price.alias("total_line_items_price"),
            F.when(key % 80 == 0, price).otherwise((key % 7).cast("decimal(18,2)")).alias("current_total_discounts"),
            (key % 9).cast("decimal(18,2)").alias("total_tax"),
            F.struct(txt((key % 9).cast("decimal(18,2)")).alias("amount"), F.lit("USD").alias("currency")).alias(
                "total_shipping_price_set"
            ),
            day.alias("created_at"),
            (day + F.expr("INTERVAL 1 HOUR")).alias("processed_at"),
            F.when(cancelled, day + F.expr("INTERVAL 1 DAY")).alias("cancelled_at"),
            F.when(F.col("o_orderstatus") == "F", day + F.expr("INTERVAL 5 DAY")).alias("closed_at"),
            F.when(cancelled, "customer").alias("cancel_reason"),
            F.when(latest, day + F.expr("INTERVAL 2 DAY")).otherwise(day + F.expr("INTERVAL 1 DAY")).alias(
                "extracted_at"
            ),
        )

    @cached_property
    def order_history(self) -> DataFrame:
        """Orders as the shop's older bulk export gave them, with customer fields inline."""
        key = F.col("o_orderkey")
        o = self.with_customer(self.table("orders"), "email", "first_name", "last_name", "default_address")
        return o.select(
            key.alias("id"),
            cat("#", txt(key)).alias("name"),
            F.col("o_orderdate").alias("created_at"),
            F.lit("USD").alias("currency_code"),
            money("o_totalprice").alias("total_price"),
            txt(F.col("o_custkey")).alias("customer_id"),
            F.col("c_email").alias("customer_email"),
            F.col("c_first_name").alias("customer_first_name"),
            F.col("c_last_name").alias("customer_last_name"),
            F.get_json_object("c_default_address", "$.country").alias("shipping_country"),
            F.get_json_object("c_default_address", "$.city").alias("shipping_city"),
            F.lpad(txt(key % 1000), 5, "0").alias("shipping_zip"),
        )

    @cached_property
    def line_items(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        gid = cat("gid://shopify/Order/", txt(F.col("l_orderkey")))
        return (
            self.table("lineitem")
            .join(part, "l_partkey")
            .select(
                gid.alias("order_id"),
                gid.alias("admin_graphql_api_order_id"),
                F.col("l_linenumber").alias("line_no"),
                F.col("l_partkey").alias("product_id"),
                cat("SKU-", txt(F.col("l_partkey"))).alias("sku"),
                F.col("p_name").alias("title"),
                F.col("l_quantity").cast("decimal(18,2)").cast("bigint").alias("quantity"),
                money("l_extendedprice").alias("original_total"),
            )
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.when(F.col("l_returnflag") == "A", "shopify_payments")
            .when(F.col("l_returnflag") == "N", "paypal")
            .otherwise("gift_card")
            .alias("gateway"),
            F.when(F.col("l_linestatus") == "F", "success").otherwise("pending").alias("status"),
            F.when(F.col("l_linenumber") % 2 == 0, "sale").otherwise("capture").alias("kind"),
            txt(money("l_extendedprice")).alias("amount"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def refunds(self) -> DataFrame:
        return (
            self.table("lineitem")
            .filter(F.col("l_returnflag") == "R")
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.when(F.col("l_linenumber") == 1, "[]")
                .otherwise(cat('[{"amount":"', txt(money("l_quantity")), '"}]'))
                .alias("transactions"),
                F.col("l_shipdate").alias("created_at"),
            )
        )

    @cached_property
    def utm(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        gid = cat("gid://shopify/Order/", txt(key))
        channel = pick(
            key % 10,
            {
                0: "amazon-us",
                1: "tiktok",
                2: "shop",
                3: "web",
                4: "shopify_draft_order",
                5: "pos",
                6: "marketplace",
                7: "amazon-ca",
            },
        )
        page = F.when(key % 3 == 0, cat("https://example.com/p/", txt(key % 10)))
        return self.table("orders").select(
            gid.alias("order_id"),
            gid.alias("admin_graphql_api_id"),
            cat("#", txt(key)).alias("order_name"),
            day.alias("created_at"),
            money("o_totalprice").alias("total_price"),
            pick(key % 6, {0: "facebook", 1: "tiktok", 2: "google", 3: "Facebook"}).alias("first_utm_source"),
            F.when(key % 6 < 4, "cpc").alias("first_utm_medium"),
            F.when(key % 6 < 4, cat("c", txt(key % 12))).alias("first_utm_campaign"),
            F.lit(None).cast("string").alias("first_utm_content"),
            F.lit(None).cast("string").alias("first_utm_term"),
            page.alias("first_landing_page"),
            F.when(key % 7 == 0, "https://search.example.com").alias("first_referrer_url"),
            day.alias("first_visit_at"),
            pick(key % 5, {0: "facebook", 1: "email"}).alias("last_utm_source"),
            F.when(key % 5 == 0, "cpc").alias("last_utm_medium"),
            F.when(key % 5 == 0, cat("c", txt(key % 12))).alias("last_utm_campaign"),
            page.alias("last_landing_page"),
            day.alias("last_visit_at"),
            F.when(
                key % 6 < 4,
                cat("utm_source=s", txt(key % 6), "&utm_medium=cpc&utm_campaign=c", txt(key % 12)),
            ).alias("landing_site_ref_params"),
            channel.alias("sales_channel"),
            F.upper(channel).alias("sales_channel_name"),
            F.when(key % 4 == 3, "HAS_UTM").otherwise("UNKNOWN_CHANNEL").alias("attribution_status"),
            (key % 3 + 1).alias("customer_order_index"),
            (key % 30).alias("days_to_conversion"),
            (day + F.expr("INTERVAL 1 DAY")).alias("extracted_at"),
        )

    @cached_property
    def products(self) -> DataFrame:
        cost = txt(money("p_size"))
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("vendor"),
            cat('[{"sku":"SKU-', txt(F.col("p_partkey")), '","cost":"', cost, '"}]').alias("variants"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.products.select("product_id", json_decimal("variants", "$[0].cost").alias("cost"))

    # -------------------------------------------------------------- ad extracts
    @cached_property
    def raw_ads(self) -> DataFrame:
        supplier = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        lines = self.with_nation(self.table("lineitem").join(supplier, "l_suppkey"), "s_nationkey")
        part, supp, line, qty = (
            F.col("l_partkey"),
            F.col("l_suppkey"),
            F.col("l_linenumber"),
            F.col("l_quantity").cast("decimal(18,2)").cast("bigint"),
        )
        campaign = pick(
            part % 5, {0: "uk_prospecting", 1: "eu_remarketing", 2: "Catalogue_smart", 3: "brand_search", 4: "boosting"}
        )
        day = F.col("l_shipdate").cast("date")
        return (
            lines.select(
                txt(supp % 3).alias("account_id"),
                cat("account ", txt(supp % 3)).alias("account_name"),
                txt(part % 5).alias("campaign_id"),
                campaign.alias("campaign_name"),
                txt(part % 10).alias("adset_id"),
                cat("adset ", txt(part % 10)).alias("adset_name"),
                txt(part % 40).alias("ad_id"),
                cat("ad ", txt(part % 40)).alias("ad_name"),
                F.col("n_name").alias("country"),
                cat("dma", txt(part % 4)).alias("dma"),
                F.when(part % 3 == 0, "purchase").otherwise("add_to_cart").alias("action_type"),
                F.when(supp % 2 == 0, "facebook").otherwise("instagram").alias("publisher_platform"),
                F.when(part % 2 == 0, "mobile").otherwise("desktop").alias("device_platform"),
                day.alias("date_start"),
                day.alias("date_stop"),
                txt(money("l_extendedprice")).alias("spend"),
                (qty * 100).alias("impressions"),
                (qty % 7).alias("clicks"),
                (qty * 50).alias("reach"),
                F.when(
                    line % 4 != 0, cat('[{"action_type":"purchase","value":"', txt(line % 4), '.5"}]')
                ).alias("purchase_roas"),
                cat('[{"action_type":"purchase","value":"', txt(line % 3), '"}]').alias("actions"),
                line.alias("extract_no"),
                F.col("l_orderkey").alias("tie1"),
                part.alias("tie2"),
                supp.alias("tie3"),
                money("l_extendedprice").alias("tie4"),
            )
        )

    @cached_property
    def raw_ads_json(self) -> DataFrame:
        return self.shape_ads_json(self.table("lineitem"))

    @staticmethod
    def shape_ads_json(lineitem: DataFrame) -> DataFrame:
        part, line = F.col("l_partkey"), F.col("l_linenumber")
        qty = F.col("l_quantity").cast("decimal(18,2)").cast("bigint")
        name = pick(part % 5, {0: "prospecting", 1: "remarketing", 2: "Catalog", 3: "search", 4: "misc"})
        metrics = {
            "campaign_name": cat(name, txt(part % 5)),
            "adgroup_name": cat("group", txt(part % 10)),
            "ad_name": cat("ad", txt(part % 30)),
            "spend": txt(money("l_extendedprice")),
            "impressions": txt(qty * 100),
            "clicks": txt(qty % 7),
            "conversion": txt(line % 3),
            "complete_payment": txt(line % 2),
            "cost_per_conversion": txt(money("l_tax")),
            "cpc": txt(money("l_tax")),
            "cpm": txt(money("l_discount")),
            "ctr": txt(money("l_discount")),
            "reach": txt(qty * 50),
            "video_play_actions": txt(qty * 10),
            "video_views_p25": txt(qty * 8),
            "video_views_p50": txt(qty * 6),
            "video_views_p75": txt(qty * 4),
            "video_views_p100": txt(qty * 2),
            "average_video_play": txt(money("l_discount")),
            "likes": txt(qty % 11),
            "comments": txt(qty % 3),
            "shares": txt(qty % 5),
            "engagements": txt(qty % 13),
        }
        parts: list[Column | str] = []
        for i, (k, v) in enumerate(metrics.items()):
            parts += [("{" if i == 0 else ",") + f'"{k}":"', v, '"']
        return lineitem.select(
            (part % 30).alias("ad_id"),
            (part % 10).alias("adgroup_id"),
            (part % 5).alias("campaign_id"),
            F.lit(7).cast("bigint").alias("advertiser_id"),
            F.col("l_shipdate").alias("stat_time_day"),
            cat(*parts, "}").alias("metrics"),
            line.alias("extract_no"),
            F.col("l_orderkey").alias("tie1"),
            part.alias("tie2"),
            F.col("l_suppkey").alias("tie3"),
            money("l_extendedprice").alias("tie4"),
        )

    @cached_property
    def campaign_stats(self) -> DataFrame:
        line, price = F.col("l_linenumber"), money("l_extendedprice")
        qty = F.col("l_quantity").cast("decimal(18,2)").cast("bigint")
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("date").alias("segments_date"),
            F.col("l_suppkey").alias("campaign_id"),
            F.when(line % 3 == 0, "MOBILE").when(line % 3 == 1, "DESKTOP").otherwise("TABLET").alias("segments_device"),
            F.when(F.col("l_linestatus") == "F", "SEARCH").otherwise("DISPLAY").alias("segments_ad_network_type"),
            (price * 10000).cast("bigint").alias("metrics_cost_micros"),
            (qty * 20).alias("metrics_impressions"),
            (qty % 5).alias("metrics_clicks"),
            (line % 2).cast("bigint").alias("metrics_conversions"),
            price.alias("metrics_conversions_value"),
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        return (
            self.table("supplier")
            .select(
                F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).otherwise(-F.col("s_suppkey") - 1).alias("campaign_id"),
                F.col("s_name").alias("campaign_name"),
                F.when(F.col("s_nationkey") % 3 == 0, "PAUSED").otherwise("ENABLED").alias("campaign_status"),
            )
        )

    def sponsored_report(self, status: str) -> DataFrame:
        """Marketplace ad report: one for sponsored products ('F'), one for brands ('O')."""
        supplier = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
        qty = F.col("l_quantity").cast("decimal(18,2)").cast("bigint")
        return (
            self.table("lineitem")
            .filter(F.col("l_linestatus") == status)
            .join(supplier, "l_suppkey")
            .select(
                F.col("l_shipdate").cast("date").alias("date"),
                F.col("l_suppkey").alias("campaign_id"),
                F.col("s_name").alias("campaign_name"),
                (qty * 20).alias("impressions"),
                (qty % 5).alias("clicks"),
                money("l_extendedprice").alias("cost"),
                (F.col("l_linenumber") % 2).cast("bigint").alias("attributed_conversions_14d"),
                (money("l_extendedprice") * F.col("l_linenumber")).cast("decimal(18,2)").alias("attributed_sales_14d"),
            )
        )

    # -------------------------------------------------------- events and syncs
    @cached_property
    def web_events(self) -> DataFrame:
        return self.shape_events(self.table("events"))

    @staticmethod
    def shape_events(events: DataFrame) -> DataFrame:
        kind = F.col("event_type")
        return events.select(
            "event_id",
            "ts",
            F.col("user_id").alias("user_pseudo_id"),
            F.when(kind == "view", "page_view")
            .when(kind == "click", "view_item")
            .when(kind == "signup", "add_to_cart")
            .otherwise(kind)
            .alias("event_name"),
            "value",
            "props",
        )

    @cached_property
    def conversions(self) -> DataFrame:
        return self.web_events.select(
            "event_id",
            "event_name",
            F.when(F.col("event_id") % 3 == 0, "pixel").otherwise("api").alias("attribution_source"),
            F.col("ts").cast("date").alias("date"),
        )

    @cached_property
    def attempts(self) -> DataFrame:
        e = self.table("events")
        job = F.expr("event_id DIV 3")
        k = json_long("props", "$.k")
        stream = (
            '{"streamName":"%s","stats":{"recordsEmitted":',
            ',"recordsCommitted":',
            "}}",
        )
        output = cat(
            '{"streamStats":[',
            stream[0] % "orders",
            txt(k * 10),
            stream[1],
            txt(k * 10),
            stream[2] + ",",
            stream[0] % "customers",
            txt(k),
            stream[1],
            txt(k - 1),
            stream[2] + "]}",
        )
        return e.select(
            job.alias("job_id"),
            (F.col("event_id") % 3).alias("attempt_no"),
            F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status"),
            F.col("ts").alias("created_at"),
            F.timestamp_add("SECOND", (F.col("event_id") % 600 + 1).cast("int"), F.col("ts")).alias("ended_at"),
            (k * 11).alias("records"),
            output.alias("output"),
        )

    @cached_property
    def sync_jobs(self) -> DataFrame:
        return (
            self.attempts.groupBy("job_id")
            .agg(F.min("created_at").alias("created_at"))
            .select("job_id", cat("conn", txt(F.col("job_id") % 3)).alias("connection"), "created_at")
        )

    def hourly_tables(self, since: str, until: str) -> DataFrame:
        """Catalogue of hourly event tables as a scan at `until` sees it; tables from before `since` were renamed."""
        e = self.web_events.filter(F.col("ts") < as_timestamp(until))
        kept = F.when(F.col("ts") >= as_timestamp(since), "").otherwise("archive_")
        return e.groupBy(
            cat(kept, F.col("event_name"), "_", F.date_format("ts", "yyyyMMddHH")).alias("table_name")
        ).agg(
            F.count_if(F.col("value") >= 20).alias("row_count"),
            F.min("ts").alias("created_at"),
            F.max("ts").alias("last_extracted_at"),
        )

    @cached_property
    def tables_now(self) -> DataFrame:
        return self.hourly_tables("2024-01-08 00:00:00", EVENTS_AS_OF)

    @cached_property
    def tables_baseline(self) -> DataFrame:
        """The earlier scan; a busy table had fewer rows then (only values of 60 and more had landed)."""
        e = self.web_events.filter(F.col("ts") < as_timestamp(BASELINE_AS_OF))
        return e.groupBy(
            cat(F.col("event_name"), "_", F.date_format("ts", "yyyyMMddHH")).alias("table_name")
        ).agg(
            F.count_if((F.col("value") >= 60) | (F.col("value") < 2)).alias("row_count"),
            F.min("ts").alias("created_at"),
        )

    # ----------------------------------------------------------- derived layers
    @cached_property
    def clean_orders(self) -> DataFrame:
        return pii.clean_orders(self.raw_orders)

    @cached_property
    def clean_customers(self) -> DataFrame:
        return pii.clean_customers(self.raw_customers)

    @cached_property
    def hashed_orders(self) -> DataFrame:
        """Raw orders after the in-place hash job: clear text and hash side by side."""
        new = self.raw_orders.withColumn("email_hash", F.lit(None).cast("string"))
        return pii.hash_missing(new, "email", "email_hash")

    @cached_property
    def hashed_customers(self) -> DataFrame:
        new = self.raw_customers.withColumn("email_hash", F.lit(None).cast("string"))
        return pii.hash_missing(new, "email", "email_hash")

    @cached_property
    def hashed_history(self) -> DataFrame:
        new = self.order_history.withColumn("email_hash", F.lit(None).cast("string"))
        return pii.hash_missing(new, "customer_email", "email_hash")

    @cached_property
    def ads(self) -> DataFrame:
        return dedup.ads_base(self.raw_ads)

    @cached_property
    def ad_report(self) -> DataFrame:
        return dedup.ad_report_json(self.raw_ads_json)

    @cached_property
    def facebook(self) -> DataFrame:
        return conform.ad_unified_facebook(self.ads)

    @cached_property
    def tiktok(self) -> DataFrame:
        return conform.ad_unified_tiktok(self.ad_report)

    @cached_property
    def google(self) -> DataFrame:
        return conform.ad_unified_google(self.campaign_stats, self.campaigns)

    @cached_property
    def amazon(self) -> DataFrame:
        return conform.ad_unified_amazon(self.sponsored_report("F"), self.sponsored_report("O"))

    @cached_property
    def ads_latest_json(self) -> DataFrame:
        """Latest report rows with the metrics still as JSON."""
        return dedup.ad_report_latest(self.raw_ads_json)

    def shop_parts(self) -> dict[str, DataFrame]:
        return {
            "orders": conform.orders_base(self.clean_orders),
            "customers": conform.customers_enhanced(self.clean_customers),
            "items": unify.items_agg(self.line_items),
            "transactions": unify.transactions_agg(self.transactions),
            "utm": unify.utm_attribution(self.utm),
            "refunds": unify.refunds_agg(self.refunds),
        }

    @cached_property
    def shop(self) -> DataFrame:
        return unify.shopify_unified(**self.shop_parts())

    @cached_property
    def email_refs(self) -> DataFrame:
        return pii.ref_email(self.clean_customers, self.clean_orders)

    @cached_property
    def shop_consistent(self) -> DataFrame:
        return unify.shopify_unified_consistent(
            orders=conform.orders_base(self.clean_orders),
            customers=conform.customers_enhanced(self.clean_customers),
            refs=self.email_refs,
            items=unify.items_agg_all(self.line_items),
            transactions=unify.transactions_agg(self.transactions, kinds=True),
            utm=conform.utm_parameters(self.utm),
            refunds=unify.refunds_agg(self.refunds),
        )

    @cached_property
    def shop_daily(self) -> DataFrame:
        return unify.shopify_daily(self.shop)

    @cached_property
    def ad_spend(self) -> DataFrame:
        return unify.daily_ad_spend({"facebook": (self.facebook, "fb_"), "tiktok": (self.tiktok, "tt_")})

    @cached_property
    def marketing(self) -> DataFrame:
        return unify.marketing_unified(self.shop_daily, self.ad_spend)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return commerce.shopify_daily_metrics(self.shop)

    @cached_property
    def monthly(self) -> DataFrame:
        return marketing.monthly_performance(self.marketing)

    @cached_property
    def products_monthly(self) -> DataFrame:
        return commerce.product_performance(self.shop)

    # ------------------------------------------------------------ reconciliation
    @cached_property
    def api_daily(self) -> DataFrame:
        """What the ad platform's own interface reports, landed as text: some campaigns differ or are missing."""
        spend = money("spend")
        factor = (
            F.when(F.col("campaign_id") == "1", F.lit("1.01"))
            .when(F.col("campaign_id") == "2", F.lit("1.05"))
            .otherwise(F.lit("1.00"))
            .cast("decimal(3,2)")
        )
        return (
            self.ads.filter(F.col("campaign_id") != "3")
            .groupBy("account_id", "campaign_id", "date_start")
            .agg(
                F.sum((spend * factor).cast("decimal(18,2)")).alias("spend"),
                F.sum("impressions").alias("impressions"),
                F.sum("clicks").alias("clicks"),
            )
            .select(
                "account_id",
                "campaign_id",
                "date_start",
                txt(F.col("spend")).alias("spend"),
                txt(F.col("impressions")).alias("impressions"),
                F.when(F.col("clicks") > 0, txt(F.col("clicks"))).alias("clicks"),
            )
        )

