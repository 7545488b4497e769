"""Data-quality checks. Each gives flat rows with a status; `to_results` puts any of them
into the common result shape. Every table is scanned once per check, however many fields
it looks at. All rows count: no check works on a sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import as_date, as_timestamp, divide, hours_between, percent
from martlet.operators import checks
from martlet.operators.conform import zero_explanations
from martlet.operators.quantile import exact_median, value_counts
from martlet.operators.unify import date_spine_gaps

# Alert thresholds (percent, currency or hours).
PRICE = {"warning": 10000, "critical": 100000, "median": 1000}
NULL_RATE = {"warning": 5.0, "critical": 20.0}
SYNC_LAG = {"warning": 1, "critical": 6}
DUPLICATE_RATE = {"warning": 0.1, "critical": 1.0}
FRESH_DAYS = {"ok": 1, "warning": 3}
DAILY_VALUE = {"facebook": 20000, "tiktok": 2000, "shopify": 90000}
DAILY_ROWS = {"shopify_orders": (400, 1200), "facebook_ads": (100, 600), "tiktok_ads": (30, 150)}


def _label(df: DataFrame, check: str, table: str) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "*")


def to_results(flat: DataFrame, observed: str, warn: float | None = None, crit: float | None = None) -> DataFrame:
    """Flat check rows in the common result shape; remaining columns become details."""
    rest = [c for c in flat.columns if c not in ("check_name", "table_name", "status")]
    pairs = [x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]
    message = F.concat_ws(" ", F.lit(f"{observed} ="), F.col(observed).cast("string"))
    return flat.select(
        "check_name",
        "table_name",
        "status",
        F.col(observed).cast("double").alias("observed"),
        F.lit(warn).cast("double").alias("warn"),
        F.lit(crit).cast("double").alias("crit"),
        message.alias("message"),
        F.create_map(*pairs).cast("map<string,string>").alias("details"),
    )


# ------------------------------------------------------------------- five basic checks
def check_price_format(df: DataFrame, price: str, table: str) -> DataFrame:
    """Prices that look like cents: a high median, or single orders above the limits."""
    over = lambda limit: F.when(F.col("v") > limit, F.col("n")).otherwise(0)
    outliers = {"suspicious_count": over(PRICE["warning"]), "critical_count": over(PRICE["critical"])}
    stats = exact_median(value_counts(df, price), outliers).select(
        F.col("median").alias("median_price"),
        F.col("max_value").alias("max_price"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in outliers],
    )
    status = (
        F.when(F.col("median_price").isNull(), "WARNING")
        .when((F.col("median_price") > PRICE["median"]) | (F.col("critical_count") > 0), "CRITICAL")
        .when(F.col("suspicious_count") > 0, "WARNING")
        .otherwise("PASS")
    )
    return _label(stats.withColumn("status", status), "Price Format", table)


def check_duplicates(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Keys that occur more than once; the rate is duplicated keys per row."""
    n = F.col("n")
    stats = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.count_if(n > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("total_duplicate_rows"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        )
        .withColumn("duplicate_rate_pct", percent(F.col("duplicate_keys"), F.col("total_rows")))
    )
    graded = checks.above(F.col("duplicate_rate_pct"), DUPLICATE_RATE["warning"], DUPLICATE_RATE["critical"])
    return _label(
        stats.withColumn("status", F.when(F.col("total_rows") == 0, "WARNING").otherwise(graded)),
        "Duplicate Detection",
        table,
    )


def null_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field: NULLs and rows, from one pass."""
    one = df.agg(F.count("*").alias("total_rows"), *[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return one.unpivot(["total_rows"], list(fields), "field", "null_count").withColumn(
        "rate_pct", percent(F.col("null_count"), F.col("total_rows"))
    )


def check_null_rates(df: DataFrame, fields: Sequence[str], table: str) -> DataFrame:
    """Worst NULL rate over the given fields (the first listed, if several are equally bad)."""
    place = F.lit(0)
    for i, f in enumerate(fields):
        place = F.when(F.col("field") == f, -i).otherwise(place)
    worst = (
        null_counts(df, fields)
        .withColumn("_place", place)
        .agg(
            F.max("total_rows").alias("total_rows"),
            F.max("rate_pct").alias("max_null_rate"),
            F.max_by("field", F.struct("rate_pct", "_place")).alias("worst_field"),
        )
        .withColumn("worst_field", F.when(F.col("max_null_rate") > 0, F.col("worst_field")))
    )
    graded = checks.above(F.col("max_null_rate"), NULL_RATE["warning"], NULL_RATE["critical"])
    return _label(
        worst.withColumn("status", F.when(F.col("total_rows") == 0, "WARNING").otherwise(graded)), "Null Rate", table
    )


def check_freshness(df: DataFrame, ts: str, as_of, table: str) -> DataFrame:
    t = F.col(ts).cast("timestamp_ntz")
    stats = df.agg(
        F.max(t).alias("latest_record"), F.min(t).alias("earliest_record"), F.count("*").alias("total_records")
    ).withColumn("hours_since_last", hours_between(F.col("latest_record"), as_timestamp(as_of)))
    graded = checks.above(F.coalesce("hours_since_last", F.lit(0)), SYNC_LAG["warning"], SYNC_LAG["critical"])
    return _label(
        stats.withColumn("status", F.when(F.col("total_records") == 0, "CRITICAL").otherwise(graded)),
        "Data Freshness",
        table,
    )


def check_record_count(df: DataFrame, day: Column, table: str) -> DataFrame:
    stats = (
        df.groupBy(day.alias("d"))
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_count"), F.count("d").alias("unique_days"))
    )
    return _label(
        stats.withColumn("status", F.when(F.col("total_count") == 0, "WARNING").otherwise("PASS")),
        "Record Count",
        table,
    )


def summarise_checks(results: DataFrame) -> DataFrame:
    """Counts per status and the overall verdict, worst first."""
    n = lambda s: F.count_if(F.col("status") == s)
    return results.agg(
        F.count("*").alias("total_checks"),
        n("PASS").alias("passed"),
        n("WARNING").alias("warnings"),
        n("CRITICAL").alias("critical"),
        n("ERROR").alias("errors"),
    ).withColumn(
        "overall_status",
        F.when(F.col("critical") > 0, "CRITICAL")
        .when(F.col("warnings") > 0, "WARNING")
        .when(F.col("errors") > 0, "ERROR")
        .otherwise("PASS"),
    )


@dataclass
class Platform:
    """What the basic checks need to know about one source."""

    name: str
    df: DataFrame
    keys: Sequence[str]
    day: str
    critical_fields: Sequence[str]
    price: str | None = None
    enabled: bool = True


def _result(table: str, check: str, status: Column, observed: str, values: Mapping[str, Column], warn=None, crit=None) -> Column:
    """One result in the common shape, as a struct."""
    details = [x for name, v in values.items() for x in (F.lit(name), v.cast("string"))]
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        status.alias("status"),
        values[observed].cast("double").alias("observed"),
        F.lit(warn).cast("double").alias("warn"),
        F.lit(crit).cast("double").alias("crit"),
        F.concat_ws(" ", F.lit(f"{observed} ="), values[observed].cast("string")).alias("message"),
        F.create_map(*details).cast("map<string,string>").alias("details"),
    )


def scan_checks(p: Platform, as_of, inside: Column) -> DataFrame:
    """NULL rates, freshness and record count of a platform from one reading, added up per day and then over days.

    `inside` says which days (column `d`) the NULL rates and the count are asked for; freshness looks at all rows.
    """
    t = F.col(p.day).cast("timestamp_ntz")
    nulls = {f: f"_null{i}" for i, f in enumerate(p.critical_fields)}
    per_day = p.df.groupBy(F.col(p.day).cast("date").alias("d")).agg(
        F.count("*").alias("n"),
        F.max(t).alias("latest"),
        F.min(t).alias("earliest"),
        *[F.count_if(F.col(f).isNull()).alias(name) for f, name in nulls.items()],
    )
    within = lambda c: F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0))
    whole = per_day.agg(
        F.max("latest").alias("latest_record"),
        F.min("earliest").alias("earliest_record"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        within("n").alias("total_count"),
        F.count(F.when(inside, F.col("d"))).alias("unique_days"),
        *[within(name).alias(name) for name in nulls.values()],
    )
    rates = [
        F.struct(percent(F.col(name), F.col("total_count")).alias("rate"), F.lit(-i).alias("place"), F.lit(f).alias("field"))
        for i, (f, name) in enumerate(nulls.items())
    ]
    worst = F.array_max(F.array(*rates))
    rate, empty = worst["rate"], F.col("total_count") == 0
    hours = hours_between(F.col("latest_record"), as_timestamp(as_of))
    null_rate = {"total_rows": F.col("total_count"), "max_null_rate": rate, "worst_field": F.when(rate > 0, worst["field"])}
    fresh = {c: F.col(c) for c in ("latest_record", "earliest_record", "total_records")} | {"hours_since_last": hours}
    late = checks.above(F.coalesce(hours, F.lit(0)), SYNC_LAG["warning"], SYNC_LAG["critical"])
    results = [
        _result(
            p.name, "Null Rate", F.when(empty, "WARNING").otherwise(checks.above(rate, *NULL_RATE.values())),
            "max_null_rate", null_rate, *NULL_RATE.values(),
        ),
        _result(
            p.name, "Data Freshness", F.when(F.col("total_records") == 0, "CRITICAL").otherwise(late),
            "hours_since_last", fresh, *SYNC_LAG.values(),
        ),
        _result(
            p.name, "Record Count", F.when(empty, "WARNING").otherwise("PASS"),
            "total_count", {c: F.col(c) for c in ("total_count", "unique_days")},
        ),
    ]
    return whole.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def run_checks(platforms: Sequence[Platform], as_of, start=None, end=None) -> DataFrame:
    """All basic checks over all enabled platforms, in the common result shape.

    Per platform the table is read for its keys, for its prices if it has any, and once for all the rest.
    """
    parts = []
    for p in platforms:
        if not p.enabled:
            continue
        df, inside = p.df, F.lit(True)
        if start is not None and end is not None:
            df = df.filter(F.col(p.day).cast("date").between(as_date(start), as_date(end)))
            inside = F.coalesce(F.col("d").between(as_date(start), as_date(end)), F.lit(False))
        if p.price:
            parts.append(to_results(check_price_format(df, p.price, p.name), "median_price", PRICE["warning"], PRICE["critical"]))
        parts += [
            to_results(check_duplicates(df, p.keys, p.name), "duplicate_rate_pct", *DUPLICATE_RATE.values()),
            scan_checks(p, as_of, inside),
        ]
    return checks.union(parts)


# ---------------------------------------------------------------------- audit variants
def dup_by_distinct(df: DataFrame, keys: Sequence[str], table: str, raw: bool = False) -> DataFrame:
    """Rows beyond one per key. A raw extract is expected to repeat itself and only warns.

    Rows with a NULL in the key have no key and count as repeats.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    stats = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("total"), F.count_if(whole).alias("distinct_keys"))
        .withColumn("duplicates", F.col("total") - F.col("distinct_keys"))
        .withColumn("pct", percent(F.col("duplicates"), F.col("total")))
    )
    status = F.when(F.col("duplicates") == 0, "PASS")
    status = status.otherwise("WARNING") if raw else status.when(F.col("pct") < 1, "WARNING").otherwise("FAIL")
    return _label(stats.withColumn("status", status), "Duplicates", table)


def repeated_keys(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    n = F.col("n")
    stats = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(n > 1).alias("duplicate_keys"), F.sum(n - 1).alias("extra_rows"))
    )
    return _label(
        stats.withColumn("status", F.when(F.col("duplicate_keys") == 0, "PASS").otherwise("WARNING")), "Duplicates", table
    )


def unified_duplicates(shop: DataFrame, marketing: DataFrame) -> DataFrame:
    return repeated_keys(shop, ["order_id"], "shopify_unified").unionByName(
        repeated_keys(marketing, ["date", "channel"], "marketing_unified")
    )


def continuity(df: DataFrame, day: Column, as_of, table: str, daily_value: float = 0, days: int = 30) -> DataFrame:
    """Days without rows in the `days` before `as_of`, where the gap lies, and what it may be worth."""
    end = as_date(as_of)
    gaps = date_spine_gaps(df, day, F.date_sub(end, days), F.date_sub(end, 1)).agg(
        F.count("*").alias("missing_days"), F.min("date").alias("first_missing"), F.max("date").alias("last_missing")
    )
    n = F.col("missing_days")
    at_end = F.datediff(end, F.col("last_missing")) <= 2
    return _label(
        gaps.withColumns(
            {
                "gap_position": F.when(n == 0, "none").when(at_end, "end").otherwise("middle"),
                "estimated_value": (n * F.lit(daily_value)).cast("double"),
                "status": F.when(n == 0, "PASS").when(n <= 3, "WARNING").otherwise("FAIL"),
            }
        ),
        "Continuity",
        table,
    )


def critical_nulls(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    parts = []
    for table, (df, fields) in tables.items():
        status = F.when(F.col("null_count") == 0, "PASS").when(F.col("rate_pct") < 5, "WARNING").otherwise("FAIL")
        parts.append(_label(null_counts(df, fields).withColumn("status", status), "NULLs", table))
    return checks.union(parts)


def latest_day(df: DataFrame, day: Column, source: str) -> DataFrame:
    return df.agg(F.lit(source).alias("source"), F.max(day).alias("latest"))


def freshness_impact(latest: DataFrame, as_of, daily_value: Mapping[str, float]) -> DataFrame:
    """Days behind per source with bands, and what the missing days may be worth."""
    value = F.lit(0)
    for source, v in daily_value.items():
        value = F.when(F.col("source") == source, v).otherwise(value)
    gap = F.datediff(as_date(as_of), F.col("latest"))
    return latest.select(
        "source",
        "latest",
        gap.cast("bigint").alias("gap_days"),
        (gap * value).cast("double").alias("missed_value"),
        F.when(gap.isNull(), "FAIL")
        .when(gap <= FRESH_DAYS["ok"], "PASS")
        .when(gap <= FRESH_DAYS["warning"], "WARNING")
        .otherwise("FAIL")
        .alias("status"),
    )


def freshness_simple(latest: DataFrame, as_of) -> DataFrame:
    old = F.datediff(as_date(as_of), F.col("latest"))
    return latest.select(
        "source",
        "latest",
        old.cast("bigint").alias("days_old"),
        F.when(old.isNull(), "No data").when(old <= 2, "Fresh").when(old <= 7, "Stale").otherwise("Old").alias("status"),
    )


def sync_lag(stats: DataFrame, as_of) -> DataFrame:
    """Hours since each table was last loaded."""
    hours = hours_between(F.col("last_extracted_at"), as_timestamp(as_of))
    return stats.select(
        "table_name",
        "row_count",
        hours.alias("hours_behind"),
        F.when(hours <= 25, "PASS").when(hours <= 72, "WARNING").otherwise("FAIL").alias("status"),
    )


def volume_bounds(df: DataFrame, day: Column, table: str, low: int, high: int) -> DataFrame:
    """Days whose row count lies outside the expected range."""
    per_day = df.groupBy(day.alias("date")).agg(F.count("*").alias("row_count"))
    out = per_day.filter(~F.col("row_count").between(low, high)).withColumn(
        "status", F.when(F.col("row_count") < low, "LOW").otherwise("HIGH")
    )
    return _label(out, "Volume", table)


def null_zero_anomalies(shop: DataFrame, marketing: DataFrame) -> DataFrame:
    """Key figures with NULLs, or with more than a tenth zeros. Zeros are not counted for ids."""

    def one(df: DataFrame, table: str, fields: Mapping[str, bool]) -> DataFrame:
        structs = [
            F.struct(
                F.lit(f).alias("field"),
                F.count_if(F.col(f).isNull()).alias("null_count"),
                (F.count_if(F.col(f) == 0) if zeros else F.lit(0).cast("bigint")).alias("zero_count"),
            )
            for f, zeros in fields.items()
        ]
        row = df.agg(F.count("*").alias("total_rows"), F.array(*structs).alias("a"))
        return row.select(F.lit(table).alias("table_name"), "total_rows", F.explode("a").alias("a")).select(
            "table_name", "a.field", "total_rows", "a.null_count", "a.zero_count"
        )

    both = one(shop, "shopify_unified", {"order_value": True, "customer_id": False}).unionByName(
        one(marketing, "marketing_unified", {"revenue": True, "ad_spend": True})
    )
    return both.withColumn("null_pct", percent(F.col("null_count"), F.col("total_rows"))).filter(
        (F.col("null_count") > 0) | (F.col("zero_count") > F.col("total_rows") * 0.1)
    )


def revenue_drop(marketing: DataFrame, as_of, recent: int = 7, base: int = 30) -> DataFrame:
    """Rows of the last days whose revenue is below half of the 30-day average."""
    end = as_date(as_of)
    window = marketing.filter(F.col("date") >= F.date_sub(end, base))
    average = window.agg(divide(F.sum("revenue"), F.count("revenue"))).scalar()
    last = marketing.filter(F.col("date") >= F.date_sub(end, recent))
    return last.filter(F.col("revenue").cast("double") < average * 0.5).select("date", "channel", "revenue")


# ----------------------------------------------------------------------------- zeros
def suspicious_zeros(marketing: DataFrame) -> DataFrame:
    return (
        zero_explanations(marketing)
        .filter("is_suspicious_zero")
        .select(
            "date",
            "channel",
            "utm_source",
            "revenue",
            "ad_spend",
            "ad_clicks",
            "revenue_zero_explanation",
            "impressions_zero_explanation",
        )
    )


def spend_without_revenue(marketing: DataFrame) -> DataFrame:
    return marketing.filter((F.col("revenue") == 0) & (F.col("ad_spend") > 0)).select(
        "date", "channel", "ad_spend", "revenue", "ad_clicks"
    )


def zero_value_orders(shop: DataFrame) -> DataFrame:
    """Orders worth nothing, with every cause that applies; `cause` names the first."""
    tags = F.coalesce(F.col("order_tags"), F.lit(""))
    titles = F.coalesce(F.col("product_titles"), F.lit(""))
    yes = lambda c: F.coalesce(c, F.lit(False))
    test = tags.contains("test") | yes(F.col("source_name") == "shopify_draft_order")
    discount = yes(F.col("order_discounts") >= F.col("order_subtotal"))
    sample = titles.contains("sample") | titles.contains("free")
    error = yes(F.col("order_subtotal") > 0) & yes(~F.col("order_tags").contains("test"))
    return shop.filter(F.col("order_value") == 0).select(
        "order_id",
        "customer_id",
        "order_subtotal",
        "order_discounts",
        test.alias("is_test_or_draft"),
        discount.alias("is_full_discount"),
        sample.alias("is_free_sample"),
        error.alias("is_sync_error"),
        F.when(test, "Test order")
        .when(discount, "100% discount")
        .when(sample, "Free sample")
        .when(error, "Sync error")
        .otherwise("Unknown")
        .alias("cause"),
    )


def idle_days(marketing: DataFrame) -> DataFrame:
    return marketing.filter((F.col("revenue") == 0) & (F.col("ad_spend") == 0)).select(
        "date", "channel", "ad_spend", "revenue"
    )


def paused_campaigns(google: DataFrame) -> DataFrame:
    return google.filter((F.col("ga_impressions") == 0) & (F.col("ga_campaign_status") == "PAUSED")).select(
        "date", "ga_campaign_name", "ga_campaign_status", "ga_impressions", "ga_clicks"
    )


def not_synced_yet(marketing: DataFrame, as_of) -> DataFrame:
    return marketing.filter((F.col("date") >= F.date_sub(as_date(as_of), 1)) & (F.col("ad_impressions") == 0)).select(
        "date", "channel", "ad_impressions", "ad_spend"
    )


def budget_exhausted(facebook: DataFrame) -> DataFrame:
    """Campaign days without impressions that follow a day with spend.

    Rows are added up per campaign and day first, so the window sees days, not ad rows.
    """
    per_day = facebook.groupBy("fb_campaign_name", "date").agg(
        F.sum("fb_impressions").alias("fb_impressions"), F.sum("fb_spend").alias("fb_spend")
    )
    before = F.lag("fb_spend").over(Window.partitionBy("fb_campaign_name").orderBy("date"))
    return per_day.withColumn("prev_day_spend", before).filter("fb_impressions = 0 AND prev_day_spend > 0")


# ------------------------------------------------------------- keys, sums and formats
def referential_integrity(child: DataFrame, key: str, parent: DataFrame, parent_key: str, table: str) -> DataFrame:
    """Rows of `child` whose key no `parent` row has."""
    orphans = child.filter(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(key)), key, "left_anti"
    )
    per_key = orphans.groupBy(key).agg(F.count("*").alias("n"))
    out = per_key.agg(F.count("*").alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
    return _label(
        out.withColumn("status", F.when(F.col("orphan_keys") == 0, "PASS").otherwise("FAIL")),
        "Referential Integrity",
        table,
    )


def sum_validation(orders: DataFrame, items_by_order: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Orders whose value and line total differ by more than the tolerance."""
    j = orders.select("order_id", "order_id_numeric", "order_value").join(
        items_by_order.select("order_id_numeric", "items_total_original"), "order_id_numeric"
    )
    diff = F.abs(F.col("order_value") - F.col("items_total_original"))
    pct = divide(diff, F.col("order_value"))
    return j.select("order_id", "order_value", "items_total_original", pct.alias("diff_ratio")).filter(
        F.coalesce(F.col("diff_ratio") > tolerance, F.col("items_total_original") != 0)
    )


def format_checks(orders: DataFrame, id_col: str, gid_col: str, day_text: Column, currency: str) -> DataFrame:
    """Ids that are not plain numbers at the end of a global id, days that are not ISO, and currencies in use."""
    per_currency = orders.groupBy(currency).agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(F.col(gid_col).rlike(r"^gid://[a-z]+/Order/[1-9][0-9]*$"), F.lit(False))).alias("bad_ids"),
        F.count_if(
            ~F.coalesce(F.substring_index(F.col(gid_col), "/", -1) == F.col(id_col).cast("string"), F.lit(False))
        ).alias("changed_ids"),
        F.count_if(day_text.try_cast("date").isNull() | ~day_text.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("bad_dates"),
    )
    return per_currency.agg(
        F.sum("n").alias("total_rows"),
        F.count(currency).alias("currencies"),
        F.sum("bad_ids").alias("bad_ids"),
        F.sum("changed_ids").alias("changed_ids"),
        F.sum("bad_dates").alias("bad_dates"),
    ).withColumn(
        "status",
        F.when((F.col("bad_ids") + F.col("changed_ids") + F.col("bad_dates") > 0) | (F.col("currencies") > 1), "WARNING").otherwise("PASS"),
    )


def order_totals_agree(orders: DataFrame, utm_by_order: DataFrame) -> DataFrame:
    """Order totals in the order table against those in the attribution table."""
    o = orders.select(F.col("order_id_numeric").alias("k"), "order_value")
    u = utm_by_order.select(F.col("order_id_numeric").alias("k"), "total_price")
    return (
        o.join(u, "k", "full_outer")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("total_price").isNull()).alias("only_in_orders"),
            F.count_if(F.col("order_value").isNull()).alias("only_in_attribution"),
            F.count_if(F.col("order_value") != F.col("total_price")).alias("different_totals"),
        )
    )


def unmatched_campaigns(utm: DataFrame, ad_campaigns: DataFrame, campaign: str) -> DataFrame:
    """Campaign names in tracking parameters that no ad table knows."""
    used = (
        utm.filter(F.col("first_utm_campaign").isNotNull())
        .groupBy(F.col("first_utm_campaign").alias("campaign"))
        .agg(F.count("*").alias("orders"))
    )
    return used.join(ad_campaigns.select(F.col(campaign).alias("campaign")).distinct(), "campaign", "left_anti")


# OK below the first figure, WARNING up to the second, CRITICAL above it.
WORKFLOW_BANDS = {
    "freshness_hours": (24, 48),
    "duplicates": (1, 10),
    "null_pct": (5, 15),
    "anomalies": (1, 5),
    "duration_minutes": (5, 10),
}


def workflow_kpi_status(kpis: DataFrame) -> DataFrame:
    """Band each (kpi, value) row."""
    ok, warn = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (a, b) in WORKFLOW_BANDS.items():
        ok = F.when(F.col("kpi") == name, float(a)).otherwise(ok)
        warn = F.when(F.col("kpi") == name, float(b)).otherwise(warn)
    v = F.col("value")
    return kpis.select("kpi", "value", F.when(v < ok, "OK").when(v <= warn, "WARNING").otherwise("CRITICAL").alias("status"))
