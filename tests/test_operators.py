import datetime as dt
import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martlet.operators import attribution, changes, conform, dedup, quality, reconcile, unify
from martlet.operators.quantile import exact_median, value_counts
from martlet.plans import marketing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------------------ dedup
def test_dedup_is_idempotent_and_settles_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d")], "k int, v int, t string")
    once = dedup.dedup_latest(df, ["k"], ["v"], ["t"])
    assert rows(once) == [(1, 2, "c"), (2, 1, "d")]
    assert rows(dedup.dedup_latest(once, ["k"], ["v"], ["t"])) == rows(once)


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    text = plan(dedup.dedup_latest(df, ["k"], ["v"]))
    assert text.count("WindowGroupLimit") == 2


AD_ROW = "ad_id string, date_start date, account_id string, extract_no int, tie1 long, tie2 long, tie3 long, tie4 decimal(18,2), spend string"


def ad_rows(spark, n, keys):
    """Ads with NULLs in keys, versions and ties, the whole range of ids, and every third row twice."""
    rnd, out = random.Random(5), []
    for i in range(n):
        k = rnd.randrange(keys)
        key = (rnd.choice([None, f"ad{k}"]) if k % 7 == 0 else f"ad{k}", dt.date(2001, 1, 1 + k % 9) if k % 5 else None, str(k % 3))
        ties = (rnd.choice([None, -(2**63), 2**63 - 1, rnd.randrange(9)]), rnd.choice([None, 1, 2]), rnd.choice([None, 1]), None)
        out += [(*key, rnd.choice([None, -(2**31), 2**31 - 1, 1, 2]), *ties, f"{k} {ties}")] * (2 if i % 3 == 0 else 1)
    return spark.createDataFrame(out, AD_ROW)


@pytest.mark.parametrize("buckets", [1, 8, 1 << 20])
def test_ads_lose_no_latest_row_before_the_sort(spark, monkeypatch, buckets):
    monkeypatch.setattr(dedup, "BUCKETS", buckets)
    raw = ad_rows(spark, 600, 60)
    assert rows(dedup.ads_base(raw)) == rows(dedup.dedup_latest(raw, dedup.AD_KEY, dedup.VERSION, dedup.TIES))


def test_old_versions_of_ads_are_not_sorted(spark):
    n, day = F.col("id"), F.lit("2001-01-01").cast("timestamp_ntz")
    raw = spark.range(20000).select(
        (n % 10).alias("ad_id"), day.alias("stat_time_day"), F.lit("{}").alias("metrics"), (n % 7).cast("int").alias("extract_no"),
        n.alias("tie1"), *[F.lit(None).cast("long").alias(f"tie{i}") for i in (2, 3, 4)],
    )
    latest = dedup.report_latest(raw, "ad")
    latest.collect()
    text = plan(latest)
    assert text.index("WindowGroupLimit") < text.index("BroadcastHashJoin")  # the plan is printed from its end
    assert dedup.only_late(raw, ["ad_id"], [*dedup.VERSION, *dedup.TIES]).count() == 10


def test_order_code_is_in_the_order_of_its_columns(spark):
    df = ad_rows(spark, 300, 5)
    code = dedup.order_code(df, ["extract_no", "tie1", "tie2"])
    found = df.select("extract_no", "tie1", code.alias("code")).collect()
    key = lambda r: tuple((v is not None, v or 0) for v in (r.extract_no, r.tie1))
    assert sorted(map(key, found)) == [key(r) for r in sorted(found, key=lambda r: r.code)]
    assert len({r.code for r in found}) == len(set(map(key, found)))
    assert dedup.order_code(df, ["spend"]) is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert dedup.dedup_latest(df, ["k"], ["v"]).count() == 0
    assert quality.check_duplicates(df, ["k"], "t").first().status == "WARNING"


# ------------------------------------------------------------------------------ joins
def test_null_keys_are_spread(spark):
    left = spark.range(1000).select(F.col("id").alias("order_id"), F.lit(None).cast("string").alias("h"))
    right = spark.createDataFrame([("a", 1), (None, 2)], "rh string, x int")
    out = unify.left_join_spread(left, right, "h", "rh", "order_id")
    assert out.count() == 1000 and out.filter("x IS NOT NULL").count() == 0
    assert out.columns == ["order_id", "h", "x"]


def test_items_lists(spark):
    li = spark.createDataFrame(
        [("gid/5", "b", "T1", 2, 10), ("gid/5", "a", "T1", 1, 5), ("gid/5", "b", "T1", 1, 5), ("gid/6", None, None, 1, 1)],
        "order_id string, sku string, title string, quantity long, original_total int",
    ).withColumn("admin_graphql_api_order_id", F.col("order_id"))
    one = {r.order_id_numeric: r for r in unify.items_agg(li).collect()}
    assert (one[5].items_count, one[5].total_quantity, one[5].skus, one[5].product_titles) == (3, 4, "a, b", "T1")
    assert one[6].skus is None
    every = {r.order_id_numeric: r for r in unify.items_agg_all(li).collect()}
    assert (every[5].product_skus, every[5].product_titles) == ("a, b, b", "T1, T1, T1")
    assert every[6].product_skus is None and every[6].items_count == 1


def test_date_join_equals_the_fanned_out_join(spark):
    rnd = random.Random(3)
    day = lambda: dt.datetime(2001, 1, rnd.randint(1, 5))
    utm = spark.createDataFrame(
        [(day(), rnd.choice(["facebook", "my facebook ad", "google", None]), rnd.randint(1, 99)) for _ in range(60)],
        "created_at timestamp_ntz, first_utm_source string, total_price int",
    ).withColumn("total_price", F.col("total_price").cast("decimal(18,2)"))
    ads = spark.createDataFrame(
        [(dt.date(2001, 1, rnd.randint(1, 3)), str(rnd.randint(1, 99))) for _ in range(40)], "date_start date, spend string"
    )
    got = {(r.order_date, r.first_utm_source): r for r in unify.attribution_by_date_join(utm, ads).collect()}
    o = [(r.created_at.date(), r.first_utm_source, r.total_price) for r in utm.collect() if r.first_utm_source and "facebook" in r.first_utm_source]
    a = [(r.date_start, int(r.spend)) for r in ads.collect()]
    keys = {(d, s) for d, s, _ in o}
    assert set(got) == keys
    for d, s in keys:
        pairs = [(p, q) for dd, ss, p in o if (dd, ss) == (d, s) for q in ([x for ad, x in a if ad == d] or [None])]
        assert got[(d, s)].orders == len(pairs)
        assert got[(d, s)].revenue == sum(p for p, _ in pairs)
        assert got[(d, s)].ad_spend == (sum(q for _, q in pairs) if pairs[0][1] is not None else None)


def test_top_matches_equal_the_full_join(spark):
    o = spark.createDataFrame(
        [(i, f"#{i}", i, dt.datetime(2001, 1, 1), "same@x.com" if i % 2 else None) for i in range(20)],
        "id long, name string, total_price int, extracted_at timestamp_ntz, email string",
    )
    c = spark.createDataFrame(
        [(i, 1, 2, dt.datetime(2001, 1, 1), "SAME@x.com ") for i in range(7)],
        "id long, orders_count int, total_spent int, extracted_at timestamp_ntz, email string",
    )
    got = [(r.order_id, r.customer_id) for r in unify.orders_with_customers(o, c).collect()]
    assert got == [(1, i) for i in range(7)] + [(3, 0), (3, 1), (3, 2)]


def test_unified_rows_per_order(spark):
    from workload.inputs import Inputs

    x = Inputs(spark, "/root/testdata/sf0.001")
    parts = x.shop_parts()
    n = parts["orders"].count()
    assert unify.shopify_unified(**parts, customer_match="latest").count() == n
    assert unify.shopify_unified(**parts).count() > n
    with pytest.raises(ValueError):
        unify.shopify_unified(**parts, customer_match="some")


def test_marketing_spend_stands_once_per_channel(spark):
    shop = spark.createDataFrame(
        [(dt.date(2001, 1, 1), "facebook", "facebook", 1, 10), (dt.date(2001, 1, 1), "Facebook", "Facebook", 2, 20)],
        "order_date date, attribution_channel string, first_utm_source string, customer_id int, order_value int",
    )
    for c in ("order_value", "order_net_value"):
        shop = shop.withColumn(c, F.col("order_value").cast("decimal(18,2)"))
    ads = spark.createDataFrame(
        [(dt.date(2001, 1, 1), "facebook", 5, 100, 10), (dt.date(2001, 1, 2), "tiktok", 0, 0, 0)],
        "date date, ad_source string, spend int, impressions long, clicks long",
    ).withColumn("spend", F.col("spend").cast("decimal(28,2)"))
    faithful = unify.marketing_unified(unify.shopify_daily(shop), ads)
    assert faithful.agg(F.sum("ad_spend")).first()[0] == 10
    once = unify.marketing_unified(unify.shopify_daily(shop, by_source=False), ads)
    assert once.agg(F.sum("ad_spend")).first()[0] == 5
    idle = faithful.filter("channel = 'tiktok'").first()
    assert idle.roas is None and idle.cpa is None and idle.orders == 0 and idle.row_id == "2001-01-02_tiktok"


def test_year_over_year_reads_its_input_once(spark):
    df = spark.createDataFrame(
        [(dt.date(2000, 1, 1), 10), (dt.date(2001, 1, 1), 15), (dt.date(2001, 2, 1), 7)], "month date, v int"
    )
    assert rows(unify.year_over_year(df, "month", ["v"])) == [
        (dt.date(2000, 1, 1), 10, None),
        (dt.date(2001, 1, 1), 15, 10),
        (dt.date(2001, 2, 1), 7, None),
    ]


def test_kpi_needs_both_months(spark):
    df = spark.createDataFrame([(dt.date(2001, 8, 1), 10.0)], "date date, revenue double").withColumns(
        {c: F.lit(1) for c in ("net_revenue", "ad_spend", "orders")}
    )
    assert marketing.exec_kpi_yoy(df, "2001-08-01").count() == 0


def test_gross_margin_pre_aggregates(spark):
    orders = spark.createDataFrame([(1, 100), (2, 50)], "order_id long, order_value int")
    li = spark.createDataFrame([("g/1", 9, 2), ("g/1", 9, 1), ("g/2", 8, 1)], "order_id string, product_id long, quantity long")
    inv = spark.createDataFrame([(9, 10), (9, 20)], "product_id long, cost int")
    got = [(r.order_id, float(r.total_cost), float(r.gross_margin)) for r in unify.order_gross_margin(orders, li, inv).collect()]
    assert got == [(1, 45.0, 55.0)]


# -------------------------------------------------------------------------- attribution
@pytest.mark.parametrize(
    "source, channel, page, status",
    [
        ("google", "amazon-us", "/p", "HAS_UTM"),
        (None, "amazon", "/p", "AMAZON_NO_TRACKING"),
        ("", "shopify_draft_order", None, "MANUAL_ORDER"),
        (None, "tiktok", None, "TIKTOK_SHOP"),
        (None, "web", "/p", "DIRECT_OR_ORGANIC"),
        (None, None, None, "UNKNOWN_CHANNEL"),
    ],
)
def test_attribution_status(spark, source, channel, page, status):
    df = spark.createDataFrame([(source, channel, page)], "s string, c string, p string")
    assert df.select(attribution.attribution_status(F.col("s"), F.col("c"), F.col("p"))).first()[0] == status


def test_reclassify_leaves_known_rows(spark):
    df = spark.createDataFrame(
        [("pos", "HAS_UTM", None), ("pos", "UNKNOWN_CHANNEL", None), ("web", "UNKNOWN_CHANNEL", "x"), (None, "UNKNOWN_CHANNEL", None), ("zzz", "UNKNOWN_CHANNEL", None)],
        "sales_channel string, attribution_status string, first_utm_source string",
    )
    got = [r.attribution_status for r in attribution.reclassify_unknown_channels(df).collect()]
    assert got == ["HAS_UTM", "POS_ORDER", "HAS_UTM", "UNKNOWN_CHANNEL", "OTHER_CHANNEL"]


# ------------------------------------------------------------------------------ changes
def test_update_from_refuses_ambiguous_source(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, n string")
    with pytest.raises(PySparkException):
        changes.update_from(df, twice, "k", {"v": F.col("src_n")}).collect()
    unmatched = spark.createDataFrame([(9, "x"), (9, "y"), (2, "z")], "k int, n string")
    assert rows(changes.update_from(df, unmatched, "k", {"v": F.col("src_n")})) == [(1, "a"), (2, "z")]


def test_update_where_ignores_unknown(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a")], "k int, v string")
    assert rows(changes.update_where(df, F.col("k") == 1, {"v": F.lit("z")})) == [(1, "z"), (None, "a")]


def test_merge_and_retention(spark):
    t = spark.createDataFrame([(1, "old", 5), (2, "old", 5)], "k int, v string, at int")
    b = spark.createDataFrame([(2, "new", 1), (3, "new", 1)], "k int, v string, at int")
    assert rows(changes.batch_merge(t, b, "k", ["at"])) == [(1, "old", 5), (2, "new", 1), (3, "new", 1)]
    d = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2001, 7, 31),), (None,)], "d date")
    assert changes.retention_delete(d, "d", "2001-08-01", 365).count() == 2


# ------------------------------------------------------------------------------- median
@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_exact_median(spark, n):
    rnd = random.Random(n)
    cents = [rnd.choice([0, 100, 12345, rnd.randint(0, 10**7)]) for _ in range(n)]
    df = spark.createDataFrame([(c,) for c in cents], "c long").select((F.col("c") / 100).cast("decimal(18,2)").alias("p"))
    got = exact_median(value_counts(df, "p")).first()
    assert got.total == n and got.max_value == max(cents) / 100
    assert got.median == pytest.approx(statistics.median(cents) / 100)


def test_median_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "p decimal(18,2)")
    assert quality.check_price_format(empty, "p", "t").first().status == "WARNING"
    same = spark.range(10).select(F.lit("5.00").cast("decimal(18,2)").alias("p"))
    assert exact_median(value_counts(same, "p")).first().median == 5.0


# --------------------------------------------------------------------------- thresholds
@pytest.mark.parametrize("price, status", [(1000, "PASS"), (1001, "CRITICAL")])
def test_price_median_edge(spark, price, status):
    df = spark.range(3).select(F.lit(price).cast("decimal(18,2)").alias("p"))
    assert quality.check_price_format(df, "p", "t").first().status == status


@pytest.mark.parametrize("top, status", [(10000, "PASS"), (10001, "WARNING"), (100001, "CRITICAL")])
def test_price_outlier_edge(spark, top, status):
    df = spark.createDataFrame([(5,), (5,), (5,), (top,)], "p int").select(F.col("p").cast("decimal(18,2)").alias("p"))
    assert quality.check_price_format(df, "p", "t").first().status == status


@pytest.mark.parametrize("nulls, status", [(5, "PASS"), (6, "WARNING"), (20, "WARNING"), (21, "CRITICAL")])
def test_null_rate_edge(spark, nulls, status):
    df = spark.range(100).select(F.when(F.col("id") >= nulls, F.col("id")).alias("a"), F.lit(1).alias("b"))
    got = quality.check_null_rates(df, ["b", "a"], "t").first()
    assert (got.status, got.worst_field) == (status, "a")


def test_null_rate_without_nulls_names_no_field(spark):
    got = quality.check_null_rates(spark.range(3), ["id"], "t").first()
    assert got.worst_field is None and got.status == "PASS"


@pytest.mark.parametrize("hour, status", [(11, "PASS"), (10, "WARNING"), (6, "WARNING"), (5, "CRITICAL")])
def test_freshness_edge(spark, hour, status):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, hour),)], "t timestamp_ntz")
    assert quality.check_freshness(df, "t", "2001-01-01 12:00:00", "x").first().status == status


def test_continuity_positions(spark):
    def days(*missing):
        d = [dt.date(2001, 7, 2) + dt.timedelta(i) for i in range(30)]
        df = spark.createDataFrame([(x,) for i, x in enumerate(d) if i not in missing], "d date")
        r = quality.continuity(df, F.col("d"), "2001-08-01", "t", 100).first()
        return r.missing_days, r.gap_position, r.estimated_value, r.status

    assert days() == (0, "none", 0.0, "PASS")
    assert days(3, 4, 5) == (3, "middle", 300.0, "WARNING")
    assert days(3, 4, 5, 29) == (4, "end", 400.0, "FAIL")


def test_distinct_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    r = quality.dup_by_distinct(df, ["k"], "t").first()
    assert (r.total, r.distinct_keys, r.duplicates, r.status) == (4, 2, 2, "FAIL")
    assert quality.dup_by_distinct(df, ["k"], "t", raw=True).first().status == "WARNING"


def test_zero_order_without_tags_or_titles(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, 10, 0, None, "web", None)],
        "order_id int, customer_id int, order_value int, order_subtotal int, order_discounts int, order_tags string, source_name string, product_titles string",
    )
    assert quality.zero_value_orders(df).first().cause == "Unknown"


def test_summary_prefers_the_worst(spark):
    make = lambda *s: spark.createDataFrame([(x,) for x in s], "status string")
    overall = lambda *s: quality.summarise_checks(make(*s)).first().overall_status
    assert overall("PASS", "ERROR", "WARNING", "CRITICAL") == "CRITICAL"
    assert overall("PASS", "ERROR", "WARNING") == "WARNING"
    assert overall("PASS", "ERROR") == "ERROR"
    assert overall("PASS") == "PASS"


# ----------------------------------------------------------------------- reconciliation
@pytest.mark.parametrize(
    "s, w, status, lenient",
    [
        (100, 98, "MATCH", "OK"),
        (100, 97, "MISMATCH", "MISMATCH"),
        (0, 0, "MATCH", "OK"),
        (0, 1, "MISMATCH", "WARN"),
        (None, 1, "MISMATCH", "SKIP"),
        (1, None, "MISMATCH", "SKIP"),
    ],
)
def test_reconcile_edges(spark, s, w, status, lenient):
    side = lambda v: spark.createDataFrame([] if v is None else [(1, v)], "k int, m int")
    assert reconcile.reconcile(side(s), side(w), ["k"], ["m"]).first().status == status
    assert reconcile.reconcile_lenient(side(s), side(w), ["k"], ["m"]).first().status == lenient


def test_settled_window():
    assert reconcile.settled_window("2001-08-01") == reconcile.Window(dt.date(2001, 7, 16), dt.date(2001, 7, 30))


def test_landed_text_counts_bad_values_as_zero(spark):
    api = spark.createDataFrame(
        [("a", dt.date(2001, 1, 1), "1.50", "x", None), ("a", dt.date(2001, 1, 1), "oops", "3", "2")],
        "account_id string, date_start date, spend string, impressions string, clicks string",
    )
    got = reconcile.source_totals(api, reconcile.Window(dt.date(2001, 1, 1), dt.date(2001, 1, 1))).first()
    assert (float(got.spend), got.impressions, got.clicks) == (1.5, 3, 2)


def test_zero_reasons(spark):
    df = spark.createDataFrame(
        [(0, 0, 0, 0), (0, 5, 9, 1), (0, 5, 10, 1), (5, 5, 0, 0), (0, 101, 51, 1)],
        "revenue int, ad_spend int, ad_clicks int, ad_impressions int",
    )
    got = [(r.revenue_zero_explanation, r.is_suspicious_zero) for r in conform.zero_explanations(df).collect()]
    assert got == [
        ("No campaign running", False),
        ("Low traffic - not enough clicks", False),
        ("Attribution issue or conversion lag", False),
        ("Normal", True),
        ("Attribution issue or conversion lag", True),
    ]
