"""Tables compared by digests, counts from footers, and a marketing table renewed by day."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators import changes, digests, reconcile, unify
from martlet.plans import marketing, refresh
from martlet.sources import tables
from workload.inputs import Inputs

KIND = "id long, day date, v string"
DAYS = [dt.date(2024, m, 3) for m in range(1, 5)]
BESIDE = dt.date(2024, 3, 9)  # in the month of the third


def orders(spark, *changes):
    held = {i: (i, DAYS[i % 4] if i % 9 else None, f"v{i}") for i in range(60)}
    held.update({row[0]: row for row in changes})
    return spark.createDataFrame(list(held.values()), KIND)


def stored(spark, tmp_path, source, warehouse, day="day", columns=None):
    paths = [str(tmp_path / side) for side in ("source", "warehouse")]
    for df, path in zip((source, warehouse), paths):
        digests.store_parts(df, path, ["id"], 4, F.col(day) if day else None, columns)
    return paths


def spoil(tmp_path, bucket):
    """Make every other bucket unreadable; gives how many files were spoilt."""
    files = [p for p in tmp_path.glob("*/rows/part=*/*.parquet") if not p.parent.name.endswith(f"_{bucket}")]
    for p in files:
        p.with_name(f".{p.name}.crc").unlink()
        p.write_bytes(b"no table")
    return len(files)


@pytest.mark.parametrize("row, status", [((7, DAYS[3], "other"), "changed"), ((77, DAYS[3], "new"), "missing in source")])
def test_one_difference_reads_one_bucket(spark, tmp_path, row, status):
    source, warehouse = orders(spark), orders(spark, row)
    paths = stored(spark, tmp_path, source, warehouse)
    bucket = warehouse.filter(F.col("id") == row[0]).select(digests.part_of(["id"], 4)).first()[0]
    assert spoil(tmp_path, bucket) > 20
    assert [tuple(r) for r in digests.changed_stored(*paths, ["id"], source).collect()] == [(row[0], status)]
    missing = [tuple(r) for r in digests.missing_stored(*paths, ["id"], source).collect()]
    assert missing == ([] if status == "changed" else [(row[0], status)])


def test_stored_tables_differ_as_whole_tables_do(spark, tmp_path):
    source = orders(spark).union(spark.createDataFrame([(3, DAYS[0], "v3"), (None, None, None), (None, DAYS[0], "x")], KIND))
    warehouse = orders(spark, (7, DAYS[2], "moved"), (100, DAYS[1], "new"), (9, None, "v9")).filter("id <> 11")
    paths = stored(spark, tmp_path, source, warehouse)
    text = lambda df: sorted(str(tuple(r)) for r in df.collect())
    missing = text(reconcile.missing_records(source, warehouse, ["id"]))
    assert text(digests.missing_stored(*paths, ["id"], source)) == missing
    assert missing == ["(100, 'missing in source')", "(11, 'missing in warehouse')", "(None, 'missing in warehouse')"]
    changed = text(digests.changed_stored(*paths, ["id"], source))
    assert changed == sorted([*missing, "(3, 'changed')", "(7, 'changed')"])
    assert changed == text(digests.changed_records(source, warehouse, ["id"]))


def test_counts_differ_by_key(spark, tmp_path):
    source = orders(spark).union(orders(spark).filter("id < 2"))
    paths = stored(spark, tmp_path, source, orders(spark), day=None, columns=["id"])
    got = digests.count_changes(*paths, ["id"], source).collect()
    assert sorted((r.id, r.source_value, r.warehouse_value, r.status) for r in got) == [(0, 2.0, 1.0, "CRITICAL"), (1, 2.0, 1.0, "CRITICAL")]


def test_digests_see_pairs_and_places_of_nulls(spark):
    digest = lambda rows: digests.digests(spark.createDataFrame(rows, "part string, a string, b string"), ["a", "b"]).collect()
    assert digest([("p", "x", None)]) != digest([("p", None, "x")])
    assert digest([("p", "x", "y")] * 2) != digest([("p", "x", "z")] * 2)
    assert digest([("p", "x", "y"), ("p", "y", "x")]) == digest([("p", "y", "x"), ("p", "x", "y")])


def test_equal_and_empty_tables_have_no_differences(spark, tmp_path):
    none = orders(spark).filter("id < 0")
    for n, (a, b) in enumerate([(orders(spark), orders(spark)), (none, none)]):
        paths = stored(spark, tmp_path / str(n), a, b)
        assert digests.missing_stored(*paths, ["id"], a).count() == digests.changed_stored(*paths, ["id"], a).count() == 0
    paths = stored(spark, tmp_path / "one", none, orders(spark))
    assert {r.side for r in digests.missing_stored(*paths, ["id"], none).collect()} == {"missing in source"}
    with pytest.raises(ValueError, match="part"):
        digests.store_parts(none.withColumn("part", F.lit(1)), str(tmp_path / "no"), ["id"], 4)


def test_footers_give_counts_without_columns(spark, tmp_path):
    full, empty, mixed = (str(tmp_path / n) for n in ("full", "empty", "mixed"))
    spark.range(10).selectExpr("id", "string(id) AS s", "date_add(DATE'2024-01-01', int(id)) AS d").repartition(3).write.parquet(full)
    spark.range(0).coalesce(1).write.parquet(empty)
    spark.range(5).coalesce(1).write.parquet(mixed)
    spark.range(0).coalesce(1).write.mode("append").parquet(mixed)
    counts = tables.footer_counts(spark, {"full": full, "empty": empty, "mixed": mixed})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"full": 10, "empty": 0, "mixed": 5}
    assert [r.table_name for r in counts.filter("row_count = 0").collect()] == ["empty"]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") >= 3
    ranges = {r.column_name: (r.min_value, r.max_value) for r in tables.footer_ranges(spark, full, ["id", "d"]).collect()}
    assert ranges == {"id": ("0", "9"), "d": ("2024-01-01", "2024-01-10")}
    with pytest.raises(ValueError, match="bounds"):
        tables.footer_ranges(spark, full, ["s"])
    # The caller's own plans are as before.
    assert "PushedAggregation" not in spark.read.parquet(full).groupBy().count()._jdf.queryExecution().executedPlan().toString()


SHOP = "order_date date, attribution_channel string, first_utm_source string, order_value decimal(18,2), order_net_value decimal(18,2), customer_id long"
ADS = "date date, fb_spend decimal(18,2), fb_impressions long, fb_clicks long"


def shop_and_ads(spark, tmp_path, label, third=5):
    """Inputs stored by day; the third day has `third` orders, and a day in which nothing is sold."""
    from decimal import Decimal

    sold = [(DAYS[d], ("facebook", "Facebook", None)[k % 3], None, Decimal(10 + k), Decimal(9), k) for d, n in ((0, 4), (1, 3), (2, third)) for k in range(n)]
    spent = [(d, Decimal(3), 100, 7) for d in (DAYS[0], DAYS[2], BESIDE, DAYS[3], None)]
    for name, rows, kind, day in (("shop", sold, SHOP, "order_date"), ("ads", spent, ADS, "date")):
        spark.createDataFrame(rows, kind).write.partitionBy(day).parquet(str(tmp_path / label / name))
    shop = spark.read.schema(SHOP).parquet(str(tmp_path / label / "shop"))
    ads = spark.read.schema(ADS).parquet(str(tmp_path / label / "ads"))
    return shop, {"facebook": (ads, "fb_")}


def rows_of(df):
    return sorted(str(sorted(r.asDict().items(), key=str)) for r in df.collect())


@pytest.mark.parametrize("third", [5, 0])
def test_a_changed_day_alone_is_computed_anew(spark, tmp_path, third):
    path = tmp_path / "kept"
    refresh.refresh_marketing(spark, str(path), *shop_and_ads(spark, tmp_path, "before", 2))
    shop, platforms = shop_and_ads(spark, tmp_path, "after", third)
    whole = unify.marketing_unified(unify.shopify_daily(shop), unify.daily_ad_spend(platforms))
    want, monthly = rows_of(whole), rows_of(marketing.monthly_performance(whole))
    other = [p for p in (tmp_path / "after").glob("*/*=*/*.parquet") if "2024-03-03" not in p.parent.name]
    assert len(other) >= 6
    for p in other:
        p.with_name(f".{p.name}.crc").unlink()
        p.write_bytes(b"no table")
    files = {p: p.stat().st_mtime_ns for p in path.glob("kept_month=*/*.parquet") if "2024-03" not in p.parent.name}
    got = refresh.refresh_marketing(spark, str(path), shop, platforms, [DAYS[2]])
    assert rows_of(got) == want and rows_of(marketing.monthly_performance(got)) == monthly
    assert len(files) >= 4 and all(p.stat().st_mtime_ns == t for p, t in files.items())


def test_a_day_that_empties_goes(spark, tmp_path):
    path = str(tmp_path / "kept")
    shop, platforms = shop_and_ads(spark, tmp_path, "in")
    before = rows_of(refresh.refresh_marketing(spark, path, shop, platforms))
    less = shop.filter(F.col("order_date") != F.lit(DAYS[1]))
    got = refresh.refresh_marketing(spark, path, less, platforms, [DAYS[1], dt.date(2030, 1, 1)])
    assert {r.date for r in got.collect()} == {DAYS[0], DAYS[2], BESIDE, DAYS[3], None}
    assert rows_of(refresh.refresh_marketing(spark, path, shop, platforms, [None, DAYS[1]])) == before
    assert rows_of(refresh.refresh_marketing(spark, path, shop, platforms, [])) == before
    kept = spark.read.parquet(path)
    with pytest.raises(Exception, match="a row of another kept_month"):
        changes.rewrite_partitions(spark, path, refresh.MONTH, [dt.date(2024, 1, 1)], kept)


def test_changed_days(spark, tmp_path):
    shop, platforms = shop_and_ads(spark, tmp_path, "in")
    assert set(refresh.changed_days(shop, {"facebook": platforms["facebook"][0]})) == {*DAYS, BESIDE, None}
    assert set(refresh.changed_days(shop)) == set(DAYS[:3])
    assert refresh.changed_days() == []


def test_landed_orders_carry_only_the_columns_read(spark):
    x = Inputs(spark, "no such folder")
    kind = "order_id long, order_date date, attribution_channel string, first_utm_source string, order_value decimal(18,2), "
    kind += "order_net_value decimal(18,2), customer_id long, product_titles string"
    day = dt.date(2001, 1, 2)
    every = [(1, day, "web", None, Decimal(3), Decimal(2), 7, "a, b"), (2, day, "web", None, None, None, None, None), (3, None, None, "x", Decimal(1), None, 7, "a")]
    full = x.__dict__["shop"] = spark.createDataFrame(every * 2, kind)
    (shop,) = x.land("shop", shop_columns=["order_id", *unify.DAILY_COLUMNS, "order_id"])
    assert shop.columns == ["order_id", *unify.DAILY_COLUMNS] and x.shop is shop and shop.count() == 6
    assert sorted(map(str, unify.shopify_daily(shop).collect())) == sorted(map(str, unify.shopify_daily(full).collect()))
