"""The verification of all unified tables gives each table's own figures, not only its rows."""

from workload import queries_reports, registry  # noqa: F401

from martlet.plans import ads, commerce, marketing

SHOP = "order_id long, customer_id long, order_value decimal(18,2), order_net_value decimal(18,2)"
GOOGLE = "ga_campaign_id long, metrics_cost_micros long, ga_conversions long, ga_conversion_value decimal(18,2)"


def test_every_table_with_its_keys_totals_and_returns(spark):
    row = lambda text, kind: spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(c.split()[0] for c in kind.split(', '))})")
    shop = row("(1L, 7L, 10.00BD, 9.00BD), (1L, 8L, 10.00BD, 9.00BD), (2L, NULL, 5.00BD, NULL)", SHOP)
    google = row("(1L, 2000000L, 3L, 8.00BD), (1L, 2000000L, 1L, 2.00BD), (NULL, 0L, NULL, NULL)", GOOGLE)
    spent = row("('a', 4.00BD), ('b', NULL)", "name string, fb_spend decimal")
    sold = row("(4.00BD, 6.00BD)", "amz_spend decimal, amz_sales decimal")
    both = row("(3.00BD, 2.00BD), (1.00BD, 0.00BD)", "revenue decimal, ad_spend decimal")
    checks = [
        commerce.shop_verify(shop),
        ads.ad_verify("facebook_unified", spent, "fb_"),
        ads.google_verify(google),
        ads.amazon_verify(sold),
        marketing.marketing_verify(both),
    ]
    found = {r["view_name"]: {k: float(v) for k, v in r.asDict().items() if k != "view_name" and v is not None}
             for r in marketing.unified_verify(checks).collect()}
    assert found == {
        "shopify_unified": {"row_count": 3, "unique_orders": 2, "unique_customers": 2, "total_gmv": 25, "total_net_gmv": 18},
        "facebook_unified": {"row_count": 2, "total_spend": 4},
        "google_ads_unified": {"row_count": 3, "unique_campaigns": 1, "total_spend": 4, "total_conversions": 4, "avg_roas": 2.5},
        "amazon_ads_unified": {"row_count": 1, "total_spend": 4, "total_sales": 6, "avg_roas": 1.5},
        "marketing_unified": {"row_count": 2, "total_revenue": 4, "total_spend": 2, "overall_roas": 2},
    }


def test_registered_query_has_these_figures(spark):
    wanted = {"unique_orders", "unique_customers", "unique_campaigns", "total_gmv", "total_net_gmv", "total_spend", "total_sales"}
    wanted |= {"total_revenue", "total_conversions", "avg_roas", "overall_roas", "view_name", "row_count"}
    found = registry.all_queries()["unified_verify"](spark, "/root/testdata/sf0.001")
    assert set(found.columns) == wanted
