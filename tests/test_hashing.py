from pyspark.sql import functions as F

from martlet.functions import EMPTY_SHA256, digits, first_match, hash_pii, mask_name, order_number, query_param, trim_ws
from martlet.operators import hash_checks, pii

KNOWN = "973dfe463ec85785f5f95af5ba3906eedb2d931c24e69824a89ea65dba4e813b"


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_known_hash_and_its_variants(spark):
    df = spark.createDataFrame([("test@example.com",), ("Test@Example.com ",), ("\t TEST@EXAMPLE.COM\n",)], "e string")
    assert values(df, hash_pii("e")) == [(KNOWN,)] * 3


def test_missing_values_are_never_hashed(spark):
    df = spark.createDataFrame([(None,), ("",)], "e string")
    assert values(df, hash_pii("e")) == [(None,), (None,)]


def test_blank_text_hashes_to_the_sentinel(spark):
    df = spark.createDataFrame([("  ",)], "e string")
    assert values(df, hash_pii("e"), trim_ws("e")) == [(EMPTY_SHA256, "")]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("#12", "gid://shopify/Order/77", "Ann"), ("X-34-1", "none", None), ("D5", None, "")], "n string, g string, f string"
    )
    assert values(df, order_number("n"), digits("g"), mask_name("f")) == [
        ("12", 77, "A***"),
        ("34", None, None),
        ("D5", None, "***"),
    ]
    q = spark.createDataFrame([("utm_source=a b&utm_medium=c",), (None,)], "q string")
    assert values(q, query_param("q", "utm_source"), query_param("q", "utm_term")) == [("a b", None), (None, None)]
    assert values(q, first_match("q", "nothing(x)")) == [(None,), (None,)]


def test_hash_missing_leaves_existing_hashes(spark):
    df = spark.createDataFrame([("a@b.c", "old"), ("a@b.c", ""), ("a@b.c", None), ("", None)], "email string, h string")
    out = [r.h for r in pii.hash_missing(df, "email", "h").collect()]
    assert out[0] == "old" and out[1] == out[2] and len(out[1]) == 64 and out[3] is None


def test_nullify_never_loses_an_unhashed_value(spark):
    df = spark.createDataFrame([("a", "h"), ("b", None), (None, None)], "email string, email_hash string")
    assert values(pii.nullify_pii(df, ["email"], "email_hash"), "email") == [(None,), ("b",), (None,)]
    flight = pii.nullify_preflight({"t": (df, "email")})
    assert values(flight, "emails_to_nullify", "would_lose_data") == [(2, 1)]
    try:
        pii.assert_no_loss(flight)
    except ValueError as e:
        assert "t" in str(e)
    else:
        raise AssertionError("the preflight must stop the job")


def test_preserve_guard(spark):
    cols = ["email_hash", "phone_hash", "last_name_hash", "first_name_hash", "addresses_hash", "default_address_hash"]
    kind = "id int, " + ", ".join(f"{c} string" for c in cols)
    new = spark.createDataFrame([(1, "e", "p", "l", "f", None, None), (2, None, "p", "l", "f", None, None)], kind)
    old = spark.createDataFrame([(1, *["o"] * 6), (2, *["o"] * 6)], kind)
    out = {r.id: r for r in pii.preserve_customer_hashes(new, old).collect()}
    assert out[1].addresses_hash is None  # only an address hash is missing: the guard leaves the row alone
    assert out[2].email_hash == "o" and out[2].addresses_hash == "o" and out[2].phone_hash == "p"


def test_restore_touches_only_found_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "kept")], "id int, email string")
    backup = spark.createDataFrame([(1, "back"), (3, "other")], "id int, email string")
    assert sorted(values(pii.restore_pii(df, backup, "id", ["email"]), "id", "email")) == [(1, "back"), (2, "kept")]


def test_reference_keeps_nulls_out(spark):
    c = spark.createDataFrame([("a",), ("a",), (None,)], "email_hash string")
    o = spark.createDataFrame([("a",), ("b",), (None,)], "email_hash string")
    rows = {r.email_hash_original: r for r in pii.ref_email(c, o).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].sources == "shopify_customers, shopify_orders" and rows["a"].source_count == 2


def test_pair_counts_match_brute_force(spark):
    o = [("A@x.com", "1"), ("a@x.com", "2"), (" a@x.com", None), ("b@x.com", "3"), ("", None), (None, None)]
    c = [("a@x.com", "1"), ("a@X.com", None), ("b@x.com", "4"), ("z@x.com", "5")]
    kind = "email string, email_hash string"
    got = hash_checks.cross_table_consistency(spark.createDataFrame(o, kind), spark.createDataFrame(c, kind)).first()
    pairs = [(oh, ch, oe.strip().lower()) for oe, oh in set(o) if oe for ce, ch in set(c) if oe.strip().lower() == ce.strip().lower()]
    assert got.total_common_emails == len({p[2] for p in pairs})
    assert got.matching_hashes == sum(a == b and a is not None for a, b, _ in pairs)
    assert got.mismatched_hashes == sum(a != b or a is None for a, b, _ in pairs)


def test_anonymised_hash_differs_from_the_standard_one(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, name string, email string").select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "state", "tags")],
        *[F.lit(None).alias(c) for c in ("created_at", "updated_at", "orders_count", "total_spent")],
        *[F.lit(True).alias(c) for c in ("accepts_marketing", "verified_email")],
    )
    assert values(pii.anon_customers(df), "email_hash") == [(EMPTY_SHA256,)]
    assert values(pii.anon_customers(df, standard=True), "email_hash") == [(None,)]
