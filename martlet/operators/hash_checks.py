"""Checks on hashed personal data: format, coverage, agreement between tables, references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import EMPTY_SHA256, divide, has_text, hash_pii, percent, trim_ws
from martlet.operators.checks import union

HASH = "email_hash"


def _normal(c: str) -> Column:
    return F.lower(trim_ws(c))


def _real(c: str = HASH) -> Column:
    """A hash is there and is not the hash of nothing."""
    return has_text(c) & (F.col(c) != EMPTY_SHA256)


def per_table(tables: Mapping[str, DataFrame], fn) -> DataFrame:
    return union(fn(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items())


def hash_format(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Hashes of the right length, of a wrong one, and missing; under 1 % missing still passes."""

    def one(df: DataFrame) -> DataFrame:
        there, long = has_text(HASH), F.length(HASH) == 64
        return df.agg(
            F.count("*").alias("total"),
            F.count_if(there & long).alias("correct"),
            F.count_if(there & ~long).alias("wrong"),
            F.count_if(~there).alias("missing"),
        ).withColumn(
            "status",
            F.when(F.col("wrong") > 0, "FAIL")
            .when(F.col("missing") == 0, "PASS")
            .when(divide(F.col("missing"), F.col("total")) < 0.01, "PASS")
            .otherwise("WARNING"),
        )

    return per_table(tables, one)


def hash_match_rate(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct order hashes that a customer has too."""
    o = orders.filter(_real()).select(HASH).distinct().withColumn("o", F.lit(1))
    c = customers.filter(_real()).select(HASH).distinct().withColumn("c", F.lit(1))
    stats = o.join(c, HASH, "full_outer").agg(
        F.count("o").alias("order_hashes"),
        F.count("c").alias("customer_hashes"),
        F.count_if(F.col("o").isNotNull() & F.col("c").isNotNull()).alias("matched"),
    )
    rate = F.coalesce(percent(F.col("matched"), F.col("order_hashes")), F.lit(0.0))
    return stats.withColumn("match_rate", rate).withColumn(
        "status",
        F.when(F.col("match_rate") >= 70, "PASS").when(F.col("match_rate") >= 50, "WARNING").otherwise("FAIL"),
    )


def hash_normalisation(customers: DataFrame, email: str = "email") -> DataFrame:
    """Every address hashed as it is, in upper case and padded: all three must agree."""
    given = customers.filter(has_text(email)).select(F.col(email).alias("e"))
    plain = hash_pii("e")
    loud = hash_pii(F.upper("e"))
    padded = hash_pii(F.concat(F.lit(" \t"), F.col("e"), F.lit("\n ")))
    same = (plain == loud) & (plain == padded) & (F.length(plain) == 64)
    return given.agg(
        F.count("*").alias("values_tested"),
        F.count_if(same).alias("equal_hashes"),
        F.count_if(~same).alias("different_hashes"),
    ).withColumn("result", F.when(F.col("different_hashes") == 0, "PASS").otherwise("FAIL"))


def cross_table_consistency(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Emails found in both tables: how many (spelling, spelling) pairs carry equal hashes.

    Pairs are counted, not built: per email, each side's spellings are counted per hash,
    and matching pairs are the products of those counts.
    """

    def side(df: DataFrame, n: str) -> DataFrame:
        spellings = df.filter(has_text("email")).select("email", HASH).distinct()
        return spellings.groupBy(_normal("email").alias("e"), F.col(HASH).alias("h")).agg(F.count("*").alias(n))

    o, c = side(orders, "no"), side(customers, "nc")
    per_email = (
        o.select("e", "h", "no", F.lit(0).cast("bigint").alias("nc"))
        .unionByName(c.select("e", "h", F.lit(0).cast("bigint").alias("no"), "nc"))
        .groupBy("e", "h")
        .agg(F.sum("no").alias("no"), F.sum("nc").alias("nc"))
        .groupBy("e")
        .agg(
            (F.sum("no") * F.sum("nc")).alias("pairs"),
            F.sum(F.when(F.col("h").isNotNull(), F.col("no") * F.col("nc")).otherwise(0)).alias("same"),
        )
        .filter("pairs > 0")
    )
    return per_email.agg(
        F.count("*").alias("total_common_emails"),
        F.coalesce(F.sum("same"), F.lit(0)).alias("matching_hashes"),
        F.coalesce(F.sum(F.col("pairs") - F.col("same")), F.lit(0)).alias("mismatched_hashes"),
    ).withColumn("test_result", F.when(F.col("mismatched_hashes") == 0, "PASS").otherwise("FAIL"))


def cross_table_list(orders: DataFrame, customers: DataFrame, n: int = 20) -> DataFrame:
    """First `n` common emails with the smallest hash each table holds for them."""

    def side(df: DataFrame, out: str) -> DataFrame:
        return df.filter(has_text("email")).groupBy(_normal("email").alias("e")).agg(F.min(HASH).alias(out))

    j = side(orders, "order_hash").join(side(customers, "customer_hash"), "e").orderBy("e").limit(n)
    o, c = F.col("order_hash"), F.col("customer_hash")
    return j.select(
        F.col("e").alias("email"),
        "order_hash",
        "customer_hash",
        F.when(o == c, "MATCH").when(o.isNull() | c.isNull(), "MISSING HASH").otherwise("MISMATCH").alias("status"),
    )


def hash_overlap(orders: DataFrame, customers: DataFrame) -> DataFrame:
    o = orders.select(hash_pii("email").alias("h")).distinct().withColumn("o", F.lit(1))
    c = customers.select(hash_pii("email").alias("h")).distinct().withColumn("c", F.lit(1))
    both = o.filter("h IS NOT NULL").join(c.filter("h IS NOT NULL"), "h", "full_outer")
    return both.agg(
        F.count("o").alias("unique_orders_emails"),
        F.count("c").alias("unique_customers_emails"),
        F.count_if(F.col("o").isNotNull() & F.col("c").isNotNull()).alias("matching_emails_across_tables"),
    )


def empty_hash_rate(tables: Mapping[str, DataFrame]) -> DataFrame:
    def one(df: DataFrame) -> DataFrame:
        return df.agg(
            F.count_if(F.col(HASH) == EMPTY_SHA256).alias("empty_hash_count"), F.count("*").alias("total_count")
        ).withColumns(
            {
                "pct_empty": percent(F.col("empty_hash_count"), F.col("total_count")),
                "result": F.when(divide(F.col("empty_hash_count"), F.col("total_count")) < 0.05, "PASS").otherwise(
                    "WARNING - high empty rate"
                ),
            }
        )

    return per_table(tables, one)


def hash_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    def one(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("total_rows"), F.count_if(has_text(HASH)).alias("has_hash")).withColumns(
            {
                "pct_coverage": percent(F.col("has_hash"), F.col("total_rows")),
                "result": F.when(divide(F.col("has_hash"), F.col("total_rows")) > 0.95, "PASS").otherwise(
                    "FAIL - low coverage"
                ),
            }
        )

    return per_table(tables, one)


def hash_coverage_detail(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Clear text without hash and hash without clear text, per table."""

    def one(df: DataFrame, email: str) -> DataFrame:
        given, hashed = has_text(email), has_text(HASH)
        return df.agg(
            F.count("*").alias("total_rows"),
            F.count_if(given).alias("rows_with_email"),
            F.count_if(hashed).alias("rows_with_hash"),
            F.count_if(given & ~hashed).alias("unhashed_emails"),
            F.count_if(~given & hashed).alias("hash_without_email"),
            percent(F.count_if(given & hashed), F.count_if(given)).alias("pct_hashed"),
        )

    return union(one(df, e).select(F.lit(name).alias("table_name"), "*") for name, (df, e) in tables.items())


def unhashed_emails(df: DataFrame, table: str, n: int = 10) -> DataFrame:
    return (
        df.filter(has_text("email") & ~has_text(HASH))
        .orderBy("id", "extracted_at")
        .limit(n)
        .select(F.lit(table).alias("table_name"), "id", "email", "created_at")
    )


def unique_email_vs_hash(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct emails and distinct hashes; equal if hashing is consistent. One shuffle for both counts."""

    def one(df: DataFrame) -> DataFrame:
        values = F.array(
            F.struct(F.lit("e").alias("k"), _normal("email").alias("v")),
            F.struct(F.lit("h").alias("k"), F.col(HASH).alias("v")),
        )
        pairs = df.filter(has_text("email")).select(F.explode(values).alias("p")).select("p.k", "p.v")
        return (
            pairs.filter(F.col("v").isNotNull())
            .distinct()
            .agg(
                F.count_if(F.col("k") == "e").alias("unique_emails"),
                F.count_if(F.col("k") == "h").alias("unique_hashes"),
            )
        )

    return per_table(tables, one)


def post_nullify_verify(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    def one(df: DataFrame, email: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("total_rows"),
            F.count_if(has_text(email)).alias("remaining_emails"),
            F.count(HASH).alias("hashes_preserved"),
        ).withColumn(
            "status",
            F.when((F.col("remaining_emails") == 0) & (F.col("hashes_preserved") > 0), "PASS").otherwise("FAIL"),
        )

    return union(one(df, e).select(F.lit(name).alias("table_name"), "*") for name, (df, e) in tables.items())


def restore_verify(df: DataFrame, fields: Sequence[str], hash_col: str = HASH) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count(f).alias(f"with_{f}") for f in fields],
        F.count(hash_col).alias("with_hash"),
    )


# ------------------------------------------------------------------- reference tables
def ref_null_check(master: DataFrame) -> DataFrame:
    """No reference table may hold a NULL on either side."""
    return master.groupBy(F.col("pii_field").alias("table_name")).agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("original_value").isNull()).alias("null_original"),
        F.count_if(F.col("consistent_hash").isNull()).alias("null_consistent"),
    )


def ref_summary(master: DataFrame) -> DataFrame:
    return master.groupBy("pii_field").agg(
        F.count("*").alias("unique_values"),
        F.sum("source_count").alias("total_occurrences"),
        divide(F.sum("source_count"), F.count("*")).alias("avg_sources_per_value"),
    )


def ref_multi_source(master: DataFrame) -> DataFrame:
    return master.filter("source_count > 1").groupBy("pii_field").agg(F.count("*").alias("values_in_multiple_sources"))


def cross_source_customers(email_refs: DataFrame, n: int = 10) -> DataFrame:
    return (
        email_refs.filter("source_count > 1")
        .orderBy(F.col("source_count").desc(), "email_hash_consistent")
        .limit(n)
        .select(
            "email_hash_consistent", F.col("source_count").alias("platforms_count"), F.col("sources").alias("platforms")
        )
    )


def ref_one_to_one(email_refs: DataFrame) -> DataFrame:
    """Rows, distinct originals and distinct consistent hashes: three equal numbers."""
    per_pair = email_refs.select(
        F.explode(
            F.array(
                F.struct(F.lit("o").alias("k"), F.col("email_hash_original").alias("v")),
                F.struct(F.lit("c").alias("k"), F.col("email_hash_consistent").alias("v")),
            )
        ).alias("p")
    )
    return (
        per_pair.groupBy("p.k", "p.v")
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum(F.when(F.col("k") == "o", F.col("n"))).alias("total_hashes"),
            F.count_if(F.col("k") == "o").alias("unique_emails"),
            F.count_if(F.col("k") == "c").alias("unique_consistent_hashes"),
        )
    )


def null_preservation(shop: DataFrame) -> DataFrame:
    o, c = F.count_if(F.col("order_email_hash").isNull()), F.count_if(F.col("customer_email_hash").isNull())
    return shop.agg(
        F.count("*").alias("total_orders"),
        o.alias("null_order_emails"),
        c.alias("null_customer_emails"),
        percent(o, F.count("*")).alias("null_order_email_pct"),
        percent(c, F.count("*")).alias("null_customer_email_pct"),
    )


def distinct_hash_union(shop: DataFrame) -> DataFrame:
    """Distinct hashes over orders and customers together, and on either side."""
    sides = F.array(
        F.struct(F.col("order_email_hash").alias("h"), F.lit(1).alias("o"), F.lit(0).alias("c")),
        F.struct(F.col("customer_email_hash").alias("h"), F.lit(0).alias("o"), F.lit(1).alias("c")),
    )
    per_hash = (
        shop.select(F.explode(sides).alias("s"))
        .filter("s.h IS NOT NULL")
        .groupBy("s.h")
        .agg(F.max("s.o").alias("o"), F.max("s.c").alias("c"))
    )
    return per_hash.agg(
        F.count("*").alias("total_unique_hashes"),
        F.sum("o").alias("unique_order_hashes"),
        F.sum("c").alias("unique_customer_hashes"),
    )


def hash_frequency_anomaly(df: DataFrame, col: str, minimum: int = 1000) -> DataFrame:
    """Hashes that occur too often to belong to one person: most likely a hashed NULL."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count("*").alias("occurrence_count"))
        .filter(F.col("occurrence_count") > minimum)
    )


def pii_null_rates(customers: DataFrame) -> DataFrame:
    types = {
        "Email": "email_hash",
        "Phone": "phone_hash",
        "First Name": "first_name_hash",
        "Last Name": "last_name_hash",
        "Address": "addresses_hash",
    }
    one = customers.agg(F.count("*").alias("total_customers"), *[F.count(c).alias(label) for label, c in types.items()])
    return one.unpivot(["total_customers"], [F.col(f"`{t}`") for t in types], "pii_type", "has_value").select(
        "pii_type",
        "total_customers",
        "has_value",
        (F.col("total_customers") - F.col("has_value")).alias("is_null"),
        percent(F.col("total_customers") - F.col("has_value"), F.col("total_customers")).alias("null_pct"),
    )
