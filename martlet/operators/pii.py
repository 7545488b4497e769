"""Personal data: hash, nullify, preserve, mask, reference and restore.

NULL means "not given" and stays NULL through every step here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import (
    has_text,
    hash_json,
    hash_pii,
    json_text,
    mask_name,
    packed,
    percent,
    unpacked,
)
from martlet.operators.conform import shipping_geo
from martlet.operators.dedup import dedup_latest
from martlet.operators.joins import left_join_spread

ORDER_CLEAR = ("email", "contact_email", "phone", "billing_address", "shipping_address")
CUSTOMER_CLEAR = ("email", "phone", "last_name", "addresses", "default_address")
CUSTOMER_HASHES = (
    "email_hash",
    "phone_hash",
    "last_name_hash",
    "addresses_hash",
    "default_address_hash",
    "first_name_hash",
)


# ----------------------------------------------------------------------- clean layer
def clean_orders(raw_orders: DataFrame) -> DataFrame:
    """Latest version of each order, clear-text columns replaced by hashes."""
    return drop_pii(
        dedup_latest(raw_orders, ["id"], ["extracted_at"], _rest(raw_orders, "id", "extracted_at"))
        .withColumn("email_hash", hash_pii("email"))
        .withColumn("phone_hash", hash_pii("phone")),
        ORDER_CLEAR,
    )


def clean_customers(raw_customers: DataFrame) -> DataFrame:
    """Latest version of each customer with six hashes; the first name also stays readable."""
    plain = {f"{c}_hash": hash_pii(c) for c in ("email", "phone", "first_name", "last_name")}
    shaped = {f"{c}_hash": hash_json(c) for c in ("addresses", "default_address")}
    return drop_pii(
        dedup_latest(raw_customers, ["id"], ["extracted_at"], _rest(raw_customers, "id", "extracted_at")).withColumns(
            {**plain, **shaped}
        ),
        CUSTOMER_CLEAR,
    )


def _rest(df: DataFrame, *known: str) -> list[str]:
    """Tie-break of rows extracted at the same time: the update time where there is one, then all other columns."""
    first = [c for c in ("updated_at",) if c in df.columns and c not in known]
    return [*first, *[c for c in df.columns if c not in (*known, *first)]]


def hash_missing(df: DataFrame, source: str, target: str) -> DataFrame:
    """Fill the hash only where a source value is present and the hash is not."""
    todo = has_text(source) & ~has_text(target)
    return df.withColumn(target, F.when(todo, hash_pii(source)).otherwise(F.col(target)))


def ensure_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def drop_pii(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def hash_columns(df: DataFrame, cols: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Selected columns plus the hash of each JSON value in `cols` (source to target name)."""
    return df.select(*keep, *[hash_json(src).alias(dst) for src, dst in cols.items()])


# ---------------------------------------------------------------------------- nullify
def nullify_preflight(tables: Mapping[str, tuple[DataFrame, str]], hash_col: str = "email_hash") -> DataFrame:
    """Per table: values about to be erased, and those whose hash is missing (must be 0)."""
    return _stack(
        {
            name: df.agg(
                F.count_if(F.col(src).isNotNull()).alias("emails_to_nullify"),
                F.count_if(has_text(src) & F.col(hash_col).isNull()).alias("would_lose_data"),
            )
            for name, (df, src) in tables.items()
        },
        "table_name",
    )


def assert_no_loss(preflight: DataFrame) -> None:
    bad = preflight.filter("would_lose_data > 0").limit(1).collect()
    if bad:
        raise ValueError(f"unhashed values would be lost in {bad[0]['table_name']}")


def nullify_pii(df: DataFrame, cols: Sequence[str], hash_col: str) -> DataFrame:
    """Erase clear-text columns, row by row, only where the hash exists; the columns stay."""
    return df.withColumns({c: F.when(F.col(hash_col).isNull(), F.col(c)) for c in cols})


# --------------------------------------------------------------------------- preserve
def preserve_hashes(
    new: DataFrame, previous: DataFrame, key: str, cols: Sequence[str], guard: Sequence[str] | None = None
) -> DataFrame:
    """Fill NULL hashes from the previous clean table.

    A row is touched only if one of the `guard` columns is NULL (default: any of `cols`).
    Write the result to a new path: `previous` is still being read.
    """
    guard = list(guard or cols)
    before = previous.select(key, *[F.col(c).alias(f"_prev_{c}") for c in cols])
    incomplete = F.lit(False)
    for c in guard:
        incomplete = incomplete | F.col(c).isNull()
    filled = {c: F.when(incomplete, F.coalesce(c, f"_prev_{c}")).otherwise(F.col(c)) for c in cols}
    return new.join(before, key, "left").withColumns(filled).drop(*[f"_prev_{c}" for c in cols])


def preserve_order_hashes(new: DataFrame, previous: DataFrame) -> DataFrame:
    return preserve_hashes(new, previous, "id", ["email_hash", "phone_hash"])


def preserve_customer_hashes(new: DataFrame, previous: DataFrame) -> DataFrame:
    """All six hashes; rows that miss only an address hash are left as they are."""
    guard = ["email_hash", "phone_hash", "last_name_hash", "first_name_hash"]
    return preserve_hashes(new, previous, "id", CUSTOMER_HASHES, guard)


def restore_pii(df: DataFrame, backup: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Bring clear-text columns back from a staged backup wherever the key is found there."""
    b = backup.select(key, F.lit(True).alias("_found"), *[F.col(c).alias(f"_b_{c}") for c in cols])
    restored = {c: F.when(F.col("_found"), F.col(f"_b_{c}")).otherwise(F.col(c)) for c in cols}
    return df.join(b, key, "left").withColumns(restored).drop("_found", *[f"_b_{c}" for c in cols])


# ------------------------------------------------------------------------------- mask
def _anon_hash(c: str, lower: bool, standard: bool) -> Column:
    """Hash used by the masked views: NULL counts as '' and blanks stay, so it does not
    equal the usual hash. `standard=True` gives the usual one."""
    if standard:
        return hash_pii(c)
    value = F.coalesce(F.col(c), F.lit(""))
    return F.sha2(F.lower(value) if lower else value, 256)


def anon_orders(history: DataFrame, standard: bool = False) -> DataFrame:
    return history.select(
        "id",
        "name",
        "created_at",
        "currency_code",
        "total_price",
        _anon_hash("customer_id", False, standard).alias("customer_id_hash"),
        _anon_hash("customer_email", True, standard).alias("customer_email_hash"),
        mask_name("customer_first_name").alias("customer_first_name_masked"),
        mask_name("customer_last_name").alias("customer_last_name_masked"),
        "shipping_country",
        "shipping_city",
        "shipping_zip",
    )


def anon_customers(raw_customers: DataFrame, standard: bool = False) -> DataFrame:
    return raw_customers.select(
        "id",
        "created_at",
        "updated_at",
        "orders_count",
        "total_spent",
        _anon_hash("email", True, standard).alias("email_hash"),
        mask_name("first_name").alias("first_name_masked"),
        mask_name("last_name").alias("last_name_masked"),
        "state",
        "tags",
        "accepts_marketing",
        "verified_email",
    )


def anon_live_orders(raw_orders: DataFrame, standard: bool = False) -> DataFrame:
    return shipping_geo(raw_orders).select(
        "id",
        "name",
        "created_at",
        "processed_at",
        "currency",
        "financial_status",
        "fulfillment_status",
        "total_price",
        "total_tax",
        _anon_hash("email", True, standard).alias("email_hash"),
        "source_name",
        "landing_site",
        "referring_site",
        "tags",
        "shipping_country",
        "shipping_city",
        "shipping_province",
    )


def customer_id_mapping(history: DataFrame) -> DataFrame:
    """Distinct pairs of email hash and customer id hash, for authorised use only."""
    return (
        history.filter(has_text("customer_email"))
        .select(hash_pii("customer_email").alias("email_hash"), hash_pii("customer_id").alias("customer_id_hash"))
        .distinct()
    )


# -------------------------------------------------------------------- reference tables
def reference_table(
    sources: Sequence[tuple[DataFrame, str, str]], original: str, consistent: str, skip_empty: bool = False
) -> DataFrame:
    """Distinct non-null values over several sources, each with a second hash and where it was seen.

    `sources` lists (table, column, source name). Values are made distinct per source
    before they meet, so a frequent value is one row per source by the time it is grouped.
    """
    parts = None
    for df, col, source in sources:
        keep = has_text(col) if skip_empty else F.col(col).isNotNull()
        one = df.filter(keep).select(F.col(col).alias(original)).distinct().withColumn("source", F.lit(source))
        parts = one if parts is None else parts.unionByName(one)
    return (
        parts.groupBy(original)
        .agg(
            F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
            F.size(F.collect_set("source")).cast("bigint").alias("source_count"),
        )
        .select(original, F.sha2(original, 256).alias(consistent), "sources", "source_count")
    )


def _ref(field: str, *sources: tuple[DataFrame, str, str]) -> DataFrame:
    return reference_table(sources, f"{field}_hash_original", f"{field}_hash_consistent")


def ref_email(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return _ref("email", (customers, "email_hash", "shopify_customers"), (orders, "email_hash", "shopify_orders"))


def ref_phone(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return _ref("phone", (customers, "phone_hash", "shopify_customers"), (orders, "phone_hash", "shopify_orders"))


def ref_first_name(customers: DataFrame) -> DataFrame:
    return _ref("first_name", (customers, "first_name_hash", "shopify_customers"))


def ref_last_name(customers: DataFrame) -> DataFrame:
    return _ref("last_name", (customers, "last_name_hash", "shopify_customers"))


def ref_address(customers: DataFrame) -> DataFrame:
    return _ref(
        "address",
        (customers, "addresses_hash", "shopify_customers_addresses"),
        (customers, "default_address_hash", "shopify_customers_default_address"),
    )


def ref_ip(orders: DataFrame) -> DataFrame:
    return reference_table([(orders, "browser_ip", "shopify_orders")], "ip_original", "ip_hash_consistent", True)


def all_references(customers: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "email": ref_email(customers, orders),
        "phone": ref_phone(customers, orders),
        "first_name": ref_first_name(customers),
        "last_name": ref_last_name(customers),
        "address": ref_address(customers),
        "ip": ref_ip(orders),
    }


def original_column(field: str) -> str:
    return "ip_original" if field == "ip" else f"{field}_hash_original"


# Field, table, column and source name of every reference value.
REFERENCE_SOURCES = (
    ("email", "customers", "email_hash", "shopify_customers"),
    ("email", "orders", "email_hash", "shopify_orders"),
    ("phone", "customers", "phone_hash", "shopify_customers"),
    ("phone", "orders", "phone_hash", "shopify_orders"),
    ("first_name", "customers", "first_name_hash", "shopify_customers"),
    ("last_name", "customers", "last_name_hash", "shopify_customers"),
    ("address", "customers", "addresses_hash", "shopify_customers_addresses"),
    ("address", "customers", "default_address_hash", "shopify_customers_default_address"),
    ("ip", "orders", "browser_ip", "shopify_orders"),
)


def master_reference(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All reference tables in one, each clean table read once.

    A row is turned into its (field, value, source) entries; equal entries are merged
    before the values meet, so a value everyone shares is a few rows by then.
    """

    def entries(table: str, df: DataFrame) -> DataFrame:
        found = [
            F.struct(F.lit(field).alias("pii_field"), F.col(col).alias("original_value"), F.lit(source).alias("source"))
            for field, t, col, source in REFERENCE_SOURCES
            if t == table
        ]
        return df.select(F.explode(F.array(*found)).alias("e")).select("e.*")

    seen = entries("customers", customers).unionByName(entries("orders", orders))
    given = F.col("original_value").isNotNull() & ((F.col("pii_field") != "ip") | (F.col("original_value") != ""))
    return (
        seen.filter(given)
        .distinct()
        .groupBy("pii_field", "original_value")
        .agg(
            F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
            F.count("*").alias("source_count"),
        )
        .select(
            "pii_field",
            "original_value",
            F.sha2("original_value", 256).alias("consistent_hash"),
            "sources",
            "source_count",
        )
    )


def _with_references(df: DataFrame, master: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """Add the consistent hash of each field as `_<field>`, by one join with the master reference.

    A row becomes its (field, value) entries, which meet the reference together and come back together by the
    row's key. Rows without any value have no entry and keep NULLs. Keys are unique in the clean tables.
    """
    entries = F.array(*[F.struct(F.lit(f).alias("pii_field"), F.col(c).alias("original_value")) for f, c in columns.items()])
    given = df.select(key, F.explode(F.filter(entries, lambda e: e["original_value"].isNotNull())).alias("e")).select(key, "e.*")
    pairs = master.select("pii_field", "original_value", "consistent_hash")
    found = given.join(pairs, ["pii_field", "original_value"])
    hashes = found.groupBy(key).agg(
        *[F.max(F.when(F.col("pii_field") == f, F.col("consistent_hash"))).alias(f"_{f}") for f in columns]
    )
    return df.join(hashes, key, "left")


def _entries(df: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """The given values of a row, each with its field and the row's key as `_key`.

    The key is a struct: unlike a bare column it is never NULL, so Spark puts no filter on the key below the joins, and
    whatever shuffles the rows by it is the same for all who read them, and is done once.
    """
    values = F.array(*[F.struct(F.lit(f).alias("pii_field"), F.col(c).alias("original_value")) for f, c in columns.items()])
    given = F.explode(F.filter(values, lambda e: e["original_value"].isNotNull()))
    return df.select(F.struct(F.col(key).alias("k")).alias("_key"), given.alias("e")).select("_key", "e.*")


def _referenced(entries: DataFrame, master: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per key the consistent hash of each field as `_<field>`, by one join with the master reference.

    All (field, value) entries meet the reference together and come back together by the key. What has no
    reference keeps its own value, an address the hash of its own. Keys are unique in the clean tables.
    """
    given = entries.select("_key", "pii_field", packed("original_value").alias("_value"))
    pairs = master.select("pii_field", packed("original_value").alias("_value"), packed("consistent_hash").alias("_found"))
    own = F.when(F.col("pii_field") == "ip", packed(F.sha2(unpacked("_value"), 256))).otherwise(F.col("_value"))
    found = given.join(pairs, ["pii_field", "_value"], "left").select("_key", "pii_field", F.coalesce("_found", own).alias("_hash"))
    # Dealt by key as they are: a task of this join has one field's entry of a key, so adding up before would only widen the rows.
    hashes = found.repartition("_key").groupBy("_key").agg(
        *[F.max(F.when(F.col("pii_field") == f, F.col("_hash"))).alias(f"_{f}") for f in fields]
    )
    return hashes.select("_key", *[unpacked(f"_{f}").alias(f"_{f}") for f in fields])


def apply_references(orders: DataFrame, customers: DataFrame, master: DataFrame) -> DataFrame:
    """Orders with consistent hashes in place of the first ones; what has no reference keeps its own."""
    names = customers.select(
        F.col("id").alias("_customer"), packed("first_name_hash").alias("_first"), packed("last_name_hash").alias("_last")
    )
    # Only the ids go to the customers: names and other values become entries on their own.
    named = left_join_spread(orders.select("id", "user_id"), names, "user_id", "_customer", "id")
    named = named.select("id", unpacked("_first").alias("first_name_hash"), unpacked("_last").alias("last_name_hash"))
    of_order = {"email": "email_hash", "phone": "phone_hash", "ip": "browser_ip"}
    of_customer = {"first_name": "first_name_hash", "last_name": "last_name_hash"}
    entries = _entries(orders, of_order, "id").unionByName(_entries(named, of_customer, "id"))
    hashes = _referenced(entries, master, [*of_order, *of_customer])
    return named.select("id", F.struct(F.col("id").alias("k")).alias("_key")).join(hashes, "_key", "left").select(
        "id",
        F.col("_email").alias("order_email_hash"),
        F.col("_phone").alias("order_phone_hash"),
        F.col("_first_name").alias("customer_first_name_hash"),
        F.col("_last_name").alias("customer_last_name_hash"),
        F.col("_ip").alias("browser_ip_hash"),
    )


def customer_profile(customers: DataFrame, master: DataFrame) -> DataFrame:
    """Consistent hashes per customer, what is missing, and a completeness score of 0 to 5."""
    columns = {
        "email": "email_hash",
        "phone": "phone_hash",
        "first_name": "first_name_hash",
        "last_name": "last_name_hash",
        "address": "addresses_hash",
    }
    df = _with_references(customers, master, columns, "id")

    def status(col: str, label: str) -> Column:
        return F.when(F.col(col).isNull(), f"No {label}").otherwise(f"Has {label}")

    score = F.lit(0)
    for col in columns.values():
        score = score + F.col(col).isNotNull().cast("int")
    return df.select(
        F.col("id").alias("customer_id"),
        *[F.col(f"_{f}").alias(f"{f}_hash") for f in columns],
        status("email_hash", "Email").alias("email_status"),
        status("phone_hash", "Phone").alias("phone_status"),
        status("addresses_hash", "Address").alias("address_status"),
        score.cast("bigint").alias("profile_completeness_score"),
    )


# Risk bands of an address, and the counts above which they begin.
HIGH_RISK = "High Risk - Many accounts from same IP"
MEDIUM_RISK = "Medium Risk - Multiple accounts"
HIGH_ABOVE, MEDIUM_ABOVE = 5, 3


def fraud_by_ip(orders: DataFrame) -> DataFrame:
    """Addresses used with several emails or phones, with a risk band.

    The consistent hash is a function of the value, so it is computed in place instead
    of looked up. Both distinct counts come from one pass over (address, field, value).
    """
    values = orders.filter(F.col("browser_ip").isNotNull()).select(
        F.when(F.col("browser_ip") != "", F.sha2("browser_ip", 256)).alias("ip_hash_consistent"),
        F.explode(
            F.array(
                F.struct(F.lit("order").alias("field"), F.lit(None).cast("string").alias("value")),
                F.struct(F.lit("email").alias("field"), F.col("email_hash").alias("value")),
                F.struct(F.lit("phone").alias("field"), F.col("phone_hash").alias("value")),
            )
        ).alias("p"),
    )
    per_value = (
        values.filter((F.col("p.field") == "order") | F.col("p.value").isNotNull())
        .groupBy("ip_hash_consistent", F.col("p.field").alias("field"), F.col("p.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    per_ip = per_value.groupBy("ip_hash_consistent").agg(
        F.count_if(F.col("field") == "email").alias("unique_emails"),
        F.count_if(F.col("field") == "phone").alias("unique_phones"),
        F.sum(F.when(F.col("field") == "order", F.col("n"))).alias("order_count"),
    )
    emails, phones = F.col("unique_emails"), F.col("unique_phones")
    return per_ip.filter((emails > 1) | (phones > 1)).withColumn(
        "fraud_risk",
        F.when((emails > HIGH_ABOVE) & (phones > HIGH_ABOVE), HIGH_RISK)
        .when(emails > MEDIUM_ABOVE, MEDIUM_RISK)
        .otherwise("Normal"),
    )


# ------------------------------------------------------------------------------ audits
def _stack(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias(label), "*")
        out = one if out is None else out.unionByName(one)
    return out


def exposure_rules(rules: Mapping[str, Column], df: DataFrame) -> DataFrame:
    """One pass over `df`: rows that meet each rule, in long form."""
    counts = df.agg(F.count("*").alias("_total"), *[F.count_if(c).alias(k) for k, c in rules.items()])
    return counts.unpivot(["_total"], list(rules), "pii_field", "exposed").select(
        "pii_field", "exposed", F.col("_total").alias("total_rows")
    )


def looks_like_email(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.like("%@%"), F.lit(False))


def pii_exposure(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Clear-text personal data per table and field, PASS or FAIL, and one OVERALL line."""
    per_field = _stack({name: exposure_rules(rules, df) for name, (df, rules) in tables.items()}, "table_name")
    verdict = F.when(F.col("exposed") == 0, "PASS").otherwise("FAIL").alias("status")
    overall = per_field.agg(F.sum("exposed").alias("exposed"), F.sum("total_rows").alias("total_rows")).select(
        F.lit("OVERALL").alias("table_name"), F.lit("all").alias("pii_field"), "exposed", "total_rows", verdict
    )
    return per_field.select("table_name", "pii_field", "exposed", "total_rows", verdict).unionByName(overall)


def standard_exposure(orders: DataFrame, customers: DataFrame, orders_clean: DataFrame, customers_clean: DataFrame):
    in_json = lambda path: json_text("customer", path)
    long_phone = has_text("phone") & (F.length("phone") > 3)
    return pii_exposure(
        {
            "orders": (
                orders,
                {
                    "email": looks_like_email("email"),
                    "contact_email": looks_like_email("contact_email"),
                    "phone": long_phone,
                    "browser_ip": has_text("browser_ip"),
                    "customer_json": looks_like_email(in_json("$.email")),
                },
            ),
            "customers": (
                customers,
                {
                    "email": looks_like_email("email"),
                    "phone": long_phone,
                    "first_name": has_text("first_name"),
                    "last_name": has_text("last_name"),
                },
            ),
            "orders_clean": (
                orders_clean,
                {
                    "customer_email_in_json": looks_like_email(in_json("$.email")),
                    "customer_name_in_json": has_text(in_json("$.first_name")),
                },
            ),
            "customers_clean": (customers_clean, {"first_name": has_text("first_name")}),
        }
    )


def pii_non_null_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows still holding a value, per table and field, with the share they make up."""
    per_field = _stack(
        {
            name: exposure_rules({c: F.col(c).isNotNull() for c in cols}, df)
            for name, (df, cols) in tables.items()
        },
        "table_name",
    )
    return per_field.select(
        "table_name",
        "pii_field",
        F.col("exposed").alias("non_null_count"),
        "total_rows",
        percent(F.col("exposed"), F.col("total_rows")).alias("pii_exposure_pct"),
    )


def pii_column_scan(tables: Mapping[str, DataFrame], mapping: Mapping[str, Mapping[str, str]], samples: int = 3):
    """Which mapped columns exist, how many rows hold a value, and a few short samples of each.

    The samples are the smallest texts, each cut to 30 characters. Counts and samples of all columns come from one
    pass: a row gives its (column, value) entries, equal ones are counted before they move, and a limit per
    column keeps the smallest.
    """
    parts = None
    for table, fields in mapping.items():
        df = tables[table]
        present = [c for c in fields if c in df.columns]
        if not present:
            continue
        text = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in present]
        values = (
            df.select(F.explode(F.array(*text)).alias("e"))
            .groupBy(F.col("e.column_name").alias("column_name"), F.substring("e.v", 1, 30).alias("sample"))
            .agg(F.count("e.v").alias("n"), F.count_if(has_text(F.col("e.v"))).alias("filled"))
        )
        order = Window.partitionBy("column_name").orderBy((F.col("filled") == 0).asc(), "sample")
        place = F.col("filled") > 0
        top = values.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= samples)
        repeated = F.array_repeat("sample", F.least(F.col("filled"), F.lit(samples)).cast("int"))
        listed = (
            top.filter(place)
            .groupBy("column_name")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list(repeated))), 1, samples).alias("s"))
            .select("column_name", F.array_join("s", " | ").alias("samples"))
        )
        counts = values.groupBy("column_name").agg(F.sum("n").alias("rows_with_data"))
        kinds = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
        scanned = counts.join(listed, "column_name", "left").select(
            F.lit(table).alias("table_name"),
            "column_name",
            kinds[F.col("column_name")].alias("pii_type"),
            "rows_with_data",
            "samples",
        )
        parts = scanned if parts is None else parts.unionByName(scanned)
    return parts
