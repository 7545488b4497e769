"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters records uniformly into buckets that fit in memory: a seeded hash of the key
picks the shard, a seeded hash of the whole record the bucket in the shard. Pass two permutes
each bucket by Fisher-Yates and writes it. A record's slot is its place in the bucket after
the buckets before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import fresh_path


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the key is highest; one more shard takes keys only into itself."""
    scored = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("score"), F.lit(s).alias("shard")) for s in range(shards)]
    return F.greatest(*scored)["shard"]


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one for the separator."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 42,
    bucket_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Write records into shards in random order and return what was written.

    The result has the columns of `docs` in one struct `record` (so no name of theirs clashes), and `shard`, `bucket`,
    `place` in the bucket, `grown_shard`; `with_slots` turns bucket and place into a slot. It lies in one folder per shard.

    Law `key`: id and shard count decide the shard; a null id is a key like any other. Records with
    equal ids share a shard but are scattered over its buckets by text and by place in the input, so
    a frequent id or text fills no bucket. A null text counts as empty for its size. Repeated rows
    are all kept. An empty table gives no rows.

    bucket_bytes: aimed-at text bytes per bucket; the number of buckets grows with the input.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(size_of(F.col(f"`{text_col}`")))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    key, text = F.col(f"record.`{id_col}`"), F.col(f"record.`{text_col}`")
    spread = F.xxhash64(F.lit(seed + 1), key, text, F.col("row"))
    scattered = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            "record",
            shard_of(key, shards, seed).alias("shard"),
            shard_of(key, shards + 1, seed).alias("grown_shard"),
            F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"),
            spread.alias("order"),
        )
        .repartition(min(shards * buckets, 1 << 16), "shard", "bucket")
    )
    # The rows of a bucket are put in a fixed order first: how the shuffle delivered them does not matter.
    permuted = (
        scattered.groupBy("shard", "bucket")
        .agg(F.collect_list(F.struct("order", "grown_shard", "record")).alias("rows"))
        .select("shard", "bucket", F.shuffle(F.array_sort("rows", _by_order), F.lit(seed)).alias("rows"))
        .select("shard", "bucket", F.posexplode("rows").alias("place", "row"))
        .select("shard", "bucket", "place", "row.grown_shard", "row.record")
    )
    path = path or fresh_path(spark, "shards")
    permuted.write.partitionBy("shard").parquet(path)
    kind = permuted.select("bucket", "place", "grown_shard", "record", "shard").schema
    return spark.read.schema(kind).parquet(path)


def _by_order(a: Column, b: Column) -> Column:
    return F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0)


def with_slots(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Add `slot`, gapless from 0 in each shard, to rows with `shard`, `bucket` and `place`, and drop the last two.

    It is the rows of earlier buckets of the shard plus the place in the own one. The rows may be any columns of what was
    written: only they are joined with the buckets' offsets.
    """
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    slot = (F.col("before") + F.col("place")).cast("long").alias("slot")
    return rows.join(offsets, ["shard", "bucket"]).select("*", slot).drop("before", "bucket", "place")


def sharding_digest(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """One row per written record: where it went, and what is needed to check it."""
    text, written = F.col("record.text"), write_shards(docs, shards, seed)
    rows = written.select(
        F.col("record.doc_id").alias("doc_id"),
        size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
        "bucket",
        "place",
    )
    return with_slots(rows, written)
