"""Files the extracts arrive in: newline JSON backups and daily shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BACKUP_SCHEMA = (
    "id bigint, customer struct<email:string,firstName:string,lastName:string>, _corrupt_record string"
)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the backup; those that are not JSON keep their text in `_corrupt_record`."""
    return (
        spark.read.schema(BACKUP_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def json_backup(lines: DataFrame) -> DataFrame:
    """Usable backup rows: those with an id and a customer, customer fields flat."""
    return lines.filter(
        F.col("_corrupt_record").isNull() & F.col("id").isNotNull() & F.col("customer").isNotNull()
    ).select(
        F.col("id").alias("order_id"),
        F.col("customer.email").alias("customer_email"),
        F.col("customer.firstName").alias("customer_first_name"),
        F.col("customer.lastName").alias("customer_last_name"),
    )


def backup_counts(lines: DataFrame) -> DataFrame:
    bad = F.col("_corrupt_record").isNotNull()
    usable = ~bad & F.col("id").isNotNull() & F.col("customer").isNotNull()
    return lines.agg(
        F.count("*").alias("processed"),
        F.count_if(bad).alias("errors"),
        F.count_if(usable).alias("usable"),
        F.count_if(~bad & ~usable).alias("skipped"),
    )


# Shard names: <prefix>YYYYMMDD for a finished day, <prefix>intraday_YYYYMMDD for the running one.
def shard_date(path: Column, prefix: str) -> Column:
    day = F.regexp_extract(path, prefix + r"(?:intraday_)?(\d{8})", 1)
    return F.to_date(F.nullif(day, F.lit("")), "yyyyMMdd")


def is_intraday(path: Column, prefix: str) -> Column:
    return path.contains(f"{prefix}intraday_")


def read_sharded(spark: SparkSession, folder: str, prefix: str = "events_", intraday: bool | None = None) -> DataFrame:
    """All daily shards under a prefix, with the shard's day and kind taken from its name.

    `intraday` keeps only the running-day shards (True) or only the finished ones (False).
    The glob itself leaves the other kind out, so its files are not listed.
    """
    globs = {True: [f"{prefix}intraday_*"], False: [f"{prefix}[0-9]*"], None: [f"{prefix}*"]}[intraday]
    path = F.col("_metadata.file_path")
    return spark.read.parquet(*[f"{folder}/{g}" for g in globs]).select(
        "*", shard_date(path, prefix).alias("shard_date"), is_intraday(path, prefix).alias("is_intraday")
    )


def shard_freshness(sharded: DataFrame) -> DataFrame:
    """Latest finished and latest running shard."""
    day, running = F.col("shard_date"), F.col("is_intraday")
    return sharded.agg(
        F.max(F.when(~running, day)).alias("latest_daily"), F.max(F.when(running, day)).alias("latest_intraday")
    )


def write_sharded(events: DataFrame, folder: str, day: Column, intraday_from: str, name: str = "events") -> None:
    """Lay events out as daily shards, one folder `<name>=YYYYMMDD` per finished day and
    `<name>=intraday_YYYYMMDD` per day from `intraday_from` on. Read back with prefix `<name>=`."""
    stamp = F.date_format(day, "yyyyMMdd")
    running = F.concat(F.lit("intraday_"), stamp)
    shard = F.when(day >= F.lit(intraday_from).cast("date"), running).otherwise(stamp)
    events.withColumn(name, shard).write.mode("overwrite").partitionBy(name).parquet(folder)
