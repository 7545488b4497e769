"""Two tables compared by digests of their parts, so that rows are read only where the tables differ.

A table is stored with a folder per part: a bucket of its key, or a bucket of each day. Beside it lies a small table with one
digest per part, made of order-free aggregates: the count of rows, the XOR of one hash of each row and the sum of another. XOR alone would
not see two equal rows come or go together. Parts with equal digests hold equal rows (up to two 64-bit hashes colliding at once), others are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.reconcile import missing_records, record_count_diff

PART = "part"
DIGEST = ["rows", "hashes_xor", "hashes_sum"]


def row_hash(columns: Sequence[str], salt: int) -> Column:
    """A hash of a row in which NULLs count at their place; Spark's hash alone passes over them."""
    marked = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(salt), *marked)


def part_of(keys: Sequence[str], buckets: int, day: Column | None = None) -> Column:
    """The part of a row. A key without a day lies whole in one part; rows without a date have parts of their own."""
    bucket = F.pmod(row_hash(keys, 0), F.lit(buckets)).cast("string")
    return bucket if day is None else F.concat_ws("_", F.coalesce(day.cast("date").cast("string"), F.lit("none")), bucket)


def digests(df: DataFrame, columns: Sequence[str], part: str = PART) -> DataFrame:
    """One row per part; partial aggregates shrink each task's rows before the shuffle, so a hot part costs no more."""
    return df.groupBy(part).agg(
        F.count("*").alias("rows"),
        F.bit_xor(row_hash(columns, 1)).alias("hashes_xor"),
        F.sum(row_hash(columns, 2).cast("decimal(38,0)")).alias("hashes_sum"),
    )


def differing_parts(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Parts whose digests differ, or that one side lacks. Equal digests meet in one group, so one grouping is enough."""
    both = source.select(PART, *DIGEST).unionByName(warehouse.select(PART, *DIGEST))
    return both.groupBy(PART, *DIGEST).agg(F.count("*").alias("sides")).filter("sides = 1").select(PART).distinct()


def store_parts(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, day: Column | None = None, columns: Sequence[str] | None = None
) -> None:
    """Create or replace the table at `path` in parts, and its digests over `columns` (all by default).

    The digests are those of the rows as stored. Spark splits a large part over several files. Columns named like the part
    column are refused; a type that has no hash (a map) must be left out of `columns`.
    """
    if PART in df.columns:
        raise ValueError(f"a column is called {PART}")
    spark = df.sparkSession
    placed = df.withColumn(PART, part_of(keys, buckets, day))
    placed.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    digests(stored_rows(spark, path, df), columns or df.columns).write.mode("overwrite").parquet(f"{path}/digests")


def stored_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows stored at `path`, with their part; `like` has their columns (a table without rows has no file to tell)."""
    schema = like.select("*", F.lit("").alias(PART)).schema
    return spark.read.schema(schema).parquet(f"{path}/rows")


def stored_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part string, rows long, hashes_xor long, hashes_sum decimal(38,0)").parquet(f"{path}/digests")


def _differing(source: str, warehouse: str, like: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the differing parts on both sides, and the other rows of the same buckets, which both sides hold alike.

    The tables are stored with equal keys, buckets, days and columns. The driver learns the names of the differing parts: at most as many
    as the folders it lists to read a table at all. The filters name parts only, so Spark opens no other folder.
    """
    spark = like.sparkSession
    found = differing_parts(stored_digests(spark, source), stored_digests(spark, warehouse))
    parts = [r[0] for r in found.collect()]
    here = F.col(PART).isin(parts)
    s, w = (stored_rows(spark, path, like).filter(here).drop(PART) for path in (source, warehouse))
    bucket = F.substring_index(PART, "_", -1).isin(sorted({p.rpartition("_")[2] for p in parts}))
    return s, w, stored_rows(spark, source, like).filter(bucket & ~here).drop(PART)


def _also_elsewhere(found: DataFrame, alike: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join keys that differ with those that lie in equal parts too, on other days of their bucket."""
    known = alike.select(*keys, F.lit(True).alias("_known")).distinct()
    same = [F.col(f"found.`{k}`").eqNullSafe(F.col(f"known.`{k}`")) for k in keys]
    return found.alias("found").join(known.alias("known"), same, how)


def missing_stored(source: str, warehouse: str, keys: Sequence[str], like: DataFrame) -> DataFrame:
    """`missing_records` of two stored tables: reads the parts that differ, and the keys of their buckets' other days.

    The latter because a key may have rows on several days, of which one side lacks some only.
    """
    s, w, alike = _differing(source, warehouse, like)
    return _also_elsewhere(missing_records(s, w, keys), alike, keys, "left_anti")


def count_changes(source: str, warehouse: str, keys: Sequence[str], like: DataFrame, warn: float = 1.0, crit: float = 5.0) -> DataFrame:
    """The rows of `record_count_diff` whose counts differ. The tables must be stored by these keys and without days."""
    s, w, _ = _differing(source, warehouse, like)
    counted = record_count_diff(s, w, keys, warn, crit)
    return counted.filter(F.col("source_value") != F.col("warehouse_value"))


def changed_records(source: DataFrame, warehouse: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Keys whose rows differ: missing on a side, or other rows. Rows are compared as bags, in one grouping over both sides.

    NULL keys are equal. Each task adds up its rows of a key first, so a key with many rows does not meet in one task.
    """
    columns = list(columns or source.columns)
    side = lambda df, s: df.select(*keys, F.lit(s).alias("_s"), row_hash(columns, 1).alias("_x"), row_hash(columns, 2).alias("_y"))
    on = lambda s, c: F.when(F.col("_s") == s, F.col(c))
    seen = side(source, 0).unionByName(side(warehouse, 1)).groupBy(*keys)
    both = seen.agg(
        *[F.count(on(s, "_s")).alias(f"n{s}") for s in (0, 1)],
        *[F.bit_xor(on(s, "_x")).alias(f"x{s}") for s in (0, 1)],
        *[F.sum(on(s, "_y").cast("decimal(38,0)")).alias(f"y{s}") for s in (0, 1)],
    )
    equal = (F.col("n0") == F.col("n1")) & (F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1"))
    status = F.when(F.col("n1") == 0, "missing in warehouse").when(F.col("n0") == 0, "missing in source").when(~equal, "changed")
    return both.select(*keys, status.alias("status")).filter(F.col("status").isNotNull())


def changed_stored(source: str, warehouse: str, keys: Sequence[str], like: DataFrame) -> DataFrame:
    """`changed_records` of two stored tables; reads what `missing_stored` does."""
    s, w, alike = _differing(source, warehouse, like)
    joined = _also_elsewhere(changed_records(s, w, keys, like.columns), alike, keys, "left")
    status = F.when(F.col("_known"), "changed").otherwise(F.col("status"))
    return joined.select(*[F.col(f"found.`{k}`").alias(k) for k in keys], status.alias("status"))
