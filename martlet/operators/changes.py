"""Row changes, as transforms and on tables of partitions.

The transforms give a new table. The changes of tables at a path rewrite the partitions that hold a touched row and no other; such a change writes its
new partitions aside first, so what it reads is never what it overwrites, and a run after a loss goes on from what lies aside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import as_date
from martlet.operators.dedup import dedup_latest


def update_where(df: DataFrame, condition: Column, sets: Mapping[str, Column]) -> DataFrame:
    """Set columns on rows that meet the condition; an unknown (NULL) condition changes nothing."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in sets.items()})


def update_from(
    df: DataFrame, source: DataFrame, key: str, sets: Mapping[str, Column], condition: Column | None = None
) -> DataFrame:
    """Update from a joined table. `sets` and `condition` refer to its columns as `src_<name>`.

    Two source rows for one matched key make the update ambiguous: the run fails on them.
    """
    others = [c for c in source.columns if c != key]
    single = (
        source.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"), *[F.max(F.struct(F.col(c).alias("v")))["v"].alias(f"src_{c}") for c in others])
    )
    ambiguous = F.raise_error(F.concat(F.lit("several source rows for key "), F.col(key).cast("string")))
    hit = F.when(F.col("_n") == 1, F.lit(True)).when(F.col("_n") > 1, ambiguous.cast("boolean"))
    if condition is not None:
        hit = hit & condition
    matched = single.withColumn("_matched", F.col(key).cast("string")).drop(key)
    spread = F.concat(F.lit("null:"), F.xxhash64(*[c for c in df.columns if c != key]).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("string"), spread))  # NULL keys must not meet in one task
    joined = keyed.join(matched, F.col("_key") == F.col("_matched"), "left")
    return update_where(joined, hit, sets).drop("_n", "_key", "_matched", *[f"src_{c}" for c in others])


def retention_delete(df: DataFrame, col: str, as_of, days: int = 730) -> DataFrame:
    """Drop rows older than the retention period; rows without a date are kept, as a DELETE would."""
    old = F.col(col) < F.date_sub(as_date(as_of), days)
    return df.filter(~F.coalesce(old, F.lit(False)))


def batch_merge(target: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Insert-or-replace: the batch's latest row wins over the target's, other rows stay.

    One window over both sides instead of a join: a single shuffle on the key.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return dedup_latest(both, [key], ["_new", *order]).drop("_new")


# ------------------------------------------------------------------ tables of partitions
# Fixed value: the folder of the partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _in(by: str, values: Sequence) -> Column:
    """Rows of these partitions, as a filter that prunes."""
    some = F.col(by).isin([v for v in values if v is not None])
    return some | F.col(by).isNull() if None in values else some


def _values(df: DataFrame, by: str) -> list:
    """The partitions of some rows: days or the like, so few that the driver may know them."""
    return [r[0] for r in df.select(by).distinct().collect()]


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _swap_in(spark: SparkSession, path: str, by: str, aside: str) -> None:
    """Whole partitions that lie aside, if they are complete, take the place of those of the table."""
    if _exists(spark, f"{aside}/_SUCCESS"):
        ready = spark.read.parquet(aside)
        ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
        _delete(spark, aside)


def _overwrite(df: DataFrame, path: str, by: str, aside: str) -> None:
    df.write.mode("overwrite").parquet(aside)
    _swap_in(df.sparkSession, path, by, aside)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}-aside"


def _table(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The table at `path`, after a change that was lost between its two writes has been brought to its end."""
    _swap_in(spark, path, by, _aside(path))
    return spark.read.parquet(path)


def settle(spark: SparkSession, path: str, by: str) -> None:
    """Bring a change of the table at `path` to its end that was lost between its two writes; ask this before reading what a change builds on."""
    _swap_in(spark, path, by, _aside(path))


def rewrite_partitions(spark: SparkSession, path: str, by: str, values: Sequence, rows: DataFrame) -> None:
    """Make `rows` the whole content of the partitions `values` of the table at `path`; a partition they leave without rows is dropped.

    Rows of other partitions are refused. `rows` may read from the table, after `settle`.
    """
    # As a value and not as a filter: Spark would also ask the folders that another filter has ruled out.
    outside = F.raise_error(F.concat(F.lit(f"a row of another {by}: "), F.coalesce(F.col(by).cast("string"), F.lit("none"))))
    checked = F.when(F.coalesce(_in(by, values), F.lit(False)), F.col(by)).otherwise(outside.cast(rows.schema[by].dataType))
    rows.withColumn(by, checked).write.mode("overwrite").parquet(_aside(path))
    left = _values(spark.read.schema(rows.schema).parquet(_aside(path)), by)
    held = _values(spark.read.parquet(path).select(by), by) if _exists(spark, path) else []
    _swap_in(spark, path, by, _aside(path))
    for value in (v for v in held if v in values and v not in left):
        _delete(spark, f"{path.rstrip('/')}/{by}={NO_VALUE if value is None else value}")


def replace_partitions(spark: SparkSession, path: str, by: str, rows: DataFrame, key: Sequence[str], aside: str) -> None:
    """Insert-or-replace `rows` by `key` into the table at `path`, whose partitions are days or the like; a key stays in its partition.

    Doing it again with the same rows changes nothing. NULLs in the key are equal.
    """
    _swap_in(spark, path, by, aside)
    landed = f"{aside}-rows"
    rows.write.mode("overwrite").parquet(landed)
    new = spark.read.schema(rows.schema).parquet(landed)
    if _exists(spark, path):
        old = spark.read.schema(rows.schema).parquet(path).filter(_in(by, _values(new, by))).select(*rows.columns)
        same = [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in [by, *(c for c in key if c != by)]]
        new = new.unionByName(old.alias("old").join(new.alias("new"), same, "left_anti"))
    _overwrite(new, path, by, aside)
    _delete(spark, landed)


def update_partitions(spark: SparkSession, path: str, by: str, condition: Column, sets: Mapping[str, Column]) -> list:
    """`update_where` on a table at `path`, partitioned by `by`; gives the partitions that were rewritten. `by` itself cannot be set."""
    if by in sets:
        raise ValueError(f"rows cannot move between partitions of {by}")
    table = _table(spark, path, by)
    touched = _values(table.filter(F.coalesce(condition, F.lit(False))), by)
    if touched:
        _overwrite(update_where(table.filter(_in(by, touched)), condition, sets), path, by, _aside(path))
    return touched


def update_partitions_from(
    spark: SparkSession, path: str, by: str, source: DataFrame, key: str, sets: Mapping[str, Column], condition: Column | None = None
) -> list:
    """`update_from` on a table at `path`; of the partitions without a matching key only the keys are read."""
    if by in sets:
        raise ValueError(f"rows cannot move between partitions of {by}")
    table = _table(spark, path, by)
    touched = _values(table.join(source.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_semi"), by)
    if touched:
        _overwrite(update_from(table.filter(_in(by, touched)), source, key, sets, condition), path, by, _aside(path))
    return touched


def retention_drop(spark: SparkSession, path: str, by: str, as_of, days: int = 730) -> list:
    """`retention_delete` on a table at `path` that is partitioned by its date: old partitions are dropped, and no column is read."""
    listed = _table(spark, path, by).select(by).distinct()  # partition values only
    cutoff = F.date_sub(as_date(as_of), days)
    old = [r[0] for r in listed.filter(F.col(by) < cutoff).select(F.col(by).cast("string")).collect()]
    for value in old:
        _delete(spark, f"{path.rstrip('/')}/{by}={value}")
    return old


def merge_partitions(spark: SparkSession, path: str, by: str, batch: DataFrame, key: str, order: Sequence[str]) -> list:
    """`batch_merge` into a table at `path`: partitions are rewritten that hold a key of the batch, or get one.

    A key may move: its old row goes from the partition where it was. A partition that loses all of its rows is dropped.
    """
    table = _table(spark, path, by)
    # Rows without a key replace nothing; they are inserted as they come.
    arriving = dedup_latest(batch.filter(F.col(key).isNotNull()), [key], order).unionByName(batch.filter(F.col(key).isNull()))
    holding = _values(table.join(batch.select(key).distinct(), key, "left_semi"), by)
    touched = list(dict.fromkeys([*holding, *_values(batch, by)]))
    kept = table.filter(_in(by, touched)).join(batch.select(key).distinct(), key, "left_anti")
    kept.unionByName(arriving.select(*table.columns)).write.mode("overwrite").parquet(_aside(path))
    left = _values(spark.read.parquet(_aside(path)), by)
    _swap_in(spark, path, by, _aside(path))
    for value in (v for v in holding if v not in left):
        _delete(spark, f"{path.rstrip('/')}/{by}={NO_VALUE if value is None else value}")
    return touched
