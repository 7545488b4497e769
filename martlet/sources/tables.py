"""Tables in and out: scans, views, typed staging, catalogue facts, exports."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, NumericType, StructField, StructType


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table and return it as read back. `path` must not feed `df`."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_table(
    df: DataFrame, name: str, check: Callable[[DataFrame], bool] | None = None, partition_by: Sequence[str] = (), keep: int = 1
) -> DataFrame:
    """Create or replace the catalogue table `name`; readers see the old rows or the new ones, never a half of either.

    The rows are written as a table of their own, `check` (if any) looks at it, and only then the name is switched, which is one change of the
    catalogue. If the write or the check fails, the name still gives the old rows, and what was written aside is dropped. `df` may read
    from `name`. Of the versions before, `keep` stay, so readers that have begun can end.
    """
    spark = df.sparkSession
    version = f"{name}__{time.time_ns():020d}"
    try:
        df.write.partitionBy(*partition_by).saveAsTable(version)
        if check is not None and not check(spark.table(version)):
            raise ValueError(f"{name}: the new rows do not pass their check; the old ones stay")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for old in versions(spark, name)[: -keep - 1]:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Create or replace the catalogue table `name` in `buckets` buckets of `key`, sorted by it, a file per bucket.

    Tables with equal buckets join and group on `key` without a shuffle. Rows with equal keys lie in one bucket, so a
    key that many rows share (NULL too) must be spread or added up before.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables behind a published name, oldest first."""
    *schema, table = name.split(".")
    where = f" IN {schema[0]}" if schema else ""
    found = (r.tableName for r in spark.sql(f"SHOW TABLES{where} LIKE '{table}__*'").collect())
    return sorted(".".join([*schema, t]) for t in found if t.removeprefix(f"{table.lower()}__").isdigit())


def register_view(df: DataFrame, name: str, alias: Mapping[str, str] | None = None) -> DataFrame:
    """Create or replace a view; `alias` maps published column names to those of `df`."""
    if alias:
        df = df.select(*[F.col(src).alias(dst) for dst, src in alias.items()])
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def stage_with_schema(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Typed staging: exactly these columns, strictly cast; a bad value fails the load."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in schema.items()])


def sync_write(df: DataFrame, path: str, cursor: str | None = None, by_day: bool = False) -> DataFrame:
    """Write as a sync does: with a cursor whatever is not stored yet is appended, without one the table is replaced.

    A row is stored if an equal one is. Late and revised rows, and rows at the stored maximum, are
    appended like any other, so nothing is lost; `dedup_latest` takes the latest version on reading. Of the stored
    rows only those from the lowest arriving cursor on are read for the comparison; with `by_day` the store has a
    folder per day of the cursor, and only those of arriving days are read, so one very late row costs its own day.
    """
    spark = df.sparkSession
    if cursor is None:
        return write_table(df, path)
    if by_day:
        return _sync_days(df, path, cursor)
    stored = stored_table(spark, path)
    if stored is not None:
        lowest = df.agg(F.min(cursor)).first()[0]
        within = F.col(cursor).isNull()
        if lowest is not None:
            within = within | (F.col(cursor) >= F.lit(lowest).cast(df.schema[cursor].dataType))
        same = [F.col(f"new.`{c}`").eqNullSafe(F.col(f"old.`{c}`")) for c in df.columns]
        df = df.alias("new").join(stored.filter(within).alias("old"), same, "left_anti")
    df.write.mode("append").parquet(path)
    return spark.read.parquet(path)


CURSOR_DAY = "cursor_day"


def _sync_days(df: DataFrame, path: str, cursor: str) -> DataFrame:
    """`sync_write` into a folder per day; rows without a cursor have a folder of their own.

    Equal rows have equal days, so those of other days need no look. The driver learns which days arrive, at most
    one value per day of the calendar, and Spark leaves all other folders unread.
    """
    spark = df.sparkSession
    kind = StructType([*df.schema.fields, StructField(CURSOR_DAY, DateType())])
    dated = df.withColumn(CURSOR_DAY, F.col(cursor).cast("date"))
    old = stored_table(spark, path, kind)
    if old is not None:
        days = [r[0] for r in dated.select(CURSOR_DAY).distinct().collect()]
        touched = F.col(CURSOR_DAY).isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col(CURSOR_DAY).isNull()
        same = [F.col(f"new.`{c}`").eqNullSafe(F.col(f"old.`{c}`")) for c in dated.columns]
        dated = dated.alias("new").join(old.filter(touched).alias("old"), same, "left_anti")
    # A file or a few per day: Spark splits a large day and puts small ones together.
    dated.hint("rebalance", CURSOR_DAY).write.mode("append").partitionBy(CURSOR_DAY).parquet(path)
    return spark.read.schema(kind).parquet(path).drop(CURSOR_DAY)


def stored_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at `path`, or None if there is none yet."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# -------------------------------------------------------------------------- catalogue
def table_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Every file of the tables at `paths`, also those without rows, with size and time; contents are not read."""
    out = None
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        one = files.select(F.lit(name).alias("table_name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("t"))
        out = one if out is None else out.unionByName(one)
    return out


def table_stats(spark: SparkSession, paths: Mapping[str, str], name_like: str | None = None) -> DataFrame:
    """Per table: rows, files, megabytes, first and last file time. A table or file without rows is listed too."""
    counts = None
    for name, path in paths.items():
        one = spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        counts = one if counts is None else counts.unionByName(one)
    files = table_files(spark, paths).groupBy("table_name").agg(
        F.count("*").alias("files"),
        (F.sum("size") / (1024 * 1024)).alias("size_mb"),
        F.min("t").alias("created_at"),
        F.max("t").alias("last_modified_at"),
    )
    out = counts.join(files, "table_name", "left")
    return out if name_like is None else out.filter(F.col("table_name").like(name_like))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark` in which counts come from Parquet footers: its readers are those that take aggregates.

    The settings belong to the new session, so plans of the caller's session stay as they are. Its DataFrames cannot be joined with the caller's.
    """
    beside = spark.newSession()
    v1 = (name.strip() for name in beside.conf.get("spark.sql.sources.useV1SourceList").split(","))
    beside.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in v1 if name != "parquet"))
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    beside.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return beside


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows per table, from file footers alone: no column and no page of rows is read. A table without rows or files counts zero.

    The result belongs to `footer_session`.
    """
    beside = footer_session(spark)
    # A file without rows has no count in its footer, and Spark then gives NULL for the whole count: each table has a zero to start with.
    kind = "table_name string, row_count long"
    out = beside.createDataFrame([(name, 0) for name in paths], kind)
    for name, path in paths.items():
        one = beside.read.parquet(path).agg(F.count("*").alias("row_count"))
        out = out.unionByName(one.select(F.lit(name).alias("table_name"), "row_count"))
    return out.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def footer_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of `columns` of a table, from footers alone: one row per column, values as text, NULL if there is none.

    For numbers, dates and booleans, whose footers hold exact bounds; of other types Spark takes no bounds from a footer, and this refuses them.
    """
    beside = footer_session(spark)
    df = beside.read.parquet(path)
    exact = (NumericType, DateType, BooleanType)
    for c in columns:
        if not isinstance(df.schema[c].dataType, exact) or isinstance(df.schema[c].dataType, DecimalType):
            raise ValueError(f"{c}: footers hold no exact bounds of {df.schema[c].dataType.simpleString()}")
    bounds = [f(c).alias(f"{kind}_{i}") for i, c in enumerate(columns) for kind, f in (("min", F.min), ("max", F.max))]
    one = df.agg(*bounds)
    text = lambda kind, i: F.col(f"{kind}_{i}").cast("string")
    rows = [
        F.struct(F.lit(c).alias("column_name"), text("min", i).alias("min_value"), text("max", i).alias("max_value"))
        for i, c in enumerate(columns)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def describe_schema(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    kind = "table_name string, position int, column_name string, data_type string, nullable boolean"
    return spark.createDataFrame(rows, kind)


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with their type and the rows that hold a value, one pass per table."""
    out = None
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        kinds = F.create_map(*[F.lit(x) for c, k in df.dtypes for x in (c, k)])
        one = counts.unpivot([], df.columns, "column_name", "non_null_count").select(
            F.lit(name).alias("table_name"), "column_name", kinds[F.col("column_name")].alias("data_type"), "non_null_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


def columns_present(tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Which of the expected columns each table has, and how many rows hold a value in them."""
    spark = next(iter(tables.values())).sparkSession
    wanted = [(t, c) for t, cols in expected.items() for c in cols]
    found = column_profile({t: df.select(*[c for c in expected[t] if c in df.columns]) for t, df in tables.items()})
    return (
        spark.createDataFrame(wanted, "table_name string, column_name string")
        .join(found, ["table_name", "column_name"], "left")
        .select("table_name", "column_name", F.col("data_type").isNotNull().alias("present"), "non_null_count")
    )


def preview(df: DataFrame, n: int = 100, order: Sequence[Column | str] = ()) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def run_sql(spark: SparkSession, text: str, max_rows: int = 1000) -> DataFrame:
    """Ad-hoc SQL with a row cap; the column `truncated` says on each row whether the cap cut anything off.

    The statement runs once: one row beyond the cap is fetched, and only those rows are counted.
    """
    some = spark.sql(text).limit(max_rows + 1)
    whole = Window.partitionBy()
    numbered = some.withColumns({"_n": F.count("*").over(whole), "_k": F.row_number().over(whole.orderBy(F.lit(0)))})
    return numbered.filter(F.col("_k") <= max_rows).withColumn("truncated", F.col("_n") > max_rows).drop("_n", "_k")


# ---------------------------------------------------------------------------- exports
def export_csv(df: DataFrame, path: str, max_rows: int | None = None) -> None:
    out = df if max_rows is None else df.limit(max_rows)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def action_items(results: DataFrame) -> DataFrame:
    """Findings that need someone, worst first, with cause, impact and action."""
    from martlet.operators.checks import severity, with_advice

    rank = severity(F.col("status"))
    return with_advice(results.filter(rank <= 3)).orderBy(rank, "check_name", "table_name")


def export_results(results: DataFrame, path: str) -> DataFrame:
    """Check results as JSON and CSV, and the action items on their own; returns the results as written.

    The checks run once, for the JSON; the other files are made from it.
    """
    results.write.mode("overwrite").json(f"{path}/checks.json")
    written = results.sparkSession.read.schema(results.schema).json(f"{path}/checks.json")
    export_csv(written.withColumn("details", F.to_json("details")), f"{path}/checks.csv")
    action_items(written).write.mode("overwrite").json(f"{path}/action_items.json")
    return written
