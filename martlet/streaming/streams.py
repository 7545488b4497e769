"""The same jobs on arrival: Structured Streaming over landed files.

Sinks, checkpoints and state live in a folder all executors share. Every sink is
idempotent per micro-batch, so a batch that is run again after a loss leaves no trace.

Nothing depends on how files fall into micro-batches, nor on their order. Where Spark keeps state per event-time window
(`Windowed`), the state is bounded by a watermark, and rows that come later than that take a path of their own into the same
result. Elsewhere each batch logs what it has, already aggregated, and readers put the batches together (`BatchLog`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from martlet.functions import json_decimal, json_long
from martlet.operators import pii
from martlet.operators.dedup import dedup_latest
from martlet.operators.monitor import sync_status
from martlet.operators.changes import replace_partitions
from martlet.sources.tables import stored_table, write_table

Shape = Callable[[DataFrame], DataFrame]


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Files of one table as a stream; `max_files` bounds a micro-batch when a backlog is large.

    A table is a folder of files or a single file. A stream takes patterns only, so the last letter of the
    path is given as a pattern for itself: it names this path and no neighbour that starts alike.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that has arrived, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_stream(stream: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Append-only sink. Run again with the same folder it takes up only what is new."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/data")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _drain(writer, f"{folder}/checkpoint")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


@dataclass
class BatchLog:
    """A log of micro-batches, each in a `batch_id=<n>` folder of its own; a repeated batch replaces itself.

    shape: what a batch logs of its rows. merge: rows of any batches to one current row per key, in the
    same columns, so that merging merged rows again changes nothing.
    """

    spark: SparkSession
    folder: str
    shape: Shape
    merge: Shape

    def take(self, stream: DataFrame) -> DataFrame:
        """Log everything that has arrived and give the current rows."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.shape(batch).write.mode("overwrite").parquet(f"{self.folder}/data/batch_id={batch_id}")

        _drain(stream.writeStream.outputMode("append").foreachBatch(write), f"{self.folder}/checkpoint")
        found = self.read()
        return self.merge(self.shape(self.spark.createDataFrame([], stream.schema))) if found is None else found

    def read(self) -> DataFrame | None:
        """Current rows, or None before the first batch."""
        logged = stored_table(self.spark, f"{self.folder}/data")
        return None if logged is None else self.merge(logged.drop("batch_id"))


def folded(log: BatchLog, path: str) -> DataFrame:
    """The log's current rows as an ordinary table at `path`, for readers that want neither the log nor its merge."""
    return write_table(log.read(), path)


def totals(folder: str, spark: SparkSession, keys: Sequence[Column], names: Sequence[str], sums: dict[str, Column]) -> BatchLog:
    """Log of sums per key: each batch adds up its own rows, readers add up the batches."""
    return BatchLog(
        spark,
        folder,
        lambda df: df.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(*[F.sum(c).alias(n) for n, c in sums.items()]),
        lambda df: df.groupBy(*names).agg(*[F.sum(n).alias(n) for n in sums]),
    )


# ------------------------------------------------------------------- state per window
def _as_event_time(ts: str) -> Column:
    """A time without zone as an instant of UTC, for watermarks, which take instants only."""
    return F.concat(F.col(ts).cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


@dataclass
class Windowed:
    """Aggregates per event-time window and key, in Spark's state while rows may come on time, in a table of days for good.

    A row is late if its time is more than `look_back` seconds before the latest time of all earlier batches (a row without a time is
    always late). Rows on time are aggregated by a stateful query in update mode; its watermark is that bound, so it holds
    the windows of the look-back only, and no row that reaches it is dropped. Late rows are aggregated per batch.
    Either kind of result replaces its own row (window, keys, `part`) in the table, where a window's parts stand beside each
    other: one part from the state, one per batch of late rows. Only the days that results fall on are rewritten.

    unit: "hour" or "day", the length of a window. aggs: aggregates per window and key by name, whose parts `merge` puts together.
    """

    spark: SparkSession
    folder: str
    ts: str
    unit: str
    look_back: int
    keys: Sequence[str]
    aggs: dict[str, Column]
    merge: Shape

    def take(self, stream: DataFrame) -> DataFrame:
        """Take up everything that has arrived and give the current rows."""
        self._split(stream)
        kind = stream.schema
        start = F.date_trunc(self.unit, F.col(self.ts).cast("timestamp_ntz")).cast("timestamp_ntz").alias("start")
        rows = lambda late: self.spark.readStream.schema(kind).parquet(f"{self.folder}/rows/batch_id=*/late={late}")
        on_time = rows("false").withColumn("_event", _as_event_time(self.ts)).withWatermark("_event", f"{self.look_back + 1} seconds")
        aggs = [a.alias(n) for n, a in self.aggs.items()]
        state = on_time.groupBy(F.window("_event", f"1 {self.unit}").alias("_window"), start, *self.keys).agg(*aggs).drop("_window")
        seen = self.arrivals().agg(F.sum("on_time"), F.sum("late")).first()
        if seen[0]:
            put = lambda batch, n: self._put(batch, "state", f"state-{n}")
            _drain(state.writeStream.outputMode("update").foreachBatch(put), f"{self.folder}/state")
        if seen[1]:
            add = lambda batch, n: self._put(batch.groupBy(start, *self.keys).agg(*aggs), f"late-{n}", f"late-{n}")
            _drain(rows("true").writeStream.outputMode("append").foreachBatch(add), f"{self.folder}/late")
        found = self.read()
        if found is None:
            found = self.merge(self.spark.createDataFrame([], kind).groupBy(start, *self.keys).agg(*aggs))
        return found

    def read(self) -> DataFrame | None:
        table = stored_table(self.spark, f"{self.folder}/table")
        return None if table is None else self.merge(table.drop("part", "day"))

    def arrivals(self) -> DataFrame:
        """Per batch: rows on time, late rows, and the latest time so far."""
        kind = "on_time long, late long, newest timestamp_ntz, batch_id int"
        found = stored_table(self.spark, f"{self.folder}/ledger")
        return self.spark.createDataFrame([], kind) if found is None else found

    def _split(self, stream: DataFrame) -> None:
        """Land arriving rows, told into on time and late by the batches before. A batch that is run again comes out the same."""
        bound = f"{self.folder}/ledger"

        def write(batch: DataFrame, batch_id: int) -> None:
            ledger = stored_table(self.spark, bound)
            newest = None if ledger is None else ledger.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
            ts = F.col(self.ts).cast("timestamp_ntz")
            late = ts.isNull()
            if newest is not None:
                late = late | (ts < F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.look_back} SECONDS"))
            path = f"{self.folder}/rows/batch_id={batch_id}"
            batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(path)
            landed = self.spark.read.schema(batch.withColumn("late", late).schema).parquet(path)
            facts = landed.agg(
                F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"),
                F.greatest(F.max(F.col(self.ts).cast("timestamp_ntz")), F.lit(newest).cast("timestamp_ntz")).alias("newest"),
            )
            facts.coalesce(1).write.mode("overwrite").parquet(f"{bound}/batch_id={batch_id}")

        _drain(stream.writeStream.outputMode("append").foreachBatch(write), f"{self.folder}/arrival")

    def _put(self, rows: DataFrame, part: str, label: str) -> None:
        """Replace the rows' (start, keys, part) in the table, rewriting the days they fall on."""
        rows = rows.withColumns({"part": F.lit(part), "day": F.col("start").cast("date")})
        replace_partitions(self.spark, f"{self.folder}/table", "day", rows, ["start", *self.keys, "part"], f"{self.folder}/pending/{label}")


# ------------------------------------------------------------------------------ jobs
def hash_on_arrival(orders: DataFrame, clear: Sequence[str] = ("email", "contact_email")) -> DataFrame:
    """Hash and nullify as rows arrive; no clear text reaches the sink."""
    fresh = pii.ensure_column(orders, "email_hash")
    return pii.nullify_pii(pii.hash_missing(fresh, "email", "email_hash"), clear, "email_hash")


def upserts(
    spark: SparkSession, folder: str, keys: Sequence[str | Column], version: Sequence[str], ties: Sequence[str] = ()
) -> BatchLog:
    """Log of the latest row per key: each batch keeps its own latest, readers the latest over all batches.

    No key is held in state, so a version may come as late as it likes. `version` and `ties` should order
    the rows of a key fully; then the result is the same for any batches.
    """
    latest = lambda df: dedup_latest(df, keys, version, ties)
    return BatchLog(spark, folder, latest, latest)


def latest_wins(
    stream: DataFrame, folder: str, keys: Sequence[str | Column], version: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    return upserts(stream.sparkSession, folder, keys, version, ties).take(stream)


def first_wins(
    stream: DataFrame, folder: str, keys: Sequence[str], ts: str, ties: Sequence[str] = (), look_back_days: int = 28
) -> DataFrame:
    """The earliest row per key, by `ts` and then `ties`, over all that has arrived.

    State holds the earliest row per key and day for the look-back; a row that comes later than that is compared with the table's. Rows
    are told apart by their content, not by their arrival, so an earlier one takes the place of what is there whenever it comes. A read puts
    together a row per key and day, which are few where `ts` is part of the key.
    """
    order = [ts, *ties]
    row = F.struct(*order, *[c for c in stream.columns if c not in {*order, *keys}])  # NULLs come first, as in an ascending order
    named = [F.col(c) if c in keys else F.col(f"first.`{c}`").alias(c) for c in stream.columns]

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*keys).agg(F.min("first").alias("first")).select(*named)

    seconds = look_back_days * 86_400
    return Windowed(stream.sparkSession, folder, ts, "day", seconds, keys, {"first": F.min(row)}, merge).take(stream)


def hourly_ads(reports: DataFrame, folder: str, look_back_days: int = 28) -> DataFrame:
    """Spend, impressions and clicks per hour, open to reports of any age.

    An hour's sums are state for the look-back; what comes later is added to the hours it belongs to. The table is rewritten
    on the days that change.
    """
    names = {"spend": "$.spend", "impressions": "$.impressions", "clicks": "$.clicks"}
    sums = {n: F.sum((json_decimal if n == "spend" else json_long)("metrics", path)) for n, path in names.items()}

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(F.col("start").alias("hour")).agg(*[F.sum(n).alias(n) for n in names])

    return Windowed(reports.sparkSession, folder, "stat_time_day", "hour", look_back_days * 86_400, [], sums, merge).take(reports)


FUNNEL = ("page_view", "view_item", "add_to_cart", "purchase")


def event_funnel(events: DataFrame, folder: str) -> DataFrame:
    """Funnel steps per hour: events and users.

    The log has a row per hour, step and user, so users are counted exactly and in bounded memory, however
    their events fall into batches.
    """
    steps = events.filter(F.col("event_name").isin(*FUNNEL))
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    names = ["window_start", "event_name", "user_pseudo_id"]
    log = totals(folder, events.sparkSession, [hour, *map(F.col, names[1:])], names, {"event_count": F.lit(1)})
    return (
        log.take(steps)
        .groupBy("window_start", "event_name")
        .agg(F.sum("event_count").alias("event_count"), F.count("user_pseudo_id").alias("users"))
    )


# Registers of a user sketch as a power of two: estimates are 1.04 / sqrt(4096), so 1.6 %, off on average.
SKETCH_LG = 12


def event_funnel_sketch(events: DataFrame, folder: str, look_back_days: int = 3) -> DataFrame:
    """Funnel steps per hour: events, and users by a mergeable HyperLogLog sketch, from which wider spans can be counted too.

    Nothing that is kept for good names a user: state and table hold a sketch per hour and step, late rows one per batch. `users` is an estimate.
    """
    steps = events.filter(F.col("event_name").isin(*FUNNEL))
    aggs = {"event_count": F.count("*"), "sketch": F.hll_sketch_agg(F.col("user_pseudo_id").cast("string"), F.lit(SKETCH_LG))}

    def merge(parts: DataFrame) -> DataFrame:
        both = F.sum("event_count").alias("event_count"), F.hll_union_agg("sketch").alias("sketch")
        return parts.groupBy(F.col("start").alias("window_start"), "event_name").agg(*both)

    found = Windowed(events.sparkSession, folder, "ts", "hour", look_back_days * 86_400, ["event_name"], aggs, merge).take(steps)
    return found.withColumn("users", F.hll_sketch_estimate("sketch"))


def source_freshness(events: DataFrame, folder: str, source: str, ts: str, as_of) -> DataFrame:
    """Latest event time per source after each batch, in the bands of the sync status."""
    log = BatchLog(
        events.sparkSession,
        folder,
        lambda df: df.groupBy(F.col(source).alias("source")).agg(F.max(ts).alias("last_sync")),
        lambda df: df.groupBy("source").agg(F.max("last_sync").alias("last_sync")),
    )
    return sync_status(log.take(events), as_of)
