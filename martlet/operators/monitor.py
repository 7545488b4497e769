"""Watch tables and syncs: what appeared, vanished, emptied or stopped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import as_timestamp, hours_between
from martlet.sources.tables import sync_write


# --------------------------------------------------------------------- table catalogue
def baseline_snapshot(stats: DataFrame, scanned_at, path: str) -> DataFrame:
    """Store a scan as the baseline later ones are compared with, and give it as stored.

    Scans are kept side by side; a scan that is stored again adds nothing new.
    """
    scan = stats.select("table_name", "row_count", "created_at", as_timestamp(scanned_at).alias("scanned_at"))
    return latest_baseline(sync_write(scan, path, "scanned_at"))


def latest_baseline(scans: DataFrame) -> DataFrame:
    """The tables of the last stored scan."""
    last = scans.agg(F.max("scanned_at").alias("scanned_at"))
    return scans.join(last, "scanned_at", "left_semi").select(*scans.columns)


def new_tables(now: DataFrame, baseline: DataFrame) -> DataFrame:
    return now.join(baseline.select("table_name"), "table_name", "left_anti").select(
        "table_name",
        "row_count",
        "created_at",
        F.when(F.col("row_count") == 0, "NEW & EMPTY").otherwise("NEW TABLE").alias("status"),
    )


def deleted_tables(now: DataFrame, baseline: DataFrame) -> DataFrame:
    return baseline.join(now.select("table_name"), "table_name", "left_anti").select(
        "table_name", F.col("row_count").alias("rows_before"), F.lit("DELETED").alias("status")
    )


def empty_tables(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """Tables without rows; one the baseline does not know counts as newly empty."""
    before = baseline.select("table_name", F.col("row_count").alias("rows_before"))
    return (
        now.filter(F.col("row_count") == 0)
        .join(before, "table_name", "left")
        .select(
            "table_name",
            "last_extracted_at",
            F.coalesce("rows_before", F.lit(0).cast("bigint")).alias("rows_before"),
            F.when(F.col("rows_before") == 0, "STILL EMPTY").otherwise("NEWLY EMPTY").alias("status"),
        )
    )


def _exact_hours(start: Column, as_of) -> Column:
    return F.timestamp_diff("SECOND", start, as_timestamp(as_of)) / 3600


def stale_tables(stats: DataFrame, as_of, hours: int = 48) -> DataFrame:
    ago = _exact_hours(F.col("last_extracted_at"), as_of)
    return stats.filter(ago > hours).select(
        "table_name", "last_extracted_at", ago.alias("hours_ago"), F.lit("STALE").alias("status")
    )


def missing_expected(now: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.join(now.select("table_name"), "table_name", "left_anti")


# --------------------------------------------------------------------------- freshness
def last_sync(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest load time per source: (source, last_sync)."""
    out = None
    for name, (df, ts) in sources.items():
        one = df.agg(F.lit(name).alias("source"), F.max(F.col(ts).cast("timestamp_ntz")).alias("last_sync"))
        out = one if out is None else out.unionByName(one)
    return out


def sync_band(hours: Column) -> Column:
    return F.when(hours.isNull(), "NO DATA").when(hours < 2, "OK").when(hours < 24, "WARNING").otherwise("STALE")


def sync_status(last: DataFrame, as_of) -> DataFrame:
    hours = _exact_hours(F.col("last_sync"), as_of)
    return last.select("source", "last_sync", hours.alias("hours_ago"), sync_band(hours).alias("status"))


def load_freshness(last: DataFrame, as_of, warn_hours: int = 48) -> DataFrame:
    hours = hours_between(F.col("last_sync"), as_timestamp(as_of))
    return last.select(
        "source",
        "last_sync",
        hours.alias("hours_since"),
        F.when(hours > warn_hours, "WARNING").otherwise("OK").alias("status"),
    )


def watchdog_alerts(stats: DataFrame, as_of, daily_value: Mapping[str, float], warn: int = 30, crit: int = 48):
    """Tables behind schedule. `stats` holds (table_name, last_extracted_at, source); the value
    missed is whole days times the daily value of the source."""
    value = F.lit(0)
    for source, v in daily_value.items():
        value = F.when(F.col("source") == source, int(v)).otherwise(value)
    hours = hours_between(F.col("last_extracted_at"), as_timestamp(as_of))
    days = F.floor(hours / 24)
    critical = hours >= crit
    return stats.filter(hours >= warn).select(
        "table_name",
        hours.alias("hours_behind"),
        days.alias("days_behind"),
        F.when(critical, days * value).otherwise(F.lit(0)).cast("bigint").alias("missed_value"),
        F.when(critical, "CRITICAL").otherwise("WARNING").alias("level"),
    )


def suppress_repeat_alerts(alerts: DataFrame, history: DataFrame, as_of, hours: int = 4) -> DataFrame:
    """The alerts, or nothing if the last batch, sent less than `hours` ago, named all their tables.

    `history` holds (alerted_at, table_name) per batch.
    """
    last = history.agg(F.max("alerted_at")).scalar()
    recent = history.filter(
        (F.col("alerted_at") == last) & (_exact_hours(F.col("alerted_at"), as_of) < hours)
    ).select("table_name")
    unseen = alerts.select("table_name").join(recent, "table_name", "left_anti")
    fresh = unseen.agg(F.count("*")).scalar()
    return alerts.filter(fresh > 0)


# ------------------------------------------------------------------------ sync history
def job_history(jobs: DataFrame, attempts: DataFrame, n: int | None = None) -> DataFrame:
    """Each job with its last attempt, how long that took, and what it moved; newest `n` jobs."""
    last = attempts.groupBy("job_id").agg(
        F.count("*").alias("attempts"),
        F.max_by(F.struct("status", "created_at", "ended_at", "records"), "attempt_no").alias("a"),
    )
    out = jobs.join(last, "job_id", "left").select(
        "job_id",
        "connection",
        F.col("created_at"),
        F.coalesce("attempts", F.lit(0).cast("bigint")).alias("attempts"),
        F.col("a.status").alias("last_status"),
        F.timestamp_diff("SECOND", F.col("a.created_at"), F.col("a.ended_at")).alias("duration_seconds"),
        F.col("a.records").alias("records_synced"),
    )
    return out if n is None else out.orderBy(F.col("created_at").desc(), F.col("job_id").desc()).limit(n)


STREAM_STATS = (
    "streamStats array<struct<streamName:string,stats:struct<recordsEmitted:bigint,recordsCommitted:bigint>>>"
)


def stream_stats(attempts: DataFrame) -> DataFrame:
    """One row per attempt and stream, out of the attempt's JSON output."""
    parsed = attempts.select("job_id", "attempt_no", F.from_json("output", STREAM_STATS).alias("o"))
    return parsed.select("job_id", "attempt_no", F.explode("o.streamStats").alias("s")).select(
        "job_id",
        "attempt_no",
        F.col("s.streamName").alias("stream_name"),
        F.col("s.stats.recordsEmitted").alias("emitted"),
        F.col("s.stats.recordsCommitted").alias("committed"),
    )


def schedule_health(runs: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Runs in the last hour: how many, how many failed, how long since the last; three findings."""
    now = as_timestamp(as_of)
    recent = runs.filter(
        (F.col("created_at") > F.timestamp_add("MINUTE", F.lit(-minutes), now)) & (F.col("created_at") <= now)
    ).agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "failed").alias("errors"),
        F.timestamp_diff("MINUTE", F.max("created_at"), now).alias("minutes_since_last"),
    )
    runs_, errors, idle = F.col("total_runs"), F.col("errors"), F.col("minutes_since_last")
    findings = F.array(
        F.struct(
            F.lit("frequency").alias("check"),
            runs_.alias("observed"),
            F.when(runs_ >= 10, "PASS").when(runs_ >= 5, "WARNING").otherwise("FAIL").alias("status"),
        ),
        F.struct(
            F.lit("errors").alias("check"),
            errors.alias("observed"),
            F.when(errors == 0, "PASS").otherwise("FAIL").alias("status"),
        ),
        F.struct(
            F.lit("recency").alias("check"),
            idle.alias("observed"),
            F.when(F.coalesce(idle <= 10, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        ),
    )
    return recent.select(F.explode(findings).alias("f")).select("f.*")

