import datetime as dt
import os
import pathlib
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlet.operators import changes, dedup, monitor, quality
from martlet.session import shared_folder
from martlet.sources import files, tables
from martlet.streaming import streams

NOW = "2024-01-31 00:00:00"
T = dt.datetime(2024, 1, 31)


def ago(**kw):
    return T - dt.timedelta(**kw)


def alerts_of(spark, *rows):
    return spark.createDataFrame(rows, "table_name string, last_extracted_at timestamp_ntz, source string")


def test_watchdog_edges(spark):
    stats = alerts_of(
        spark, ("a", ago(hours=29), "s"), ("b", ago(hours=30), "s"), ("c", ago(hours=47), "s"), ("d", ago(hours=49), "s")
    )
    got = {r.table_name: (r.level, r.missed_value) for r in monitor.watchdog_alerts(stats, NOW, {"s": 100}).collect()}
    assert got == {"b": ("WARNING", 0), "c": ("WARNING", 0), "d": ("CRITICAL", 200)}


def test_repeat_alerts(spark):
    alerts = monitor.watchdog_alerts(alerts_of(spark, ("a", ago(hours=50), "s"), ("b", ago(hours=50), "s")), NOW, {})
    batch = lambda hours, *names: spark.createDataFrame(
        [(ago(hours=hours), n) for n in names], "alerted_at timestamp_ntz, table_name string"
    )
    sent = lambda history: monitor.suppress_repeat_alerts(alerts, history, NOW).count()
    assert sent(batch(1, "a", "b", "c")) == 0  # all named within four hours
    assert sent(batch(1, "a")) == 2  # one table is new: the whole batch goes out
    assert sent(batch(4, "a", "b")) == 2  # long enough ago
    assert sent(batch(1, "a", "b").limit(0)) == 2  # nothing sent before


@pytest.mark.parametrize("hours, band", [(1.9, "OK"), (2, "WARNING"), (23.9, "WARNING"), (24, "STALE"), (None, "NO DATA")])
def test_sync_bands(spark, hours, band):
    last = None if hours is None else ago(hours=hours)
    df = spark.createDataFrame([("s", last)], "source string, last_sync timestamp_ntz")
    assert monitor.sync_status(df, NOW).first().status == band


def test_empty_and_new_tables(spark):
    now = spark.createDataFrame([("a", 0, T, T), ("b", 0, T, T), ("c", 5, T, T), ("d", 0, T, T)], "table_name string, row_count long, created_at timestamp_ntz, last_extracted_at timestamp_ntz")
    base = spark.createDataFrame([("a", 0), ("b", 3), ("z", 1)], "table_name string, row_count long")
    assert {r.table_name: r.status for r in monitor.empty_tables(now, base).collect()} == {"a": "STILL EMPTY", "b": "NEWLY EMPTY", "d": "NEWLY EMPTY"}
    assert {r.table_name: r.status for r in monitor.new_tables(now, base).collect()} == {"c": "NEW TABLE", "d": "NEW & EMPTY"}
    assert [r.table_name for r in monitor.deleted_tables(now, base).collect()] == ["z"]


@pytest.mark.parametrize("n, status", [(10, "PASS"), (9, "WARNING"), (5, "WARNING"), (4, "FAIL")])
def test_schedule_frequency(spark, n, status):
    runs = spark.createDataFrame([(ago(minutes=11 + i), "ok") for i in range(n)], "created_at timestamp_ntz, status string")
    got = {r.check: (r.observed, r.status) for r in monitor.schedule_health(runs, NOW).collect()}
    assert got["frequency"] == (n, status) and got["recency"] == (11, "FAIL") and got["errors"] == (0, "PASS")


def test_json_backup(spark, tmp_path):
    path = tmp_path / "backup.jsonl"
    path.write_text(
        '{"id": 1, "customer": {"email": "a@b.c", "firstName": "A", "lastName": null}}\n'
        '{"id": 2, "customer": null}\n{"customer": {"email": "x"}}\nnot json\n{"id": 3, "cus\n'
    )
    lines = files.read_json_lines(spark, str(path))
    assert [tuple(r) for r in files.json_backup(lines).collect()] == [(1, "a@b.c", "A", None)]
    c = files.backup_counts(lines).first()
    assert (c.processed, c.errors, c.usable, c.skipped) == (5, 2, 1, 2)


def test_shards(spark, tmp_path):
    e = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 3))], "id int, d date")
    files.write_sharded(e, str(tmp_path / "s"), F.col("d"), "2024-01-03")
    every = files.read_sharded(spark, str(tmp_path / "s"), "events=")
    assert sorted((r.id, r.shard_date, r.is_intraday) for r in every.collect())[2] == (3, dt.date(2024, 1, 3), True)
    assert files.read_sharded(spark, str(tmp_path / "s"), "events=", intraday=False).count() == 2
    assert files.shard_freshness(every).first().latest_daily == dt.date(2024, 1, 2)


def test_sync_write_appends_only_new_rows(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "c")
    path = str(tmp_path / "t")
    tables.sync_write(df.filter("c < 4"), path, "c")
    assert tables.sync_write(df, path, "c").count() == 10
    assert tables.sync_write(df, path, "c").count() == 10
    assert tables.sync_write(df.limit(1), str(tmp_path / "o")).count() == 1


def test_run_sql_says_when_it_cut(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert [r.truncated for r in tables.run_sql(spark, "SELECT * FROM five", 5).collect()] == [False] * 5
    assert [r.truncated for r in tables.run_sql(spark, "SELECT * FROM five", 4).collect()] == [True] * 4


def test_results_export_orders_actions(spark, tmp_path):
    flat = spark.createDataFrame(
        [("a", "t", "WARNING", 1.0), ("b", "t", "PASS", 0.0), ("c", "t", "CRITICAL", 9.0), ("d", "t", "ERROR", 0.0)],
        "check_name string, table_name string, status string, v double",
    )
    results = quality.to_results(flat, "v", 1.0, 5.0)
    assert [r.check_name for r in tables.action_items(results).collect()] == ["c", "a", "d"]
    stale = tables.action_items(results.withColumn("check_name", F.lit("Data Freshness"))).first()
    assert stale.cause and stale.impact and stale.action
    tables.export_results(results, str(tmp_path))
    assert spark.read.json(str(tmp_path / "checks.json")).count() == 4
    assert spark.read.option("header", True).csv(str(tmp_path / "checks.csv")).count() == 4


def test_sync_write_loses_no_late_row(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "id string, c int"
    tables.sync_write(spark.createDataFrame([("a", 10), ("b", 20)], kind), path, "c")
    later = spark.createDataFrame([("b", 20), ("c", 20), ("d", 15), ("e", 30), ("f", None), (None, 5)], kind)
    for _ in range(2):
        got = tables.sync_write(later, path, "c").collect()
        assert sorted(map(str, got)) == sorted(map(str, later.collect() + [spark.createDataFrame([("a", 10)], kind).first()]))


def test_table_stats_list_files_without_rows(spark, tmp_path):
    full, empty = str(tmp_path / "full"), str(tmp_path / "empty")
    spark.range(10).repartition(3).write.parquet(full)
    spark.range(0).coalesce(1).write.parquet(empty)
    got = {r.table_name: r for r in tables.table_stats(spark, {"full": full, "empty": empty}).collect()}
    sizes = {n: [f.stat().st_size for f in (tmp_path / n).glob("*.parquet")] for n in ("full", "empty")}
    for name, rows in (("full", 10), ("empty", 0)):
        r = got[name]
        assert (r.row_count, r.files, r.size_mb) == (rows, len(sizes[name]), sum(sizes[name]) / (1 << 20))
        assert r.created_at <= r.last_modified_at
    assert got["empty"].files == 1
    assert [r.table_name for r in tables.table_stats(spark, {"full": full, "empty": empty}, "f%").collect()] == ["full"]


def test_baseline_is_the_last_scan(spark, tmp_path):
    kind = "table_name string, row_count long, created_at timestamp_ntz"
    scan = lambda n: spark.createDataFrame([("a", n, T)], kind)
    monitor.baseline_snapshot(scan(1), "2024-01-02 00:00:00", str(tmp_path / "b"))
    assert monitor.baseline_snapshot(scan(2), "2024-01-01 00:00:00", str(tmp_path / "b")).first().row_count == 1
    assert monitor.baseline_snapshot(scan(3), "2024-01-03 00:00:00", str(tmp_path / "b")).first().row_count == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# ------------------------------------------------------------------------------ streams
SCHEMA = "k long, v long, ts timestamp_ntz"


def land(spark, folder, name, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_stream_upsert_takes_late_versions(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, src, "a", (1, 1, T), (1, 2, T), (2, 1, T))
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{src}/*.parquet")
    run = lambda: sorted((r.k, r.v) for r in streams.latest_wins(stream(), out, ["k"], ["v"]).collect())
    assert run() == [(1, 2), (2, 1)]
    land(spark, src, "b", (2, 5, ago(days=20)), (1, 1, T), (3, 1, T))  # a late version, an old one, a new key
    assert run() == [(1, 2), (2, 5), (3, 1)]
    every = spark.read.parquet(f"{src}/*.parquet")
    assert run() == sorted((r.k, r.v) for r in dedup.dedup_latest(every, ["k"], ["v"]).collect())


def split_stream(spark, rows, kind, folder, order, max_files):
    """The same rows as one file or as several that arrive in a given order, a batch each."""
    for n, i in enumerate(order):
        part = rows[i :: len(order)]
        spark.createDataFrame(part, kind).coalesce(1).write.parquet(f"{folder}/{n}.parquet")
        for f in pathlib.Path(f"{folder}/{n}.parquet").glob("part-*"):  # the stream takes files by their time
            os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    reader = spark.readStream.schema(kind)
    return (reader.option("maxFilesPerTrigger", 1) if max_files else reader).parquet(f"{folder}/*.parquet")


ADS = "ad_id long, stat_time_day timestamp_ntz, metrics string, tie1 long"
CLICKS = "event_name string, ts timestamp_ntz, user_pseudo_id long"


@pytest.mark.parametrize("order", [(3, 2, 1, 0), (0, 1, 2, 3), (2, 0, 3, 1)])
def test_streams_do_not_depend_on_batches(spark, tmp_path, order):
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 200, minutes=i * 7 % 1440)
    ads = sorted((i % 9, day(i), '{"spend":"%d.5","impressions":"3","clicks":"1"}' % i, i) for i in range(200))
    clicks = [(streams.FUNNEL[i % 4] if i % 5 else "other", day(i // 6), i % 17 if i % 11 else None) for i in range(300)]
    jobs = {
        "first": (ads, ADS, lambda s, out: streams.first_wins(s, out, ["ad_id"], "stat_time_day", ["tie1"])),
        "latest": (ads, ADS, lambda s, out: streams.latest_wins(s, out, ["ad_id"], ["stat_time_day"], ["tie1"])),
        "hourly": (ads, ADS, streams.hourly_ads),
        "funnel": (clicks, CLICKS, streams.event_funnel),
        "freshness": (clicks, CLICKS, lambda s, out: streams.source_freshness(s, out, "event_name", "ts", NOW)),
        "append": (clicks, CLICKS, streams.append_stream),
    }
    for name, (rows, kind, job) in jobs.items():
        once = job(split_stream(spark, rows, kind, f"{tmp_path}/{name}-one", (0,), False), f"{tmp_path}/{name}-out1").collect()
        parts = job(split_stream(spark, rows, kind, f"{tmp_path}/{name}-four", order, True), f"{tmp_path}/{name}-out4").collect()
        assert Counter(map(str, once)) == Counter(map(str, parts)) and once, name


def test_stream_reads_its_own_path_only(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    spark.range(7).write.parquet(f"{tmp_path}/t.parquet_old")
    stream = streams.read_stream(spark, f"{tmp_path}/t.parquet", "id long")
    assert streams.append_stream(stream, f"{tmp_path}/out").count() == 5


def test_stream_log_as_a_table(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    log = streams.upserts(spark, out, ["k"], ["v"])
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{src}/*.parquet")
    rows = lambda df: sorted((r.k, r.v) for r in df.collect())
    land(spark, src, "a", (1, 1, T), (2, 1, T))
    assert log.read() is None
    assert rows(log.take(stream())) == [(1, 1), (2, 1)]
    land(spark, src, "b", (1, 2, T), (3, 1, T))
    assert rows(log.take(stream())) == [(1, 2), (2, 1), (3, 1)]
    assert rows(streams.folded(log, str(tmp_path / "table"))) == [(1, 2), (2, 1), (3, 1)]


def windowed(spark, out, look_back=86_400):
    sums = {"total": F.sum("v"), "n": F.count("*")}
    merge = lambda parts: parts.groupBy("start", "k").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return streams.Windowed(spark, out, "ts", "hour", look_back, ["k"], sums, merge)


def test_late_rows_are_counted_and_corrected(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{src}/*.parquet")
    job = windowed(spark, out)
    got = lambda: sorted(map(tuple, job.take(stream()).collect()), key=str)
    expected = lambda: sorted(
        map(tuple, spark.read.parquet(f"{src}/*.parquet").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz"), "k").agg(F.sum("v"), F.count("*")).collect()), key=str
    )
    at = lambda **ago_: T - dt.timedelta(**ago_)
    batches = [
        [(1, 5, T), (1, 6, at(hours=23)), (2, 7, at(days=9))],  # nothing is late in the first batch
        [(1, 1, at(hours=24)), (1, 2, at(hours=25)), (1, 9, at(days=9)), (2, 3, None)],  # the bound itself is on time
        [(1, 1, T + dt.timedelta(days=5)), (1, 1, T)],
        [(1, 4, at(hours=0)), (None, 8, T + dt.timedelta(days=5)), (1, None, at(days=400))],
        [],
    ]
    for n, rows in enumerate(batches):
        land(spark, src, f"b{n}", *rows)
        assert got() == expected()
    assert got() == expected()  # nothing new
    counts = {r.batch_id: (r.on_time, r.late) for r in job.arrivals().collect()}
    assert [counts[i] for i in range(4)] == [(3, 0), (1, 3), (2, 0), (1, 2)]


def test_only_touched_days_are_rewritten(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{src}/*.parquet")
    land(spark, src, "a", *[(1, 1, T - dt.timedelta(days=i)) for i in range(6)])
    job = windowed(spark, out, 3 * 86_400)
    job.take(stream()).count()
    files = lambda: {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in pathlib.Path(f"{out}/table").glob("day=*")}
    before = files()
    land(spark, src, "b", (1, 5, T), (1, 5, T - dt.timedelta(days=5)))
    job.take(stream()).count()
    changed = {d for d, names in files().items() if before[d] != names}
    assert changed == {f"day={(T - dt.timedelta(days=i)).date()}" for i in (0, 5)}


def test_a_batch_that_is_run_again_leaves_no_trace(spark, tmp_path):
    """The last batches of the state and of the late rows were written, but not committed."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(f"{src}/*.parquet")
    job = windowed(spark, out)
    land(spark, src, "a", (1, 5, T), (1, 6, T))
    job.take(stream()).collect()
    land(spark, src, "b", (1, 7, T), (1, 8, T - dt.timedelta(days=3)), (2, 8, T))
    first = sorted(map(tuple, job.take(stream()).collect()), key=str)
    for query in ("state", "late"):
        commits = pathlib.Path(f"{out}/{query}/commits")
        last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        for gone in (last, commits / f".{last.name}.crc"):
            gone.unlink(missing_ok=True)
    assert sorted(map(tuple, job.take(stream()).collect()), key=str) == first


def test_funnel_sketch_is_near_the_exact_count(spark, tmp_path):
    rows = [("purchase", dt.datetime(2024, 1, 1 + i % 9, i % 3), i % 5003) for i in range(30_000)]
    stream = split_stream(spark, rows, CLICKS, f"{tmp_path}/in", (2, 0, 1), True)
    found = streams.event_funnel_sketch(stream, f"{tmp_path}/out").collect()
    exact = {}
    for _, ts, user in rows:
        exact.setdefault(ts, []).append(user)
    assert {r.window_start: r.event_count for r in found} == {ts: len(u) for ts, u in exact.items()}
    for r in found:
        assert abs(r.users - len(set(exact[r.window_start]))) <= 4 * 0.0163 * len(set(exact[r.window_start]))
    whole = spark.createDataFrame(found).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()[0]
    assert abs(whole - 5003) <= 4 * 0.0163 * 5003
    kept = spark.read.parquet(f"{tmp_path}/out/table")
    assert "user_pseudo_id" not in kept.columns


# ------------------------------------------------------------------- touched partitions
def days_table(spark, path, n=6):
    rows = [(f"2024-01-0{1 + i % n}", i, "old", i * 10) for i in range(3 * n)] + [(None, 100, "old", 0)]
    spark.createDataFrame(rows, "day string, k long, v string, w long").withColumn("day", F.col("day").cast("date")).repartition("day").write.partitionBy("day").parquet(path)
    files = lambda: {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in pathlib.Path(path).glob("day=*")}
    content = lambda: sorted(((str(r.day), r.k, r.v, r.w) for r in spark.read.parquet(path).collect()), key=str)
    return files, content


def test_updates_rewrite_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    files, content = days_table(spark, path)
    before, was = files(), content()
    assert [str(d) for d in changes.update_partitions(spark, path, "day", F.col("k") == 4, {"v": F.lit("new")})] == ["2024-01-05"]
    assert content() == sorted(((d, k, "new" if k == 4 else v, w) for d, k, v, w in was), key=str)
    assert {d for d, f in files().items() if f != before[d]} == {"day=2024-01-05"}
    before, was = files(), content()
    source = spark.createDataFrame([(1, "s1"), (100, "s2"), (999, "s3"), (None, "s4")], "k long, n string")
    changes.update_partitions_from(spark, path, "day", source, "k", {"v": F.col("src_n")})
    assert content() == sorted(((d, k, {1: "s1", 100: "s2"}.get(k, v), w) for d, k, v, w in was), key=str)
    assert {d for d, f in files().items() if f != before[d]} == {"day=2024-01-02", "day=__HIVE_DEFAULT_PARTITION__"}
    before = files()
    assert changes.update_partitions(spark, path, "day", F.col("k") == -1, {"v": F.lit("no")}) == [] and files() == before
    with pytest.raises(ValueError, match="cannot move"):
        changes.update_partitions(spark, path, "day", F.lit(True), {"day": F.lit(None)})


def test_retention_drops_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files, content = days_table(spark, path)
    before, was = files(), content()
    assert sorted(changes.retention_drop(spark, path, "day", "2024-01-10", 7)) == ["2024-01-01", "2024-01-02"]
    assert content() == [r for r in was if r[0] == "None" or r[0] >= "2024-01-03"]
    assert files() == {d: f for d, f in before.items() if d not in ("day=2024-01-01", "day=2024-01-02")}


def test_merge_rewrites_partitions_that_hold_or_get_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    files, content = days_table(spark, path)
    before, was = files(), content()
    kind = "k long, v string, w long, day string"
    batch = spark.createDataFrame([(2, "late", 1, "2024-01-03"), (2, "last", 2, "2024-01-03"), (50, "new", 1, "2024-02-01"), (7, "moved", 1, "2024-01-05"), (100, "dated", 5, "2024-01-05"), (None, "keyless", 5, "2024-02-01")], kind).withColumn("day", F.col("day").cast("date"))
    changes.merge_partitions(spark, path, "day", batch, "k", ["w"])
    want = [r for r in was if r[1] not in (2, 7, 100)]
    want += [("2024-01-03", 2, "last", 2), ("2024-02-01", 50, "new", 1), ("2024-01-05", 7, "moved", 1), ("2024-01-05", 100, "dated", 5), ("2024-02-01", None, "keyless", 5)]
    assert content() == sorted(want, key=str)
    untouched = {"day=2024-01-01", "day=2024-01-04", "day=2024-01-06"}
    assert {d for d in before if files().get(d) == before[d]} >= untouched
    assert not [d for d in untouched if files()[d] != before[d]]


def test_a_change_lost_between_its_writes_is_brought_to_its_end(spark, tmp_path):
    path = str(tmp_path / "t")
    files, content = days_table(spark, path)
    was = content()
    # What a lost run leaves: whole partitions aside, and the table's own half gone.
    ready = spark.read.parquet(path).filter("day = DATE '2024-01-02'").withColumn("v", F.lit("aside"))
    ready.write.parquet(f"{path}-aside")
    shutil.rmtree(f"{path}/day=2024-01-02")
    changes.update_partitions(spark, path, "day", F.col("k") == 4, {"v": F.lit("new")})
    want = [(d, k, "aside" if d == "2024-01-02" else "new" if k == 4 else v, w) for d, k, v, w in was]
    assert content() == sorted(want, key=str)


# --------------------------------------------------------------------- published tables
def test_published_table_is_switched_whole(spark):
    name = f"published_{os.getpid()}"
    ids = lambda: sorted(r.id for r in spark.table(name).collect())
    tables.publish_table(spark.range(3), name)
    held = spark.table(name)  # a reader that has begun
    tables.publish_table(spark.table(name).unionByName(spark.range(10, 12)), name)  # reads what it replaces
    assert ids() == [0, 1, 2, 10, 11] and held.count() == 3
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.publish_table(broken, name)
    with pytest.raises(ValueError, match="check"):
        tables.publish_table(spark.range(0), name, check=lambda new: new.count() > 0)
    assert ids() == [0, 1, 2, 10, 11] and len(tables.versions(spark, name)) == 2
    tables.publish_table(spark.range(1), name, keep=0)
    assert ids() == [0] and len(tables.versions(spark, name)) == 1
    assert tables.publish_table(spark.range(2).withColumn("p", F.col("id") % 2), name, partition_by=["p"]).count() == 2
