"""A sync into a folder per day: no row lost, and only the days of arriving rows are read."""

import datetime as dt

import pytest

from martlet.sources import tables

KIND = "id string, at timestamp_ntz"


def rows(spark, *pairs):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t) if t else None) for i, t in pairs], KIND)


def test_no_row_is_lost_or_doubled(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.sync_write(rows(spark), path, "at", by_day=True).count() == 0
    first = rows(spark, ("a", "2024-03-01T10:00"), ("b", "2024-03-02T00:00"), (None, None))
    second = rows(spark, ("b", "2024-03-02T00:00"), ("c", "2024-03-02T00:00"), ("d", "2024-01-01T05:00"), ("e", None), (None, None))
    tables.sync_write(first, path, "at", by_day=True)
    for _ in range(2):
        got = tables.sync_write(second, path, "at", by_day=True)
        assert got.columns == ["id", "at"]
        assert sorted(map(str, got.collect())) == sorted(map(str, first.union(second).distinct().collect()))


def test_other_days_are_not_read(spark, tmp_path):
    path = tmp_path / "t"
    tables.sync_write(rows(spark, ("a", "2024-03-01T10:00"), ("b", "2024-03-02T00:00"), ("n", None)), str(path), "at", by_day=True)
    untouched = [p for d in ("2024-03-02", "__HIVE_DEFAULT_PARTITION__") for p in (path / f"cursor_day={d}").glob("*.parquet")]
    assert len(untouched) == 2
    held = {p: p.read_bytes() for p in untouched}
    for p in untouched:
        p.with_name(f".{p.name}.crc").unlink()
        p.write_bytes(b"no table")
    late = rows(spark, ("a", "2024-03-01T10:00"), ("late", "2024-03-01T09:00"))
    tables.sync_write(late, str(path), "at", by_day=True)
    with pytest.raises(Exception, match="no table|Parquet|FAILED_READ_FILE"):
        spark.read.schema(KIND).parquet(str(path)).collect()
    for p, content in held.items():
        p.write_bytes(content)
    got = sorted(str(r.id) for r in tables.stored_table(spark, str(path)).collect())
    assert got == ["a", "b", "late", "n"]
