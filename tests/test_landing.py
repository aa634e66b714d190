"""Manifest: what readers see while jobs write, close, expire, crash and run side by side."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from passbook import fixtures as fx
from passbook.operators import envelope as ev
from passbook.sources import landing, pointer
from passbook.workspace import fresh_path

SF = "/root/testdata/sf0.001"
T = "accounts"


@pytest.fixture(scope="module")
def log(spark):
    path = fresh_path(spark, "log")
    ev.with_partitions(fx.account_log(spark, SF).filter("_kafka_offset < 300")).write.parquet(path)
    return spark.read.parquet(path)


def content(rows):
    columns = sorted(rows.columns)
    return sorted(map(repr, rows.select(*columns).collect()))


def data_folders(base):
    return {p for p, _, files in os.walk(base) if "/manifest" not in p and any(f.endswith(".parquet") for f in files)}


def test_pointer_versions(spark):
    folder = fresh_path(spark, "pointer")
    assert pointer.latest(spark, folder) == (0, {})
    assert pointer.publish(spark, folder, 0, {"a": 1}) == 1
    with pytest.raises(pointer.ConflictError):
        pointer.publish(spark, folder, 0, {"a": 2})
    assert pointer.latest(spark, folder) == (1, {"a": 1})
    assert pointer.update(spark, folder, lambda d: None) == {"a": 1} and pointer.latest(spark, folder)[0] == 1
    assert not [n for n in os.listdir(folder) if n.startswith("_")]


def test_two_writers_lose_nothing(spark):
    folder = fresh_path(spark, "pointer")

    def add(name):
        for k in range(5):
            pointer.update(spark, folder, lambda d: d | {f"{name}{k}": k})

    threads = [threading.Thread(target=add, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(pointer.latest(spark, folder)[1]) == 10


def test_unpublished_files_are_not_read(spark, log):
    base = fresh_path(spark, "z")
    log.write.parquet(f"{base}/{T}/open/batch=s-0")  # a job that died before publishing
    assert landing.scan(spark, base, T).count() == 0
    assert landing.write_rows(log, base, T, "s-0")  # and its repetition
    assert content(landing.scan(spark, base, T)) == content(log)
    assert not landing.write_rows(log, base, T, "s-0")
    assert landing.scan(spark, base, T).count() == log.count()


def test_folders_follow_hours_and_not_batches(spark, log):
    base = fresh_path(spark, "z")
    for k in range(6):
        landing.write_rows(log.filter(F.col("_kafka_offset") % 6 == k), base, T, f"s-{k}")
        if k == 2:
            landing.close_hours(spark, base, T)
    seen = landing.head(spark, base, T)
    hours = log.select("year", "month", "day", "hour").distinct().count()
    assert 0 < landing.close_hours(spark, base, T) <= hours and landing.close_hours(spark, base, T) == 0
    assert content(landing.scan(spark, base, T)) == content(log)
    assert content(landing.scan(spark, base, T, version=seen)) == content(log)  # readers of the version before go on
    assert not landing.write_rows(log, base, T, "s-3")  # closed batches are remembered
    assert landing.vacuum(spark, base, T) == 0  # within the time of grace
    assert landing.vacuum(spark, base, T, grace_ms=-1000) > 6
    assert len(data_folders(base)) == hours and landing.vacuum(spark, base, T, grace_ms=-1000) == 0
    assert content(landing.scan(spark, base, T)) == content(log)
    listed = landing.live_hours(spark, base, T)
    assert listed.count() == hours and listed.agg(F.sum("rows")).first()[0] == log.count()


def test_late_rows_touch_their_hours_only(spark, log):
    base = fresh_path(spark, "z")
    late = (F.col("hour") < "03") & (F.col("_kafka_offset") % 4 == 0)
    landing.write_rows(log.filter(~late), base, T)
    landing.close_hours(spark, base, T)
    before = {r.folder for r in landing.live_hours(spark, base, T).collect()}
    version = landing.head(spark, base, T)
    landing.write_rows(log.filter(late), base, T)
    touched = log.filter(late).select("day", "hour").distinct().count()
    assert landing.close_hours(spark, base, T) == touched
    after = {r.folder for r in landing.live_hours(spark, base, T).collect()}
    assert len(before - after) <= touched and len(after - before) == touched
    fresh = landing.scan_since(spark, base, T, version)
    assert set(content(log.filter(late))) <= set(content(fresh)) and fresh.count() < log.count()


def test_days_prune_folders(spark, log):
    base = fresh_path(spark, "z")
    landing.write_rows(log, base, T)
    days = sorted(r.day for r in log.select("day").distinct().collect())
    for closed in (False, True):
        if closed:
            landing.close_hours(spark, base, T)
        rows = landing.scan(spark, base, T, since=f"2024-01-{days[1]}", until=f"2024-01-{days[1]}")
        assert {r.day for r in rows.collect()} == {days[1]}
        assert rows.count() == log.filter(F.col("day") == days[1]).count()
    assert all(f"day={days[1]}" in f for f in rows.inputFiles())


def test_batches_published_while_hours_close_stay(spark, log, monkeypatch):
    base = fresh_path(spark, "z")
    even = F.col("_kafka_offset") % 2 == 0
    landing.write_rows(log.filter(even), base, T)
    write = landing._write_listing

    def interrupted(rows, *where):
        landing.write_rows(log.filter(~even), base, T, "s-1")
        return write(rows, *where)

    monkeypatch.setattr(landing, "_write_listing", interrupted)
    landing.close_hours(spark, base, T)
    monkeypatch.undo()
    assert landing.head(spark, base, T)["open"] == ["s-1"]
    assert content(landing.scan(spark, base, T)) == content(log)


def test_closing_that_dies_changes_nothing(spark, log, monkeypatch):
    base = fresh_path(spark, "z")
    landing.write_rows(log, base, T)

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(landing, "_publish_listing", dies)
    with pytest.raises(OSError):
        landing.close_hours(spark, base, T)
    monkeypatch.undo()
    assert content(landing.scan(spark, base, T)) == content(log)
    landing.close_hours(spark, base, T)
    assert content(landing.scan(spark, base, T)) == content(log)


def test_two_closing_jobs_do_not_lose_hours(spark, log):
    base = fresh_path(spark, "z")
    landing.write_rows(log.filter("day < '03'"), base, T)
    was = landing.head(spark, base, T)
    landing.close_hours(spark, base, T)
    with pytest.raises(pointer.ConflictError):
        landing._publish_listing(spark, base, T, was, "manifest/other", was["open"])


def test_no_footer_is_read_by_the_driver(spark):
    base = fresh_path(spark, "foreign")
    spark.range(4).select(F.col("id").cast("string").alias("transaction_id")).write.parquet(f"{base}/a")
    plan = landing.foreign_schemas(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
