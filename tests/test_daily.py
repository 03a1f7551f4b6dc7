"""Rollups kept by the day: equal to a full rebuild, and each batch touches its own days only."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostpulse.operators import daily, rollups
from hostpulse.operators.parsing import event_time, parse_lines
from hostpulse.plans.daily import DailyParts, publish_rollups
from hostpulse.plans.feed import event_lines
from hostpulse.sources.versions import Versions

SF_DIR = "/root/testdata/sf0.001"


def as_rows(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def stored(root):
    """Every data file with its time of change."""
    return {str(file): file.stat().st_mtime_ns for file in Path(root).rglob("part-*.parquet")}


def same_as_rebuild(parts, lines):
    requests = parse_lines(lines)
    pairs = rollups.host_endpoint(requests)
    assert as_rows(daily.hours_of(parts.load("hours"))) == as_rows(rollups.hourly_stats(requests))
    assert as_rows(daily.hosts_of(parts.load("pairs"))) == as_rows(rollups.ip_behaviour(pairs))
    assert as_rows(daily.endpoints_of(parts.load("pairs"))) == as_rows(rollups.endpoint_stats(pairs))
    assert as_rows(daily.host_hours_of(parts.load("host_hours"))) == as_rows(rollups.ip_hourly(requests))


@pytest.fixture
def days(spark):
    lines = event_lines(spark, SF_DIR).cache()
    yield lines, F.to_date(event_time())
    lines.unpersist()


def test_one_day_more_touches_that_day_only(spark, tmp_path, days):
    lines, day = days
    parts = DailyParts(spark, str(tmp_path / "daily"))
    past = lines.where(day.isNull() | (day < "2024-01-20"))
    parts.add(past, "past")
    same_as_rebuild(parts, past)
    before = stored(tmp_path)
    parts.add(lines.where(day == "2024-01-20"), "2024-01-20")
    after = stored(tmp_path)
    assert before.items() <= after.items()
    new = set(after) - set(before)
    assert new and all("day=2024-01-20/batch=2024-01-20/" in file for file in new)
    same_as_rebuild(parts, lines.where(day.isNull() | (day <= "2024-01-20")))


def test_a_batch_sent_again_counts_once(spark, tmp_path, days):
    lines, day = days
    parts = DailyParts(spark, str(tmp_path / "daily"))
    parts.add(lines.where(day < "2024-01-10"), "a")
    parts.add(lines.where(day.between("2024-01-05", "2024-01-12")), "b")
    parts.add(lines.where(day.between("2024-01-10", "2024-01-12")), "b")  # now without old days
    same_as_rebuild(parts, lines.where(day <= "2024-01-12"))


def test_stray_lines_join_days_that_are_covered(spark, tmp_path, days):
    lines, day = days
    stray = F.pmod(F.hash("log"), F.lit(5)) == 0
    parts = DailyParts(spark, str(tmp_path / "daily"))
    parts.add(lines.where(~stray), "most")
    before = stored(tmp_path)
    parts.add(lines.where(stray), "stray")
    assert before.items() <= stored(tmp_path).items()
    same_as_rebuild(parts, lines)


def test_days_are_pruned(spark, tmp_path, days):
    lines, _ = days
    parts = DailyParts(spark, str(tmp_path / "daily"))
    parts.add(lines, "all")
    one = parts.load("pairs").where("day = date'2024-01-07'")
    files = one.select("_metadata.file_path").distinct().collect()
    assert files and all("/day=2024-01-07/" in row.file_path for row in files)
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_odd_batches(spark, tmp_path, days):
    lines, _ = days
    parts = DailyParts(spark, str(tmp_path / "daily"))
    for name in ("", "a/b", "a b", "a=b"):
        with pytest.raises(ValueError):
            parts.add(lines, name)
    parts.add(lines, "all")
    parts.add(lines.limit(0), "nothing")
    parts.add(spark.createDataFrame([("no log line",), (None,), ("",)], "log string"), "junk")
    same_as_rebuild(parts, lines)


def test_rollups_are_published_as_a_version(spark, tmp_path, days):
    lines, day = days
    parts, versions = DailyParts(spark, str(tmp_path / "daily")), Versions(spark, str(tmp_path / "gold"))
    parts.add(lines.where(day < "2024-01-15"), "first")
    publish_rollups(parts, versions)
    with versions.pinned() as first:
        old = as_rows(first.load("hourly_stats"))
        parts.add(lines.where(day.isNull() | (day >= "2024-01-15")), "second")
        publish_rollups(parts, versions)
        assert as_rows(first.load("hourly_stats")) == old
    requests = parse_lines(lines)
    now = versions.current()
    assert as_rows(now.load("hourly_stats")) == as_rows(rollups.hourly_stats(requests))
    assert as_rows(now.load("ip_behaviour")) == as_rows(rollups.ip_behaviour(rollups.host_endpoint(requests)))
    assert now.load("ip_baselines").count() == now.load("ip_behaviour").count()
