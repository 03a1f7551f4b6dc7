"""Profiles stored by host: same rows, and no exchange on their side of the join."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from hostpulse.operators.live import against_baseline, sized_for_join
from hostpulse.sources.buckets import BucketedTable

SCHEMA = "host string, expected_hourly_requests double"
ACTIVITY = (
    "host string, window_start timestamp, live_requests bigint, live_errors bigint, "
    "live_404s bigint, live_error_rate double"
)


def exchanges(table):
    plan = table._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning(host"), plan


def test_join_leaves_the_profile_where_it_lies(spark, tmp_path):
    rows = [(f"h{n}", float(n % 7)) for n in range(3000)] + [(None, 1.0), ("", 2.0)]
    profile = spark.createDataFrame(rows, SCHEMA)
    at = dt.datetime(2024, 1, 1)
    live = [(f"h{n % 3100}", at, n, 0, 0, 0.0) for n in range(4000)] + [(None, at, 1, 0, 0, 0.0)]
    live += [("h1", at, n, 0, 0, 0.0) for n in range(2000)]  # one host has a third
    spark.createDataFrame(live, ACTIVITY).write.parquet(f"{tmp_path}/live")
    activity = spark.read.parquet(f"{tmp_path}/live")
    stats = spark.createDataFrame([(1.0, 1.0)], "global_mean double, global_stddev double")
    plain = against_baseline(activity, profile.hint("merge"), stats)
    table = BucketedTable(spark, f"{tmp_path}/it's", "host", 8)
    stored = sized_for_join(table.write(profile), max_bytes=1000).hint("merge")
    joined = against_baseline(activity, stored, stats)
    count, plan = exchanges(joined)
    assert count == 1 and "Bucketed: true" in plan, plan
    assert exchanges(plain)[0] == 2
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))
    spark.sql(f"DROP TABLE {table.name}")  # as in a session that has not written it
    again = table.open(SCHEMA)
    assert exchanges(against_baseline(activity, again.hint("merge"), stats))[0] == 1
    assert sorted(map(repr, again.collect())) == sorted(map(repr, profile.collect()))
    with pytest.raises(AnalysisException):
        table.write(profile)


def test_empty_profile(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/none", "host", 4)
    assert table.write(spark.createDataFrame([], SCHEMA)).count() == 0
    assert table.open(SCHEMA).count() == 0
