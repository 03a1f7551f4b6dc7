from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hostpulse.operators import rollups

SILVER = "host string, timestamp timestamp, method string, endpoint string, protocol string, status int, bytes int"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def requests(spark, *rows):
    full = [(host, when, "GET", endpoint, "HTTP/1.0", status, size) for host, when, endpoint, status, size in rows]
    return spark.createDataFrame(full, SILVER)


def test_hourly_counts_and_rates(spark):
    frame = requests(
        spark,
        ("a", at(1), "/x", 200, 10),
        ("a", at(1, 59), "/x", 204, None),
        ("b", at(1, 30), "/x", 404, 5),
        ("b", at(1, 31), "/x", 403, 5),
        ("b", at(1, 32), "/x", 500, 5),
        ("b", at(1, 33), "/x", 304, 5),
    )
    row = rollups.hourly_stats(frame).first()
    assert tuple(row) == (at(1), 6, 30, 1, 1, 2, 0.3333, 0.3333, 6.0)


def test_rolling_mean_takes_present_hours_and_the_hour_without_time_comes_first(spark):
    rows = [("a", None, "/x", 200, 1)] * 4
    rows += [("a", at(2), "/x", 200, 1)] + [("a", at(9), "/x", 200, 1)] * 2 + [("a", at(10), "/x", 200, 1)] * 3
    hours = rollups.hourly_stats(requests(spark, *rows)).orderBy("hour_bucket").collect()
    assert [row["hour_bucket"] for row in hours] == [None, at(2), at(9), at(10)]
    assert [row["rolling_3hr_avg_requests"] for row in hours] == [4.0, 2.5, 2.33, 2.0]


def test_profiles_equal_direct_aggregation(spark):
    frame = spark.range(4000).select(
        F.concat(F.lit("h"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 37)).alias("host"),
        F.timestamp_seconds(F.col("id") * 61).alias("timestamp"),
        F.concat(F.lit("/e"), F.col("id") % 11).alias("endpoint"),
        F.element_at(F.array(*map(F.lit, (200, 404, 500, 304))), (F.col("id") % 4 + 1).cast("int")).alias("status"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("int")).alias("bytes"),
    )
    pairs = rollups.host_endpoint(frame)
    bad = F.count_if(F.col("status") >= 400)
    hosts = frame.groupBy("host").agg(
        F.count("*"), F.sum("bytes"), bad, F.round(bad / F.count("*") * 100, 2),
        F.min("timestamp"), F.max("timestamp"), F.count_distinct("endpoint"),
    )
    endpoints = frame.groupBy("endpoint").agg(
        F.count("*"), F.round(F.avg("bytes"), 2), F.max("bytes"), F.count_if(F.col("status") == 404),
        F.count_if(F.col("status") == 200), F.count_distinct("host"),
    )
    for ours, direct in ((rollups.ip_behaviour(pairs), hosts), (rollups.endpoint_stats(pairs), endpoints)):
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, direct.collect()))


def test_endpoint_without_any_size(spark):
    frame = requests(spark, ("a", at(1), "/x", 200, None))
    row = rollups.endpoint_stats(rollups.host_endpoint(frame)).first()
    assert (row["avg_bytes"], row["max_bytes"], row["total_hits"]) == (None, None, 1)


def test_host_hours_skip_requests_without_time(spark):
    frame = requests(spark, ("a", at(1, 59), "/x", 200, 1), ("a", None, "/x", 200, 1), ("a", at(1), "/x", 200, 1))
    assert [tuple(row) for row in rollups.ip_hourly(frame).collect()] == [("a", at(1), 2)]


def test_broken_endpoints(spark):
    schema = "endpoint string, total_hits bigint, not_found_count bigint"
    frame = spark.createDataFrame([("/a", 50, 50), ("/b", 51, 10), ("/c", 1000, 204), ("/d", 1000, 205)], schema)
    assert {r["endpoint"]: r["not_found_rate_pct"] for r in rollups.broken_endpoints(frame).collect()} == {
        "/b": 19.61, "/c": 20.4, "/d": 20.5,
    }
    # 0.1961 and 0.204 round to 0.20, which is not above 0.2; 0.205 rounds to 0.21.
    assert sorted(r[0] for r in rollups.known_broken(frame).collect()) == ["/a", "/d"]
