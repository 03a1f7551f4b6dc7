from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hostpulse.functions.rules import (
    BATCH_SEVERITIES,
    ENDPOINT_RULES,
    EXPLORER_RULES,
    HOST_RULES,
    HOURLY_RULES,
    JOB_RULES,
    first_match,
    severity_rank,
)
from hostpulse.operators import anomalies, live


def label(spark, rules, schema, row, otherwise=None):
    frame = spark.createDataFrame([row], schema)
    return frame.select(first_match(rules, otherwise)).first()[0]


HOURLY = "request_z_score double, error_rate_z_score double, request_change_pct double"


@pytest.mark.parametrize(
    "row, expected",
    [
        ((2.5, 0.0, 0.0), None),
        ((2.51, 9.0, 900.0), "TRAFFIC_SPIKE"),
        ((-2.5, 0.0, 0.0), None),
        ((-2.51, 9.0, 0.0), "UNUSUAL_QUIET"),
        ((0.0, 2.5, 0.0), None),
        ((0.0, 2.51, 900.0), "ERROR_SURGE"),
        ((0.0, 0.0, 100.0), None),
        ((0.0, 0.0, 100.01), "SUDDEN_HOH_JUMP"),
        ((None, None, 100.01), "SUDDEN_HOH_JUMP"),
        ((None, None, None), None),
    ],
)
def test_hourly_rules(spark, row, expected):
    assert label(spark, HOURLY_RULES, HOURLY, row) == expected


HOST = (
    "volume_z double, error_z double, breadth_z double, bytes_z double, "
    "error_rate_pct double, suspicion_score double"
)


@pytest.mark.parametrize(
    "row, expected",
    [
        ((3.01, 0.0, 3.01, 0.0, 0.0, 0.0), "BOT_SCRAPER"),
        ((3.0, 0.0, 3.01, 0.0, 0.0, 0.0), None),
        ((3.01, 9.0, 3.0, 0.0, 0.0, 0.0), "ENDPOINT_SCANNER"),
        ((1.01, 3.01, 0.0, 0.0, 99.0, 9.0), "ENDPOINT_SCANNER"),
        ((1.0, 3.01, 0.0, 0.0, 0.0, 0.0), None),
        ((0.99, 0.0, 0.0, 3.01, 0.0, 0.0), "BULK_DOWNLOADER"),
        ((1.0, 0.0, 0.0, 3.01, 0.0, 0.0), None),
        ((0.0, 0.0, 0.0, 0.0, 20.0, 0.0), None),
        ((0.0, 0.0, 0.0, 0.0, 20.01, 9.0), "HIGH_ERROR_IP"),
        ((0.0, 0.0, 0.0, 0.0, 0.0, 2.5), None),
        ((0.0, 0.0, 0.0, 0.0, 0.0, 2.51), "GENERALLY_SUSPICIOUS"),
        ((None, None, None, None, 20.01, None), "HIGH_ERROR_IP"),
        ((None, None, None, None, 1.0, None), None),
    ],
)
def test_host_rules(spark, row, expected):
    assert label(spark, HOST_RULES, HOST, row) == expected


ENDPOINT = "not_found_rate double, `404_z` double, bytes_z double, hits_z double"


@pytest.mark.parametrize(
    "row, expected",
    [
        ((50.0, 0.0, 0.0, 0.0), None),
        ((50.01, 9.0, 9.0, 9.0), "MOSTLY_BROKEN_ENDPOINT"),
        ((10.0, 3.01, 9.0, 2.01), "ATTACKED_ENDPOINT"),
        ((10.0, 3.01, 0.0, 2.0), None),
        ((0.0, 0.0, 3.01, 9.0), "UNUSUALLY_HEAVY_PAYLOAD"),
        ((0.99, 0.0, 0.0, 4.01), "HOTSPOT_ENDPOINT"),
        ((1.0, 0.0, 0.0, 4.01), None),
        ((0.0, None, None, None), None),
    ],
)
def test_endpoint_rules(spark, row, expected):
    assert label(spark, ENDPOINT_RULES, ENDPOINT, row) == expected


@pytest.mark.parametrize(
    "score, expected",
    [
        (6.0, "CRITICAL"),
        (5.99, "HIGH"),
        (4.0, "HIGH"),
        (3.99, "MEDIUM"),
        (2.5, "MEDIUM"),
        (2.49, "LOW"),
        (-3.0, "LOW"),
        (None, "LOW"),
    ],
)
def test_batch_severity(spark, score, expected):
    assert label(spark, BATCH_SEVERITIES, "z_score double", (score,), "LOW") == expected


LIVE = (
    "batch_total_requests bigint, rate_multiplier double, global_z_score double, "
    "live_error_rate double, live_404s bigint, batch_error_rate double"
)


def live_outcome(spark, rules, row):
    found = live.live_findings(spark.createDataFrame([row], LIVE), rules).first()
    return (found["anomaly_type"], found["severity"]) if found else None


@pytest.mark.parametrize(
    "row, expected",
    [
        ((10, 5.0, 9.0, 0.0, 0, 0.0), None),
        ((10, 5.01, 9.0, 99.0, 0, 0.0), ("PERSONAL_SPIKE", "HIGH")),
        ((10, 10.01, 0.0, 0.0, 0, 0.0), ("PERSONAL_SPIKE", "CRITICAL")),
        ((None, None, 3.0, 0.0, 0, None), None),
        ((None, None, 3.01, 0.0, 0, None), ("UNKNOWN_IP_SURGE", "MEDIUM")),
        ((None, None, 3.01, 50.01, 0, None), ("UNKNOWN_IP_SURGE", "CRITICAL")),
        ((10, 1.0, 0.0, 30.0, 0, 0.0), None),
        ((10, 1.0, 0.0, 30.01, 0, 0.0), ("LIVE_ERROR_SURGE", "MEDIUM")),
        ((10, 1.0, 0.0, 50.0, 0, 0.0), ("LIVE_ERROR_SURGE", "MEDIUM")),
        ((10, 1.0, 0.0, 50.01, 0, 0.0), ("LIVE_ERROR_SURGE", "CRITICAL")),
        ((10, 1.0, 0.0, 27.5, 21, 4.9), ("NEW_SCANNING_BEHAVIOUR", "MEDIUM")),
        ((10, 1.0, 0.0, 27.5, 20, 4.9), None),
        ((10, 1.0, 0.0, 27.5, 21, 5.0), None),
        ((None, None, None, 27.5, 99, None), None),
    ],
)
def test_job_rules(spark, row, expected):
    assert live_outcome(spark, JOB_RULES, row) == expected


@pytest.mark.parametrize(
    "row, expected",
    [
        ((10, 10.01, 0.0, 0.0, 0, 0.0), ("PERSONAL_SPIKE", "HIGH")),
        ((10, 15.01, 0.0, 0.0, 0, 0.0), ("PERSONAL_SPIKE", "CRITICAL")),
        ((10, 5.01, 0.0, 0.0, 0, 0.0), ("SUSPICIOUS_ACTIVITY", "MEDIUM")),
        ((10, 8.01, 0.0, 0.0, 0, 0.0), ("SUSPICIOUS_ACTIVITY", "HIGH")),
        ((10, 1.0, 0.0, 60.0, 0, 0.0), ("LIVE_ERROR_SURGE", "MEDIUM")),
        ((10, 1.0, 0.0, 60.01, 0, 0.0), ("LIVE_ERROR_SURGE", "CRITICAL")),
        ((None, 1.0, 3.5, 0.0, 0, None), ("UNKNOWN_IP_SURGE", "LOW")),
        ((None, 1.0, 4.01, 0.0, 0, None), ("UNKNOWN_IP_SURGE", "HIGH")),
        ((10, 1.0, 0.0, 27.5, 21, 4.9), ("SCANNING_BEHAVIOUR", "LOW")),
        ((10, 5.0, 9.0, 30.0, 20, 0.0), None),
    ],
)
def test_explorer_rules(spark, row, expected):
    assert live_outcome(spark, EXPLORER_RULES, row) == expected


ACTIVITY = "host string, window_start timestamp, live_requests bigint, live_errors bigint, live_404s bigint, live_error_rate double"
PROFILE = "host string, batch_total_requests bigint, batch_error_rate double, batch_endpoint_breadth bigint, expected_hourly_requests double"


def scored(spark, rules, spread=6.0):
    activity = spark.createDataFrame(
        [("known", None, 80, 22, 22, 27.5), ("ghost", None, 12, 0, 0, 0.0)], ACTIVITY
    )
    profile = spark.createDataFrame([("known", 80640, 4.9, 3, 120.0)], PROFILE)
    stats = spark.createDataFrame([(12.0, spread)], "global_mean double, global_stddev double")
    rows = live.against_baseline(activity, profile, stats, rules)
    return rows, {row["host"]: row for row in rows.collect()}


def test_scores_against_the_baseline(spark):
    frame, rows = scored(spark, JOB_RULES)
    assert rows["known"]["rate_multiplier"] == 3.81
    assert rows["known"]["global_z_score"] == 78.0
    assert rows["ghost"]["rate_multiplier"] is None
    assert rows["ghost"]["batch_total_requests"] is None
    found = {r["host"]: r["anomaly_type"] for r in live.live_findings(frame).collect()}
    assert found == {"known": "NEW_SCANNING_BEHAVIOUR", "ghost": "UNKNOWN_IP_SURGE"}


def test_unknown_host_expects_nothing_for_the_explorer(spark):
    _, rows = scored(spark, EXPLORER_RULES)
    assert rows["ghost"]["rate_multiplier"] == 12.0


@pytest.mark.parametrize("spread", [0.0, None])
def test_no_spread_gives_no_live_score(spark, spread):
    _, rows = scored(spark, JOB_RULES, spread)
    assert rows["known"]["global_z_score"] is None


def test_severity_rank(spark):
    frame = spark.createDataFrame([("LOW",), ("CRITICAL",), (None,), ("odd",)], "severity string")
    assert [r[0] for r in frame.select(severity_rank()).collect()] == [4, 1, 5, 5]


HOURS = (
    "hour_bucket timestamp, total_requests bigint, total_bytes bigint, errors_404 bigint, "
    "errors_500 bigint, success_count bigint, error_rate double, success_rate double, "
    "rolling_3hr_avg_requests double"
)


def test_changes_and_scores_of_equal_hours(spark):
    import datetime as dt

    rows = [
        (dt.datetime(2024, 1, 1, hour), 10, None, 0, 0, 10, rate, 1.0, 10.0)
        for hour, rate in ((0, 0.0), (1, 0.1), (5, 0.2))
    ]
    hours = spark.createDataFrame(rows, HOURS)
    scores = anomalies.hourly_scores(hours).orderBy("hour_bucket").collect()
    assert [row["request_z_score"] for row in scores] == [0.0, 0.0, 0.0]
    assert [row["prev_requests"] for row in scores] == [None, 10, 10]
    assert [row["request_change_pct"] for row in scores] == [0.0, 0.0, 0.0]
    # Nothing before the first hour, zero before the second, damped after that.
    assert [row["error_rate_change_pct"] for row in scores][:2] == [0.0, 0.0]
    assert scores[2]["error_rate_change_pct"] == (0.2 - 0.1) / (0.1 + 1e-4) * 100
    # Bytes are all NULL: no mean, no score.
    assert [row["bytes_z_score"] for row in scores] == [None, None, None]


def test_single_host_has_no_scores(spark):
    schema = (
        "host string, total_requests bigint, total_bytes_transferred bigint, total_errors bigint, "
        "error_rate_pct double, first_seen timestamp, last_seen timestamp, unique_endpoints_hit bigint"
    )
    hosts = spark.createDataFrame([("h", 5, 10, 2, 40.0, None, None, 1)], schema)
    row = anomalies.ip_scores(hosts).first()
    assert row["volume_z"] is None and row["suspicion_score"] is None
    (found,) = anomalies.graded(anomalies.ip_findings(anomalies.ip_scores(hosts))).collect()
    assert (found["anomaly_type"], found["severity"]) == ("HIGH_ERROR_IP", "LOW")
    assert (found["metric_value"], found["baseline_value"]) == (5, 5.0)


def test_suspicion_score_adds_in_order(spark):
    frame = spark.createDataFrame([(1.15, 2.35, 0.1, 0.7)], "volume_z double, error_z double, breadth_z double, bytes_z double")
    from hostpulse.functions.measures import weighted
    from hostpulse.functions.rules import SUSPICION_WEIGHTS

    plain = F.round(
        F.col("volume_z") * 0.3 + F.col("error_z") * 0.3 + F.col("breadth_z") * 0.25 + F.col("bytes_z") * 0.15, 2
    )
    row = frame.select(weighted(SUSPICION_WEIGHTS).alias("a"), plain.alias("b")).first()
    assert row["a"] == row["b"]
