from __future__ import annotations

import datetime as dt

import pytest

from hostpulse.operators import serving
from hostpulse.sources.tables import _SCHEMAS


def findings(spark, *rows):
    """(host, hour, severity, type) to live findings."""
    full = [
        (host, dt.datetime(2024, 1, 1, hour), 1, 0, 0, 0.0, None, None, None, None, 1.0, 1.0, kind, severity)
        for host, hour, severity, kind in rows
    ]
    return spark.createDataFrame(full, _SCHEMAS["live_anomalies"])


def hours(spark, *rows):
    full = [(when, total, 2**20, 1, 1, total, error, 1 - error, 1.0) for when, total, error in rows]
    return spark.createDataFrame(full, _SCHEMAS["hourly_stats"])


def hosts(spark, *rows):
    full = [(host, total, 0, 0, error, None, None, 1) for host, total, error in rows]
    return spark.createDataFrame(full, _SCHEMAS["ip_behaviour"])


def endpoints(spark, *rows):
    full = [(endpoint, hits, size, 0, missing, 0, 1) for endpoint, hits, size, missing in rows]
    return spark.createDataFrame(full, _SCHEMAS["endpoint_stats"])


@pytest.fixture(scope="module")
def page(spark):
    return findings(
        spark,
        ("host1", 1, "LOW", "A"),
        ("Host1.example", 2, "HIGH", "B"),
        ("h2", 3, "CRITICAL", "A"),
        ("h2", 4, "CRITICAL", "A"),
        (None, 5, None, None),
        ("h3", 6, "MEDIUM", "B"),
    )


def test_worst_first_then_latest(spark, page):
    order = [row["window_start"].hour for row in serving.latest_anomalies(page).collect()]
    assert order == [4, 3, 2, 6, 1, 5]
    assert serving.latest_anomalies(page, 2).count() == 2
    feed = serving.overview_feed(page, 3)
    assert feed.columns == list(serving.FEED_COLUMNS) and feed.count() == 3
    assert [row["window_start"].hour for row in serving.anomaly_feed(page).collect()] == order


def test_latest_hours_in_time_order(spark):
    at = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    table = hours(spark, (at[2], 5, 0.0), (None, 1, 0.0), (at[0], 9, 0.0), (at[3], 9, 0.0))
    assert [r["hour_bucket"] for r in serving.latest_hours(table, 2).collect()] == [at[2], at[3]]
    assert [r["hour_bucket"] for r in serving.latest_hours(table, 9).collect()] == [at[0], at[2], at[3], None]
    assert serving.peak_hour(table).first()["hour_bucket"] == at[0]


@pytest.mark.parametrize(
    "filters, hits",
    [
        ({}, 6),
        ({"severities": ("CRITICAL", "LOW")}, 3),
        ({"types": ("B",)}, 2),
        ({"host": "HOST1"}, 2),
        ({"host": "^h\\d$"}, 3),
        ({"host": "1.E"}, 1),
        ({"host": "t1.e", "literal": True}, 1),
        ({"host": "^h", "literal": True}, 0),
        ({"severities": ("CRITICAL",), "host": "h"}, 2),
    ],
)
def test_search(page, filters, hits):
    assert serving.search_anomalies(page, **filters).count() == hits


def test_summaries(page):
    assert tuple(serving.severity_tiles(page).first()) == (6, 2, 1, 1, 1)
    assert tuple(serving.top_anomalous_hosts(page, 1).first()) == ("h2", 2)
    shares = {r["severity"]: (r["count"], r["share_pct"]) for r in serving.severity_distribution(page).collect()}
    assert shares["CRITICAL"] == (2, 33.3) and len(shares) == 5
    pivot = {r["anomaly_type"]: tuple(r)[1:] for r in serving.type_severity_pivot(page).collect()}
    assert pivot["A"] == (2, 0, 0, 1) and pivot["B"] == (0, 1, 1, 0)


def test_facets(page):
    found = sorted(tuple(row) for row in serving.anomaly_facets(page).collect())
    assert found == [
        ("anomaly_type", "A", 1),
        ("anomaly_type", "B", 2),
        ("severity", "CRITICAL", 1),
        ("severity", "HIGH", 2),
        ("severity", "LOW", 4),
        ("severity", "MEDIUM", 3),
    ]


def test_headline_numbers(spark, page):
    table = hours(spark, (dt.datetime(2024, 1, 1), 5, 0.5), (dt.datetime(2024, 1, 2), 7, 0.06))
    row = serving.kpi_summary(page, table, hosts(spark, ("a", 1, 0.0))).first()
    assert tuple(row) == (6, 2, 1, 0.06, 7, 1, "AMBER", "RED")


def test_headline_numbers_without_data(spark, page):
    row = serving.kpi_summary(page.limit(0), hours(spark), hosts(spark)).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0, 0, "GREEN", "GREEN")


def test_source_status(spark, page):
    known, seen = hosts(spark, ("a", 1, 0.0)), endpoints(spark, ("/a", 1, 0.0, 0))
    status = serving.source_status(page.limit(0), hours(spark), known, seen.limit(0))
    assert [tuple(r)[1] for r in status.collect()] == [False, False, True, False]
    status = serving.source_status(page, hours(spark, (None, 1, 0.0)), known.limit(0), seen)
    assert [tuple(r)[1] for r in status.collect()] == [True, True, False, True]


def test_traffic_snapshot(spark):
    at = dt.datetime(2024, 1, 1)
    row = serving.traffic_snapshot(hours(spark, (at, 10, 0.25), (at, 30, 0.0))).first()
    assert tuple(row) == (40, 4, 12.5, 30, 87.5, "AMBER", "RED")
    trend = serving.traffic_trend(hours(spark, (at, 10, 0.25))).first()
    assert (trend["error_pct"], trend["high_risk"], trend["total_mb"]) == (25.0, True, 1.0)


def test_risk_classes(spark):
    table = hosts(spark, ("a", 100, 5.01), ("b", 90, 5.0), ("c", 10, 10.01), ("d", 9, 10.0), ("e", 8, 0.0))
    found = {r["host"]: (r["q75"], r["risk"]) for r in serving.ip_risk_quadrant(table).collect()}
    assert found["a"] == (90.0, "HIGH VOLUME + HIGH ERROR")
    assert {h: risk for h, (_, risk) in found.items() if h != "a"} == {
        "b": "NORMAL", "c": "HIGH ERROR", "d": "NORMAL", "e": "NORMAL",
    }
    repeated = hosts(spark, *[(f"h{n}", 1 if n < 9 else 1000, 0.0) for n in range(10)])
    assert {r["q75"] for r in serving.ip_risk_quadrant(repeated).collect()} == {1.0}


def test_density_cells(spark):
    table = hosts(spark, ("a", 0, 0.0), ("b", 100, 10.0), ("c", 99, 0.4), ("d", 4, 0.5))
    cells = {tuple(r) for r in serving.ip_density(table).collect()}
    assert cells == {(0, 0, 1), (19, 19, 1), (19, 0, 1), (0, 1, 1)}
    assert [tuple(r) for r in serving.ip_density(hosts(spark, ("a", 5, 1.0))).collect()] == [(0, 0, 1)]


@pytest.mark.parametrize("value", [0.25, 0.35, 12.35, 2.675, 0.05, 100.0, 1234.55, 0.0, 99.95])
def test_one_decimal_like_plain_formatting(spark, value):
    """Halves follow the exact binary value, as in the usual text formatting of doubles."""
    row = serving.ip_lifecycle(hosts(spark, ("a", 1, value))).first()
    assert row["error_rate_pct"] == f"{value:.1f}%"
    row = serving.endpoint_table(endpoints(spark, ("/a", 1, value * 1024, 0))).first()
    assert row["avg_bytes"] == f"{value * 1024 / 1024:.1f} KB"


def test_missing_value_is_a_dash(spark):
    assert serving.ip_lifecycle(hosts(spark, ("a", 1, None))).first()["error_rate_pct"] == "—"
    assert serving.endpoint_table(endpoints(spark, ("/a", 1, None, 0))).first()["avg_bytes"] == "—"


def test_endpoint_reads(spark):
    table = endpoints(spark, ("/b", 10, 2048.0, 6), ("/a", 10, 1024.0, 2), ("/c", 0, None, 1), ("/d", 9, 0.0, 0))
    assert tuple(serving.endpoint_snapshot(table).first()) == (4, 29, 9, 1.0, "/a", "AMBER")
    heavy = serving.endpoint_404_heavy(table).collect()
    assert [(r["endpoint"], r["not_found_pct"], r["not_found_band"]) for r in heavy] == [
        ("/b", 60.0, "RED"), ("/a", 20.0, "AMBER"), ("/c", 100.0, "RED"),
    ]
    assert [r["endpoint"] for r in serving.endpoint_heaviest(table).collect()] == ["/b", "/a", "/d", "/c"]
    assert [r["endpoint"] for r in serving.endpoint_top(table, 2).collect()] == ["/a", "/b"]


def test_host_reads(spark):
    table = hosts(spark, ("a", 5, 1.0), ("b", 5, 11.0), ("c", 9, 6.0), ("d", 1, 99.0))
    assert [tuple(r) for r in serving.ip_top_error(table, 3).collect()] == [
        ("b", 11.0, "RED"), ("c", 6.0, "AMBER"), ("a", 1.0, "GREEN"),
    ]
    assert [r["host"] for r in serving.ip_top_volume(table, 2).collect()] == ["c", "a"]
    assert serving.ip_fleet_summary(table).first()["avg_requests"] == 5.0


def test_all_pages_together_are_the_sorted_table(spark):
    levels = ("LOW", "HIGH", "CRITICAL", "MEDIUM", "odd", None)
    rows = [(f"h{n % 7}", n // 7, levels[n % 6 if n % 5 else 0], "A") for n in range(150) if n // 7 < 24]
    frame = findings(spark, *rows)
    nulls = frame.limit(9).withColumn("window_start", serving.F.lit(None).cast("timestamp"))
    hostless = frame.limit(9).withColumn("host", serving.F.lit(None).cast("string"))
    whole = frame.union(nulls).union(hostless).dropDuplicates(["host", "window_start"])
    expected = [tuple(row) for row in serving.latest_anomalies(whole, 1000).collect()]
    for size in (1000, 40, 7):
        found, cursor = [], None
        while True:
            page = serving.next_anomalies(whole, cursor, size)
            rows = [tuple(row) for row in page.collect()]
            found += rows
            if len(rows) < size:
                break
            cursor = serving.cursor_after(page)
        assert found == expected
    plan = serving.next_anomalies(whole, cursor, 7)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Offset" not in plan


def test_no_page_after_an_empty_one(spark):
    empty = findings(spark, ("h", 1, "LOW", "A")).limit(0)
    assert serving.cursor_after(empty) is None
    assert serving.next_anomalies(empty, serving.Cursor(1, None, None)).count() == 0
