"""Every registered query against its SQL, over the whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from hostpulse.plans.oracles import ORACLES
from hostpulse.plans.registry import QUERIES
from hostpulse.plans.workspace import shared_folder
from tests.compare import check, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, name, SF_DIR) is None


def test_entry(spark):
    found = spark_entry.entry(spark)
    assert found.columns[0] == "anomaly_source" and found.count() > 0


def test_layers_are_built_again_when_cleared(spark, monkeypatch):
    from hostpulse.plans import workspace

    first = workspace.stored_layers(spark, SF_DIR)
    assert workspace.stored_layers(spark, SF_DIR) == first
    key = next(key for key, root in workspace._built.items() if first.root.startswith(str(root)))
    monkeypatch.setitem(workspace._built, key, workspace._built[key] + "-gone")
    again = workspace.stored_layers(spark, SF_DIR)
    assert again.root != first.root and again.load("anomalies").count() > 0


STREAMED = {"live_activity_stream", "live_anomalies_stream"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    frame = spark_entry.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "ExistingRDD"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["serve_anomalies", "serve_ip", "serve_endpoint"])
def test_pages_are_a_top_k(spark, name):
    frame = spark_entry.queries()[name](spark, SF_DIR)
    assert "TakeOrderedAndProject" in frame._jdf.queryExecution().executedPlan().toString()


class Session:
    """A session without ``spark.checkpoint.dir``."""

    class conf:
        @staticmethod
        def get(key, default):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}.get(key, default)

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_shared_folder_is_never_a_local_one():
    for master in ("spark://host:7077", "local[2]"):
        assert shared_folder(Session(master)) == "hdfs://store/warehouse/hostpulse/app"


def test_layers_follow_their_input_and_need_every_layer(spark, tmp_path):
    from hostpulse.plans import workspace

    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    folder = str(tmp_path / "sf")
    events.limit(500).write.parquet(f"{folder}/events.parquet")

    def bronze():
        counts = spark_entry.queries()["layer_counts"](spark, folder).collect()
        return {row.layer: row["rows"] for row in counts}["bronze"]

    assert bronze() == 500
    events.limit(50).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    assert bronze() == 50
    layers = workspace.stored_layers(spark, folder)
    assert workspace.stored_layers(spark, folder) == layers
    # One file of one layer is gone: the build no longer counts.
    part = next(Path(layers.path("silver")).rglob("part-*.parquet"))
    part.unlink()
    again = workspace.stored_layers(spark, folder)
    assert again.root != layers.root and again.load("silver").count() > 0


def test_stored_layers_run_no_job(spark):
    from hostpulse.plans import workspace

    layers = workspace.stored_layers(spark, SF_DIR)
    spark.sparkContext.setJobGroup("stored", "no job")
    try:
        assert workspace.stored_layers(spark, SF_DIR) == layers
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("stored")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_measures_take_their_whole_table(spark):
    def rows(name):
        return spark_entry.queries()[name](spark, "/root/testdata/sf0.1").collect()

    assert rows("ip_fleet_summary")[0].hosts == rows("serve_kpi")[0].unique_ips > 500
    by_severity = {row.severity: row["count"] for row in rows("live_by_severity")}
    assert {row.severity: row["count"] for row in rows("severity_distribution")} == by_severity
    assert len(rows("ip_risk_quadrant")) == rows("serve_kpi")[0].unique_ips
    summary = rows("replay_summary")[0]
    assert len(rows("replay_feed")) == summary.sent == summary.lines - summary.blank


BY_HOUR = {"hourly_stats", "hourly_lag_change", "hourly_zscores", "hourly_anomalies", "batch_anomalies"}
BY_HOUR |= {"anomaly_summary", "anomaly_by_source_type", "anomaly_by_severity", "critical_batch"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED - BY_HOUR))
def test_no_window_spans_a_table(spark, name):
    """Only the hourly rollup, one row per hour, has windows without a key."""
    frame = spark_entry.queries()[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().analyzed().toString()
    for line in plan.splitlines():
        if "Window [" in line:
            assert "windowspecdefinition(" in line and "windowspecdefinition(specified" not in line


def test_told_lines_reach_the_rules():
    found = database("/root/testdata/sf0.01").execute(ORACLES["batch_anomalies"]).df()
    assert {
        "BOT_SCRAPER",
        "ENDPOINT_SCANNER",
        "BULK_DOWNLOADER",
        "HIGH_ERROR_IP",
        "GENERALLY_SUSPICIOUS",
        "MOSTLY_BROKEN_ENDPOINT",
        "ATTACKED_ENDPOINT",
        "UNUSUALLY_HEAVY_PAYLOAD",
        "HOTSPOT_ENDPOINT",
        "TRAFFIC_SPIKE",
        "ERROR_SURGE",
        "SUDDEN_HOH_JUMP",
    } <= set(found["anomaly_type"])


def test_counts_read_no_column(spark):
    """Row counts come from the files' footers: the scans ask for no column."""
    for name in ("layer_counts", "serve_kpi"):
        plan = spark_entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<>" in plan
        if name == "layer_counts":
            assert plan.count("ReadSchema: struct<>") == plan.count("ReadSchema:")
