from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hostpulse.functions.rules import EXPLORER_RULES
from hostpulse.operators.live import against_baseline, host_activity, live_findings
from hostpulse.operators.parsing import parse_lines
from hostpulse.plans.batch import run_batch
from hostpulse.plans.feed import burst_lines, event_lines
from hostpulse.sources.lines import stream_lines
from hostpulse.sources.tables import Layers
from hostpulse.streaming.jobs import append_available, live_activity, run_live
from hostpulse.streaming.progress import progress_table
from hostpulse.streaming.replay import (
    DAY,
    feed_in_order,
    replay_lines,
    write_ordered,
    write_shuffled,
)

SF_DIR = "/root/testdata/sf0.001"


def closed(batch, lines):
    """Windows that end at or before the last time less the watermark delay."""
    last = parse_lines(lines).agg(F.max("timestamp")).first()[0]
    end = F.col("window_start") + F.expr("INTERVAL 10 MINUTES")
    return batch.where(end <= F.lit(last) - F.expr("INTERVAL 10 MINUTES"))


def as_set(frame):
    rows = [tuple(row) for row in frame.select(*sorted(frame.columns)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    return run_batch(event_lines(spark, SF_DIR), Layers(spark, str(tmp_path_factory.mktemp("batch"))))


@pytest.mark.parametrize("rules", [None, EXPLORER_RULES])
def test_ordered_feed_equals_batch_and_a_second_run_adds_nothing(spark, layers, tmp_path, rules):
    lines = burst_lines(spark, SF_DIR)
    arrivals = str(tmp_path / "input")
    args = (rules,) if rules else ()
    target = Layers(spark, str(tmp_path / "live"))
    for name in ("ip_baselines", "global_stats"):
        target.save(layers.load(name), name)

    def run():
        return run_live(stream_lines(spark, arrivals), target, *args, partitions=2)

    assert feed_in_order(lines, str(tmp_path / "staged"), arrivals, run, 15 * DAY) >= 3
    batch = live_findings(
        against_baseline(
            host_activity(parse_lines(lines)), layers.load("ip_baselines"), layers.load("global_stats"), *args
        ),
        *args,
    )
    expected = as_set(closed(batch, lines))
    assert expected and as_set(target.load("live_anomalies")) == expected
    run()
    assert as_set(target.load("live_anomalies")) == expected


def test_shuffled_feed_drops_late_rows_and_progress_tells(spark, tmp_path):
    lines = event_lines(spark, SF_DIR)
    arrivals = str(tmp_path / "input")
    write_shuffled(lines, arrivals, files=6)
    found = live_activity(stream_lines(spark, arrivals, max_files_per_trigger=1))
    query = append_available(
        found, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "late", partitions=2
    )
    progress = progress_table(spark, query)
    totals = progress.agg(F.sum("input_rows"), F.sum("dropped_late"), F.max("watermark")).first()
    assert totals[0] == 1000 and totals[1] > 0 and totals[2] > "2024"
    assert query.name == "late"
    whole = closed(host_activity(parse_lines(lines)), lines).count()
    assert 0 < spark.read.parquet(str(tmp_path / "out")).count() < whole


def test_progress_before_the_first_batch(spark):
    class Idle:
        recentProgress = []

    assert progress_table(spark, Idle()).count() == 0


def test_ordered_files_hold_disjoint_ranges(spark, tmp_path):
    lines = event_lines(spark, SF_DIR)
    write_ordered(lines, str(tmp_path / "files"), files=5)
    back = spark.read.text(str(tmp_path / "files"))
    assert back.count() == 1000
    spans = (
        parse_lines(back.select(F.col("value").alias("log")).withColumn("log", F.col("log")))
        .where("timestamp IS NOT NULL")
        .agg(F.min("timestamp"), F.max("timestamp"))
        .first()
    )
    assert spans[0] < spans[1]
    from pathlib import Path

    times = []
    for file in sorted(Path(tmp_path / "files").glob("part-*.txt")):
        one = parse_lines(spark.read.text(str(file)).withColumnRenamed("value", "log"))
        stamps = [r[0] for r in one.select("timestamp").collect() if r[0] is not None]
        assert stamps == sorted(stamps)
        times.append((stamps[0], stamps[-1])) if stamps else None
    times.sort()
    assert len(times) >= 4 and all(a[1] <= b[0] for a, b in zip(times, times[1:]))


def test_replay_order_and_limit(spark):
    rows = [
        'b - - [02/Jan/2024:00:00:00 +0000] "G / H" 200 1  ',
        "   ",
        "",
        "junk",
        '\ta - - [01/Jan/2024:00:00:00 +0000] "G / H" 200 1',
    ]
    lines = spark.createDataFrame([(row,) for row in rows], "log string")
    whole = [row["log"] for row in replay_lines(lines, limit=None).collect()]
    assert [line[0] for line in whole] == ["a", "b", "j"] and not whole[1].endswith(" ")
    assert [row["log"] for row in replay_lines(lines, limit=1).collect()] == whole[:1]
