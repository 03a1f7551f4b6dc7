"""Windows over ordered ranges, against windows that one task orders."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hostpulse.operators.anomalies import hourly_change
from hostpulse.operators.clock import clock_stats
from hostpulse.operators.ordered import over_previous, placed
from hostpulse.operators.parsing import parse_lines
from hostpulse.operators.rollups import hourly_stats
from hostpulse.plans.feed import event_lines


def measures(window):
    return {
        "before": F.lag("x", 3).over(window),
        "total": F.sum("x").over(window.rowsBetween(-4, 0)),
        "seen": F.count("x").over(window.rowsBetween(-2, -1)),
    }


@pytest.mark.parametrize("n, parts, block", [(0, 4, 8), (1, 4, 8), (3, 8, 1), (500, 7, 6), (500, 7, 10_000)])
def test_blocks_equal_one_window(spark, tmp_path, n, parts, block):
    random.seed(n)
    # A third of the rows share one key; nulls come first.
    rows = [(random.choice([None, 5, random.randrange(10**6)]), i, random.randrange(99)) for i in range(n)]
    table = spark.createDataFrame(rows, "k int, id int, x int")
    found = placed(table, ["k", "id"], str(tmp_path / "t"), parts)
    assert sorted(r.place for r in found.collect()) == list(range(n))
    moved = over_previous(found, 4, measures, block)
    whole = table.select("*", *[c.alias(a) for a, c in measures(Window.orderBy("k", "id")).items()])
    assert moved.drop("place").exceptAll(whole).count() == 0 and moved.count() == n
    assert "SinglePartition" not in moved._jdf.queryExecution().executedPlan().toString()


def test_hot_key_spans_ranges_and_names_do_not_clash(spark, tmp_path):
    table = spark.range(1000).select(F.lit(1).alias("k"), "id")
    placed(table, ["k", "id"], str(tmp_path / "t"), 8)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.select(F.shiftright("place", 33)).distinct().count() == 8
    with pytest.raises(ValueError):
        placed(table.withColumn("place", F.lit(1)), ["id"], str(tmp_path / "u"))
    with pytest.raises(ValueError):
        over_previous(table.withColumn("block", F.lit(1)), 1, measures)


def test_hours_equal_the_hourly_rollup(spark, tmp_path):
    requests = parse_lines(event_lines(spark, "/root/testdata/sf0.001"))
    found = clock_stats(requests, "hour", str(tmp_path / "t"), 3, parts=5, block=4)
    wanted = hourly_change(hourly_stats(requests)).withColumnRenamed(
        "rolling_3hr_avg_requests", "rolling_avg_requests"
    ).select(*found.columns)
    assert found.exceptAll(wanted).count() == 0 == wanted.exceptAll(found).count()
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
