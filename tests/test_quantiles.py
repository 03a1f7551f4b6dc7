"""Quantiles by repeated histograms, against a sorted list and Spark's own percentile."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hostpulse.operators.quantiles import exact_quantiles, quantile_table, values_at

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def spark_percentiles(table, column):
    return table.agg(F.percentile(column, F.lit(SHARES))).first()[0]


@pytest.mark.parametrize("bins", [16, 1024])
@pytest.mark.parametrize(
    "make",
    [
        lambda n: n % 5,
        lambda n: 7,
        lambda n: int(random.paretovariate(0.3)) % 10**12,
        lambda n: None if n % 3 == 0 else n,
    ],
)
def test_integers_equal_percentile(spark, make, bins):
    random.seed(2)
    table = spark.createDataFrame([(make(n),) for n in range(400)], "x bigint").cache()
    assert exact_quantiles(table, "x", SHARES, bins) == spark_percentiles(table, "x")


@pytest.mark.parametrize("bins", [64, 1024])
def test_doubles_equal_percentile(spark, bins):
    random.seed(3)
    rows = [(random.choice([random.gauss(0, 1), random.gauss(0, 1) * 1e200, 0.5, -0.0]),) for _ in range(300)]
    table = spark.createDataFrame([*rows, (None,), (5e-324,), (0.0,)], "x double").cache()
    assert exact_quantiles(table, "x", SHARES, bins) == spark_percentiles(table, "x")
    odd = table.union(spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,)], table.schema))
    assert exact_quantiles(odd, "x", SHARES, bins) == spark_percentiles(table, "x")


def test_extremes_and_close_values(spark):
    wide = [-(2**63), 2**63 - 1, 0, 1, -1, 2**53, 2**53 + 1]
    table = spark.createDataFrame([(x,) for x in wide], "value bigint")
    found = values_at(table, range(7), (min(wide), max(wide), 0), True)
    assert [found[rank] for rank in range(7)] == sorted(wide)
    ends = [-1.7e308, 1.7e308, 5e-324, 1e-323, 0.0]
    table = spark.createDataFrame([(x,) for x in ends], "value double")
    found = values_at(table, range(5), (min(ends), max(ends), 0), False)
    assert [found[rank] for rank in range(5)] == sorted(ends)


def test_empty_types_and_shares(spark):
    none = spark.createDataFrame([(None,)], "x bigint")
    assert exact_quantiles(none, "x", [0.5]) == [None]
    assert exact_quantiles(none.limit(0), "x", [0.5, 1.0]) == [None, None]
    with pytest.raises(TypeError):
        exact_quantiles(none.select(F.lit("a").alias("x")), "x", [0.5])
    with pytest.raises(ValueError):
        exact_quantiles(none, "x", [1.5])
    clash = spark.createDataFrame([(3, 1, 2)], "`a.b` int, bin int, value int")
    assert exact_quantiles(clash, "a.b", [0.5]) == [3.0]
    rows = quantile_table(clash, ["bin", "value"], [0.0, 1.0]).collect()
    assert [tuple(row) for row in rows] == [
        ("bin", 0.0, 1.0), ("bin", 1.0, 1.0), ("value", 0.0, 2.0), ("value", 1.0, 2.0),
    ]


def test_table_of_quantiles_needs_no_driver_rows(spark):
    none = spark.createDataFrame([(None, 2.5)], "x bigint, y double")
    found = quantile_table(none, ["x", "y"], [0, 0.5])
    assert "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.dtypes == [("measure", "string"), ("share", "double"), ("value", "double")]
    rows = [tuple(row) for row in found.collect()]
    assert rows == [("x", 0.0, None), ("x", 0.5, None), ("y", 0.0, 2.5), ("y", 0.5, 2.5)]
    assert quantile_table(none, [], [0.5]).dtypes == found.dtypes


def test_filter_reaches_the_files(spark, tmp_path, monkeypatch):
    """Later rounds read only what lies in the ranges left."""
    spark.range(0, 1_000_000, numPartitions=4).select(F.col("id").alias("x")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    plans = []
    frame = type(table.groupBy())
    agg = frame.agg

    def spy(self, *columns):
        result = agg(self, *columns)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(frame, "agg", spy)
    assert exact_quantiles(table, "x", [0.5]) == [499_999.5]
    grouped = [plan for plan in plans if "GreaterThanOrEqual(x" in plan]
    assert len(grouped) >= 2
    assert all("partial_count" in plan and "ReadSchema: struct<x:bigint>" in plan for plan in grouped)
