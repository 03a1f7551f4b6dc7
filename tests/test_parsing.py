from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hostpulse.operators.parsing import LINE, parse_lines, parse_quality

GOOD = 'gate-3.example.test - - [14/Mar/2021:22:47:09 +0330] "GET /docs/guide.pdf HTTP/1.1" 206 73014'


def requests(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "log string")
    return [row.asDict() for row in parse_lines(frame).collect()]


def test_well_formed_line(spark):
    assert requests(spark, GOOD) == [
        {
            "host": "gate-3.example.test",
            "timestamp": dt.datetime(2021, 3, 14, 19, 17, 9),
            "method": "GET",
            "endpoint": "/docs/guide.pdf",
            "protocol": "HTTP/1.1",
            "status": 206,
            "bytes": 73014,
        }
    ]


@pytest.mark.parametrize(
    "line",
    [
        'h - - [14/Mar/2021:22:47:09 +0330] "GET /x" 200 1',
        'h - - [14/Mar/2021:22:47:09 +0330] "GET /a b HTTP/1.0" 200 1',
        "",
        " " + GOOD,
        'h - - [x] "G / H" 2000 -',
        "GARBAGE 97",
        'a\nb - - [x] "G / H" 200 1',
        "x\n\n\n\n\n\n",
        None,
    ],
)
def test_malformed_line_is_dropped(spark, line):
    assert requests(spark, line) == []


def test_trailing_text_is_allowed(spark):
    for tail in ("trailing", "a\nb", '"x" "y"'):
        (row,) = requests(spark, f'h - - [x] "G / H" 200 - {tail}')
        assert (row["timestamp"], row["status"], row["bytes"]) == (None, 200, 0)


@pytest.mark.parametrize("stamp", ["31/Feb/1995:00:00:01 +0000", "99/Foo/1995:00:00:01 +0000", "?"])
def test_bad_time_keeps_the_row(spark, stamp):
    (row,) = requests(spark, f'h - - [{stamp}] "G / H" 200 1')
    assert row["timestamp"] is None and row["host"] == "h"


@pytest.mark.parametrize("size", ["12x", "3000000000", "1.5"])
def test_bad_size_is_null(spark, size):
    (row,) = requests(spark, f'h - - [x] "G / H" 200 {size}')
    assert row["bytes"] is None


def test_line_breaks_inside_the_stamp(spark):
    (row,) = requests(spark, 'h - - [a\nb\n\n] "G / H" 200 7')
    assert (row["host"], row["endpoint"], row["bytes"]) == ("h", "/", 7)


def test_same_parts_as_one_extraction_per_part(spark):
    """Random joins of awkward pieces, against the pattern applied group by group."""
    rng = random.Random(7)
    pieces = ["h", " ", " - - ", "[", "]", "] ", '"', ' "', '" ', "GET", "/x", "200", "-", "\n", "$1", "\\", "é"]
    lines = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(3000)]
    word = ["a", "-", "]", "[x]", '"', 'a"b', "$2", "\\n", "é", "200", "x]\\y"]
    for _ in range(3000):
        w = [rng.choice(word) for _ in range(8)]
        inner = rng.choice(["t", "a b", "\n", "[", '"q"', "$3 \\", "14/Mar/2021:22:47:09 +0000"])
        tail = rng.choice(["", " more", "\n", "\nx y"])
        lines.append(
            f'{w[0]} {w[1]} {w[2]} [{inner}] "{w[3]} {w[4]} {w[5]}" {rng.choice(["200", "404", "20"])} {w[6]}{tail}'
        )
    frame = spark.createDataFrame([(line,) for line in lines], "log string")
    names = ("host", "method", "endpoint", "protocol", "status")
    groups = (1, 3, 4, 5, 6)
    expected = frame.select(
        *[F.regexp_extract("log", LINE, g).alias(n) for n, g in zip(names, groups)]
    ).where("host != ''")
    ours = parse_lines(frame).select(*names)
    found = sorted(tuple(map(str, row)) for row in ours.collect())
    assert found == sorted(tuple(row) for row in expected.collect())
    assert len(found) > 1000


def test_quality_counts(spark):
    frame = spark.createDataFrame([(GOOD,), ("bad",), ("",), (GOOD,)], "log string")
    assert tuple(parse_quality(frame).first()) == (2, 2)


def test_the_pattern_runs_once(spark):
    """Later filters on parsed columns must not repeat the pattern or the time format."""
    frame = spark.read.text(__file__).withColumnRenamed("value", "log")
    later = parse_lines(frame).where("status = 404 AND timestamp IS NOT NULL AND host != 'x'")
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert plan.count("gettimestamp") == 1


def test_only_wanted_parts_are_built(spark):
    frame = spark.createDataFrame([(GOOD,), ("x",)], "log string")
    narrow = parse_lines(frame, fields=["status", "host"])
    assert [tuple(row) for row in narrow.collect()] == [(206, "gate-3.example.test")]
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "gettimestamp" not in plan and plan.count("regexp_replace") == 1
