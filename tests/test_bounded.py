"""Several bounded batches in one run of a stream, and the history of its batches."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostpulse.operators.live import host_activity, late_rows
from hostpulse.operators.parsing import event_time, parse_lines
from hostpulse.plans.feed import event_lines
from hostpulse.sources.lines import stream_lines
from hostpulse.streaming.jobs import append_available, live_activity
from hostpulse.streaming.progress import ProgressHistory
from hostpulse.streaming.replay import DAY, slice_of, write_arrivals

SF_DIR = "/root/testdata/sf0.001"


def line(host, time, status=200):
    return f'{host} - - [{time} +0000] "GET / HTTP/1.0" {status} 1'


def table(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "log string")


def oldest_first(folder):
    files = sorted(Path(folder).glob("part-*.txt"), key=lambda file: file.stat().st_mtime_ns)
    return [file.read_text().splitlines() for file in files]


def test_arrivals_lie_in_order_of_their_slices(spark, tmp_path):
    lines = event_lines(spark, SF_DIR)
    slices = write_arrivals(lines, str(tmp_path), slice_of(5 * DAY), files_per_slice=2)
    files = oldest_first(tmp_path)
    assert slices >= 6 and len(files) == 2 * slices
    assert sorted(sum(files, [])) == sorted(row.log for row in lines.collect())
    spans = []
    for texts in files:
        times = [row.at for row in table(spark, texts).select(event_time().alias("at")).collect()]
        dated = [at for at in times if at is not None]
        assert times == [None] * (len(times) - len(dated)) + sorted(dated)
        spans.append((dated[0], dated[-1]))
    firsts, seconds = spans[::2], spans[1::2]
    for one, two, then in zip(firsts, seconds, firsts[1:]):
        assert max(one[1], two[1]) < then[0]


@pytest.mark.parametrize("lines", [[], ["junk", "", None], [line("a", "01/Jan/2024:00:00:00")]])
def test_few_arrivals(spark, tmp_path, lines):
    assert write_arrivals(table(spark, lines), str(tmp_path / "in"), slice_of()) == 1
    found = live_activity(stream_lines(spark, str(tmp_path / "in"), 1))
    append_available(found, str(tmp_path / "out"), str(tmp_path / "check"), partitions=1)


def test_late_rows_are_dropped_between_batches_of_one_run(spark, tmp_path):
    """Four triggers; a row is late by the watermark that the trigger before its own began with."""
    arrivals = [
        (0, line("a", "01/Jan/2024:00:01:00")),
        (1, line("a", "01/Jan/2024:06:00:00")),
        (2, line("a", "01/Jan/2024:00:02:00", 404)),  # the mark was still at 23:51 the day before
        (2, line("b", "01/Jan/2024:12:00:00")),
        (3, line("a", "01/Jan/2024:00:03:00")),  # late: the mark was at 05:50
        (3, line("a", "01/Jan/2024:05:59:00")),  # before the mark's trigger, in open windows
        (3, line("b", "02/Jan/2024:00:00:00")),
    ]
    frame = spark.createDataFrame(arrivals, "slot int, log string")
    assert write_arrivals(frame, str(tmp_path / "in"), F.col("slot")) == 4
    history = ProgressHistory(spark, str(tmp_path / "history"))
    found = live_activity(stream_lines(spark, str(tmp_path / "in"), 1))
    out = str(tmp_path / "out")
    query = append_available(found, out, str(tmp_path / "check"), "four", partitions=1, history=history)
    batches = history.table().where("input_rows > 0").orderBy("batch_id").collect()
    assert [row.input_rows for row in batches] == [1, 1, 2, 3]
    assert {(row.query, row.run_id, row.unseen) for row in batches} == {("four", str(query.runId), 0)}
    emitted = {
        (row.host, str(row.window_start)[11:16]): row.live_requests
        for row in spark.read.parquet(out).collect()
    }
    assert emitted[("a", "00:00")] == 2 and emitted[("a", "05:55")] == 2
    assert emitted[("b", "12:00")] == 1 and ("b", "00:00") not in emitted
    requests = parse_lines(frame.select("log"))
    last = requests.agg(F.max("timestamp")).scalar()
    late = late_rows(host_activity(requests), spark.read.parquet(out), last).collect()
    missing = {(row.host, str(row.window_start)[11:16]): row.late_requests for row in late}
    assert missing == {("a", "00:00"): 1, ("a", "23:55"): 1}
    dropped = history.table().agg(F.sum("dropped_late")).first()[0]
    assert dropped > 0


def test_history_outlives_the_query_and_its_hundred_reports(spark, tmp_path):
    count = 125
    rows = spark.range(count).select(F.col("id").cast("string").alias("log"), "id")
    write_arrivals(rows, str(tmp_path / "in"), F.col("id"))
    history = ProgressHistory(spark, str(tmp_path / "history"))
    assert history.table().count() == 0
    run = dict(
        path=str(tmp_path / "out"), checkpoint=str(tmp_path / "check"), name="many", history=history
    )
    query = append_available(stream_lines(spark, str(tmp_path / "in"), 1), **run)
    assert len(query.recentProgress) <= 100
    del query
    kept = ProgressHistory(spark, str(tmp_path / "history"))
    batches = kept.table().where("input_rows > 0")
    assert [row.batch_id for row in batches.orderBy("batch_id").collect()] == list(range(count))
    assert batches.agg(F.sum("input_rows"), F.sum("unseen")).first()[:] == (count, 0)
    assert len(list(Path(tmp_path / "history").glob("*.json"))) > 1  # written while it ran
    table(spark, ["more"]).write.mode("append").text(str(tmp_path / "in"))
    append_available(stream_lines(spark, str(tmp_path / "in"), 1), **run)
    before = sorted(map(repr, kept.table().collect()))
    assert len(before) > count and kept.table().select("run_id").distinct().count() == 2
    kept.compact()
    assert sorted(map(repr, kept.table().collect())) == before
    assert len(list(Path(tmp_path / "history").glob("*.json"))) == 1


def test_reports_that_passed_unseen_are_counted(spark, tmp_path):
    def report(number):
        return {
            "id": "q", "runId": "r", "name": None, "batchId": number, "numInputRows": 2,
            "timestamp": f"2024-01-01T00:00:{number:02d}.000Z",
        }

    class Query:
        looks = iter([[0, 1], [0, 1], [5, 6], [6, 7], [6, 7]])

        def awaitTermination(self, seconds):
            self.recentProgress = [report(number) for number in next(self.looks, [6, 7])]
            return self.recentProgress[0]["batchId"] == 6

    history = ProgressHistory(spark, str(tmp_path / "history"))
    history.follow(Query(), every_seconds=0)
    found = history.table().orderBy("batch_id").collect()
    assert [(row.batch_id, row.unseen) for row in found] == [(0, 0), (1, 0), (5, 3), (6, 0), (7, 0)]


def test_a_failing_stream_leaves_its_history(spark, tmp_path):
    table(spark, ["1", "x"]).write.text(str(tmp_path / "in"))
    broken = stream_lines(spark, str(tmp_path / "in")).select(F.raise_error("no").cast("string").alias("log"))
    history = ProgressHistory(spark, str(tmp_path / "history"))
    with pytest.raises(Exception, match="no"):
        append_available(broken, str(tmp_path / "out"), str(tmp_path / "check"), history=history)
    assert history.table().where("input_rows > 0").count() == 0
