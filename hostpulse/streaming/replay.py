"""Feed stored lines to a stream, in the order of their event time.

The order matters: a batch that jumps ahead moves the watermark, and the lines
it jumped over are then late and dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.operators.parsing import event_time
from hostpulse.sources.files import Files
from hostpulse.sources.lines import BLANKS, trimmed

DAY = 86_400


def _copy() -> Column:
    """Tells equal lines apart, so that a range boundary can fall between them."""
    return F.monotonically_increasing_id()


def replay_counts(lines: DataFrame) -> DataFrame:
    """Lines read, sent, and skipped as blank by a replay."""
    text = F.btrim("log", F.lit(BLANKS))
    return lines.agg(
        F.count("*").alias("lines"),
        F.count_if(text != "").alias("sent"),
        F.count_if(text == "").alias("blank"),
    )


def replay_lines(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """Lines by event time, trimmed, without blank ones; lines without a time last.

    With a ``limit`` only the first ones.
    """
    # As columns: a sort evaluates its expressions anew for each comparison.
    keyed = trimmed(lines).select("log", event_time().alias("at"), _copy().alias("copy"))
    ordered = keyed.orderBy(F.asc_nulls_last("at"), "log", "copy")
    return (ordered if limit is None else ordered.limit(limit)).select("log")


def write_ordered(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Text files that each hold one range of event times, sorted.

    Without a number of ``files`` adaptive execution sizes them.
    """
    ranges = [] if files is None else [files]
    (
        lines.select("log", event_time().alias("at"), _copy().alias("copy"))
        .repartitionByRange(*ranges, "at", "log", "copy")
        .sortWithinPartitions("at", "log")
        .select("log")
        .write.mode("overwrite")
        .text(path)
    )


def write_shuffled(lines: DataFrame, path: str, files: int) -> None:
    """Text files that each hold lines of all times, as a feed without order would."""
    lines.select("log").repartition(files).write.mode("overwrite").text(path)


def feed_in_order(
    lines: DataFrame,
    staging: str,
    arrivals: str,
    run: Callable[[], object],
    slice_seconds: int = DAY,
) -> int:
    """Let lines arrive one time slice after the other, with a run after each.

    The lines are stored once by slice. A slice is moved to the arrivals folder
    by a distributed copy, and one run of the stream takes it whole, so the order
    depends neither on file names nor on modification times, and the state
    covers one slice and the open windows. Only the slice numbers, one per
    calendar slice, reach the driver. Lines without a time arrive with the first
    slice: they belong to no window.
    """
    spark = lines.sparkSession
    slot = F.floor(F.unix_seconds(event_time()) / slice_seconds).cast("bigint")
    (
        lines.select("log", slot.alias("slot"))
        .hint("rebalance", "slot")
        .write.mode("overwrite")
        .partitionBy("slot")
        .parquet(staging)
    )
    stored = spark.read.schema("log string, slot bigint").parquet(staging)
    slot = F.col("slot")
    numbers = stored.select(slot).where(slot.isNotNull()).distinct().orderBy(slot).collect()
    turns = [slot == row["slot"] for row in numbers] or [F.lit(False)]
    turns[0] |= slot.isNull()
    for due in turns:
        stored.where(due).select("log").write.mode("append").text(arrivals)
        run()
    return len(turns)


def slice_of(seconds: int = DAY) -> Column:
    """Number of the calendar slice that a line's event time falls into."""
    return F.floor(F.unix_seconds(event_time()) / seconds).cast("bigint")


def write_arrivals(
    lines: DataFrame, path: str, arrival: Column, files_per_slice: int = 1
) -> int:
    """Text files that a bounded stream takes in order of arrival; returns the number of slices.

    ``arrival`` numbers the slice a line arrives in; gaps are closed, and lines
    without a number arrive first. Each slice is dealt over ``files_per_slice`` files
    and sorted by event time in each. A file source takes the oldest files first,
    so the files' times of change are set in order of the slices, a second apart.
    With that many files per trigger, each trigger of one run takes one slice; a
    slice with fewer lines than files leaves some out, and triggers then run ahead.

    One shuffle of the lines; the driver sees the slice numbers and the files' names.
    """
    numbered = lines.select("log", arrival.cast("bigint").alias("slot"))
    numbers = [row["slot"] for row in numbered.select("slot").distinct().collect()]
    numbers = sorted(number for number in numbers if number is not None)
    # One row per slice; a scan away from its place among the slices that occur.
    places = F.create_map(*[F.lit(x) for place, number in enumerate(numbers) for x in (number, place)])
    place = F.coalesce(F.try_element_at(places, "slot"), F.lit(0)) if numbers else F.lit(0)
    share = F.pmod(F.xxhash64("log"), F.lit(files_per_slice))
    part = (place * files_per_slice + share).cast("int")
    (
        numbered.select("log", event_time().alias("at"), part.alias("part"))
        .repartitionById(max(1, len(numbers)) * files_per_slice, "part")
        .sortWithinPartitions("at", "log")
        .select("log")
        .write.mode("overwrite")
        .text(path)
    )
    files = Files(lines.sparkSession)
    # Part files are named in order of their partitions.
    parts = [name for name in files.names(path) if name.startswith("part-")]
    start = files.modified(path) - 1000 * (len(parts) + 1)
    for order, name in enumerate(parts):
        files.set_modified(f"{path}/{name}", start + 1000 * order)
    return max(1, len(numbers))
