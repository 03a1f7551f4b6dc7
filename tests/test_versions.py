"""Versions of stored layers: whole for every reader, through rebuilds, failures and sweeps."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostpulse.plans.batch import rebuild
from hostpulse.plans.feed import burst_lines, event_lines
from hostpulse.sources.files import Files
from hostpulse.sources.lines import stream_lines
from hostpulse.sources.versions import NothingPublished, Versions
from hostpulse.streaming.jobs import run_live_versioned

SF_DIR = "/root/testdata/sf0.001"


def put(versions, rows):
    """A small version: as many lines as hours, so that a mixture would show."""
    with versions.building() as layers:
        lines = versions.spark.range(rows)
        layers.save(lines.selectExpr("string(id) AS log"), "bronze")
        stats = lines.selectExpr("double(id) AS global_mean", f"double({rows}) AS global_stddev")
        layers.save(stats, "global_stats")
    return versions.name()


def seen(layers):
    return layers.load("bronze").count(), layers.load("global_stats").count()


@pytest.fixture
def versions(spark, tmp_path):
    return Versions(spark, str(tmp_path / "root"))


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    files, path = Files(spark), str(tmp_path / "a" / "note")
    assert files.read(path) is None and files.summary(path) is None and files.names(path) == []
    for text in ("one", "", "zwei ü"):
        files.write(path, text)
        assert files.read(path) == text
    assert files.names(str(tmp_path / "a")) == ["note"]
    files.delete(path)
    assert not files.exists(path)


def test_nothing_is_read_before_it_is_published(versions):
    for read in (versions.current, versions.damaged, lambda: versions.pinned().__enter__()):
        with pytest.raises(NothingPublished):
            read()
    with pytest.raises(RuntimeError), versions.building() as layers:
        layers.save(versions.spark.range(3).selectExpr("string(id) AS log"), "bronze")
        raise RuntimeError("half way")
    assert versions.name() is None and Files(versions.spark).names(f"{versions.root}/versions") == []


def test_a_failed_build_leaves_the_published_one(versions):
    name = put(versions, 5)
    with pytest.raises(RuntimeError), versions.building() as layers:
        layers.save(versions.spark.range(9).selectExpr("string(id) AS log"), "bronze")
        raise RuntimeError("half way")
    assert versions.name() == name and seen(versions.current()) == (5, 5)


def test_readers_see_whole_versions_through_rebuilds(versions):
    """Reads go on while two builds replace what they read, one after the other."""
    put(versions, 3)
    found, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            with versions.pinned() as layers:
                found.append(seen(layers))

    reader = threading.Thread(target=read)
    reader.start()
    with versions.pinned() as first:
        try:
            for rows in (40, 500):
                put(versions, rows)
                versions.sweep(keep=0)
            assert seen(first) == (3, 3)
        finally:
            stop.set()
            reader.join()
    assert set(found) <= {(3, 3), (40, 40), (500, 500)} and len(found) > 2
    assert seen(versions.current()) == (500, 500)


def test_sweep_waits_for_readers_and_keeps_what_it_is_told(versions):
    files = Files(versions.spark)
    names = [put(versions, rows) for rows in (1, 2, 3, 4)]
    with versions.pinned() as layers:
        assert layers.root.endswith(names[3])
        fifth = put(versions, 5)
        assert versions.sweep(keep=1) == names[:3]
        assert versions.sweep(keep=0) == [] and seen(layers) == (4, 4)
        # A lease that nobody can hold any more does not count.
        for lease in files.names(f"{versions.root}/leases/{names[3]}"):
            files.set_modified(f"{versions.root}/leases/{names[3]}/{lease}", 1_000_000)
        assert versions.sweep(keep=0) == [names[3]]
    assert versions.sweep(keep=0) == [] and versions.name() == fifth
    assert files.names(f"{versions.root}/versions") == [fifth]


def test_loss_of_one_file_is_noticed(versions):
    name = put(versions, 50)
    assert versions.damaged() == []
    part = next(Path(versions.current().path("bronze")).glob("part-*.parquet"))
    kept = part.read_bytes()
    part.unlink()
    assert versions.damaged() == ["bronze"]
    part.write_bytes(kept[:-1])
    assert versions.damaged(name) == ["bronze"]
    part.write_bytes(kept)
    assert versions.damaged() == []


def test_live_job_keeps_its_baseline_through_a_rebuild(spark, versions, tmp_path, monkeypatch):
    lines = event_lines(spark, SF_DIR)
    first = rebuild(lines, versions)
    arrivals = str(tmp_path / "arrivals")
    burst_lines(spark, SF_DIR).write.text(arrivals)

    from hostpulse.streaming import jobs

    started = jobs.append_available

    def meanwhile(*args, **settings):
        """The batch job publishes and sweeps between planning the stream and running it."""
        assert rebuild(lines.where(F.col("log").contains("200")), versions) != first
        assert first not in versions.sweep(keep=0)
        return started(*args, **settings)

    monkeypatch.setattr(jobs, "append_available", meanwhile)
    run_live_versioned(stream_lines(spark, arrivals), versions, partitions=2)
    found = versions.live.load("live_anomalies")
    hosts = Versions(spark, versions.root)._layers(first).load("ip_baselines")
    known = found.where("batch_total_requests IS NOT NULL").select("host", "batch_total_requests")
    assert known.count() > 0
    assert known.distinct().join(hosts, ["host", "batch_total_requests"], "left_anti").count() == 0
    assert versions.sweep(keep=0) == [first]
