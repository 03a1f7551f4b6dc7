"""Where registered queries keep the tables they build."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from hostpulse.operators.live import against_baseline, host_activity, live_findings
from hostpulse.operators.parsing import parse_lines
from hostpulse.plans.batch import run_batch
from hostpulse.plans.feed import burst_lines, event_lines
from hostpulse.sources.files import Files
from hostpulse.sources.tables import Layers
from hostpulse.sources.versions import Versions


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder the cluster shares for such tables.

    That is ``spark.checkpoint.dir``; without it the warehouse, which every session has.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("spark.sql.warehouse.dir", None)
    return f"{folder}/hostpulse/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# What is built, by its input: a root of versions, or a folder and what it held.
_built: dict[str, str | tuple] = {}


def _key(spark: SparkSession, sf_dir: str, what: str = "layers") -> str:
    """Names what is built, and the state of its input: files, bytes and time of change."""
    files, path = Files(spark), f"{sf_dir}/events.parquet"
    state = files.summary(path)
    return f"{shared_folder(spark)} {sf_dir} {what} {state} {state and files.modified(path)}"


def kept_folder(
    spark: SparkSession, sf_dir: str, what: str, build: Callable[[str], None]
) -> str:
    """The folder that ``build`` has filled for this state of the input, now or before.

    It is filled again if it no longer has the files and bytes it had then.
    """
    key, files = _key(spark, sf_dir, what), Files(spark)
    folder, held = _built.get(key, (None, None))
    if folder is None or files.summary(folder) != held:
        folder = f"{fresh_folder(spark)}/{what}"
        build(folder)
        _built[key] = folder, files.summary(folder)
    return folder


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Let the next :func:`stored_layers` build anew, as after a change of the tables."""
    _built.pop(_key(spark, sf_dir), None)


def stored_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """All layers over the tables in ``sf_dir``, built once per application.

    Queries over stored layers share them, as readers of a warehouse do: a
    hundred reads of the findings must not mean a hundred scans of the log. A
    build is a version of its own, published when whole. It is built again when the
    input has changed or a layer is not what its manifest says. To know that, the
    store is asked for sums; no job runs and nothing is listed file by file here.
    """
    key = _key(spark, sf_dir)
    if key in _built:
        versions = Versions(spark, _built[key])
        if versions.name() and not versions.damaged():
            return versions.current()
        del _built[key]
    versions = Versions(spark, fresh_folder(spark))
    with versions.building() as layers:
        run_batch(event_lines(spark, sf_dir), layers)
        scored = against_baseline(
            host_activity(parse_lines(burst_lines(spark, sf_dir))),
            layers.load("ip_baselines"),
            layers.load("global_stats"),
        )
        layers.save(live_findings(scored), "live_anomalies")
    _built[key] = versions.root
    return versions.current()
