"""Ordered rules: the first predicate that is true names the row.

Rules are data (label and SQL predicate), so a rule set can be printed,
tested and changed without touching the operators. A NULL comparison is not a match.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severities from worst to mildest.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


class Rule(NamedTuple):
    label: str
    test: str


class LiveRules(NamedTuple):
    """One way to judge live traffic: how to name it and how bad it is."""

    kinds: Sequence[Rule]
    severities: Sequence[Rule]
    mildest: str
    unknown_expects_nothing: bool


def first_match(rules: Sequence[Rule], otherwise: str | None = None) -> Column:
    arms = " ".join(f"WHEN {rule.test} THEN '{rule.label}'" for rule in rules)
    rest = f" ELSE '{otherwise}'" if otherwise else ""
    return F.expr(f"CASE {arms}{rest} END")


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet some rule, with its label as ``anomaly_type``."""
    return df.withColumn("anomaly_type", first_match(rules)).where("anomaly_type IS NOT NULL")


def severity_rank(column: str = "severity") -> Column:
    """1 for the worst severity up to 4, 5 for anything else."""
    place = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col(column))
    return F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(SEVERITIES) + 1))


def band(value: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    """Name of the first step whose bound the value exceeds."""
    name = F.lit(otherwise)
    for bound, label in reversed(steps):
        name = F.when(value > bound, label).otherwise(name)
    return name


# Thresholds and labels of the rule sets below.

HOURLY_RULES = (
    Rule("TRAFFIC_SPIKE", "request_z_score > 2.5"),
    Rule("UNUSUAL_QUIET", "request_z_score < -2.5"),
    Rule("ERROR_SURGE", "error_rate_z_score > 2.5"),
    Rule("SUDDEN_HOH_JUMP", "request_change_pct > 100"),
)

HOST_RULES = (
    Rule("BOT_SCRAPER", "volume_z > 3 AND breadth_z > 3"),
    Rule("ENDPOINT_SCANNER", "error_z > 3 AND volume_z > 1"),
    Rule("BULK_DOWNLOADER", "bytes_z > 3 AND volume_z < 1"),
    Rule("HIGH_ERROR_IP", "error_rate_pct > 20"),
    Rule("GENERALLY_SUSPICIOUS", "suspicion_score > 2.5"),
)

SUSPICION_WEIGHTS = {"volume_z": 0.3, "error_z": 0.3, "breadth_z": 0.25, "bytes_z": 0.15}

ENDPOINT_RULES = (
    Rule("MOSTLY_BROKEN_ENDPOINT", "not_found_rate > 50"),
    Rule("ATTACKED_ENDPOINT", "`404_z` > 3 AND hits_z > 2"),
    Rule("UNUSUALLY_HEAVY_PAYLOAD", "bytes_z > 3"),
    Rule("HOTSPOT_ENDPOINT", "hits_z > 4 AND not_found_rate < 1"),
)

BATCH_SEVERITIES = (
    Rule("CRITICAL", "z_score >= 6"),
    Rule("HIGH", "z_score >= 4"),
    Rule("MEDIUM", "z_score >= 2.5"),
)

KNOWN = "batch_total_requests IS NOT NULL"
UNKNOWN = "batch_total_requests IS NULL"

# The rule set of the scheduled live job.
JOB_RULES = LiveRules(
    kinds=(
        Rule("PERSONAL_SPIKE", f"{KNOWN} AND rate_multiplier > 5"),
        Rule("UNKNOWN_IP_SURGE", f"{UNKNOWN} AND global_z_score > 3"),
        Rule("LIVE_ERROR_SURGE", "live_error_rate > 30"),
        Rule("NEW_SCANNING_BEHAVIOUR", "live_404s > 20 AND batch_error_rate < 5"),
    ),
    severities=(
        Rule("CRITICAL", "rate_multiplier > 10"),
        Rule("HIGH", "rate_multiplier > 5"),
        Rule("CRITICAL", "live_error_rate > 50"),
    ),
    mildest="MEDIUM",
    unknown_expects_nothing=False,
)

# The rule set of the exploratory replay: finer labels, unknown hosts expect no traffic.
EXPLORER_RULES = LiveRules(
    kinds=(
        Rule("PERSONAL_SPIKE", f"{KNOWN} AND rate_multiplier > 10"),
        Rule("SUSPICIOUS_ACTIVITY", f"{KNOWN} AND rate_multiplier > 5"),
        Rule("UNKNOWN_IP_SURGE", f"{UNKNOWN} AND global_z_score > 3"),
        Rule("LIVE_ERROR_SURGE", "live_error_rate > 30"),
        Rule("SCANNING_BEHAVIOUR", "live_404s > 20 AND batch_error_rate < 5"),
    ),
    severities=(
        Rule("CRITICAL", "rate_multiplier > 15 OR live_error_rate > 60"),
        Rule("HIGH", "rate_multiplier > 8 OR global_z_score > 4"),
        Rule("MEDIUM", "rate_multiplier > 5 OR live_error_rate > 30"),
    ),
    mildest="LOW",
    unknown_expects_nothing=True,
)
