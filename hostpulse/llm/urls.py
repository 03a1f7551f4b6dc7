"""URL verdicts by rules, and by character models of accepted and rejected addresses.

DataFrame expressions only.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.llm.store import written

ORDER = 5  # characters of context
BEGIN, END = "\x02", "\x03"  # stand before and behind an address; those in one are like them
_BINS = 100  # per unit of the score, which is cut off at -20 and 20
# A gram and its ratio take about 100 bytes in a broadcast table: at most 60 MB are sent to all tasks.
BROADCAST_GRAMS = 600_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def address(url: Column) -> tuple[Column, Column]:
    """Host and path: between the first ``://``, the next ``/``, ``?`` or ``#``, and the query.

    A-Z of the host become lower case. Both are empty without ``://`` or url.
    """
    begin = F.locate("://", url)
    rest = F.substr(url, begin + 3)
    host = F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase
    )
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    known = F.coalesce(begin > 0, F.lit(False))
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def _ruled(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones the first by text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (-len(rule.text), rule.text), reverse=True):
        text = F.when(_fits(rule), rule.text).otherwise(text)
        verdict = F.when(_fits(rule), rule.verdict).otherwise(verdict)
    return text, verdict


def _grams(addresses: DataFrame) -> DataFrame:
    """A row per character of ``address`` and for the end, with the ORDER characters before it."""
    padded = F.concat(F.lit(BEGIN * ORDER), "address", F.lit(END))
    spread = addresses.withColumn("padded", padded).select(
        "*", F.explode(F.sequence(F.lit(1), F.length("padded") - ORDER)).alias("place")
    )
    gram = F.substr("padded", F.col("place"), F.lit(ORDER + 1))
    return spread.withColumn("gram", gram).drop("padded", "place", "address")


def _smoothed(counts: DataFrame) -> DataFrame:
    """``gram`` and ``llr``, the log ratio of its last character's chances given those before it.

    Each class has a model of every order up to ORDER. Its chance of a character
    is the share seen after the context, mixed with the chance of the next lower
    order by the number of different characters seen there (Witten and Bell); below
    order 0 all characters that occur are equally likely. A group is a context with the
    different characters behind it, so no window or join below has a large one.
    """
    lower = None
    for order in range(ORDER + 1):
        tail = F.substr("gram", F.lit(ORDER + 1 - order), F.lit(order + 1))
        level = (
            counts.groupBy(tail.alias("tail"))
            .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
            .withColumn("context", F.substr("tail", F.lit(1), F.lit(order)))
        )
        of = Window.partitionBy("context")
        for kind in ("allow", "block"):
            level = level.withColumn(f"{kind}_all", F.sum(kind).over(of)).withColumn(
                f"{kind}_kinds", F.sum((F.col(kind) > 0).cast("long")).over(of)
            )
        if lower is None:
            even = F.lit(1.0) / F.count("*").over(of)  # the one context is the empty one
            level = level.withColumn("allow_low", even).withColumn("block_low", even)
        else:
            level = level.withColumn("shorter", F.substr("tail", F.lit(2), F.lit(order))).join(
                lower, "shorter"
            )
        for kind in ("allow", "block"):
            seen, kinds = F.col(f"{kind}_all"), F.col(f"{kind}_kinds")
            mixed = (F.col(kind) + kinds * F.col(f"{kind}_low")) / (seen + kinds)
            level = level.withColumn(
                f"{kind}_p", F.when(seen > 0, mixed).otherwise(F.col(f"{kind}_low"))
            )
        lower = written(
            level.select(
                F.col("tail").alias("shorter"),
                F.col("allow_p").alias("allow_low"),
                F.col("block_p").alias("block_low"),
            )
        )
    return lower.select(
        F.col("shorter").alias("gram"), F.ln(F.col("allow_low") / F.col("block_low")).alias("llr")
    )


def _threshold(scores: DataFrame) -> DataFrame:
    """One row ``cut``: the score from which on addresses are accepted.

    Of all cuts between bins of 1 / _BINS it is the one with the best sum of the
    rates of accepted addresses at or above it and rejected ones below it, of
    equally good ones the lowest, in the middle of the gap between its two bins.
    0 if one of the two kinds is missing.
    """
    place = F.greatest(F.least(F.floor(F.col("score") * _BINS), F.lit(20 * _BINS)), F.lit(-20 * _BINS))
    bins = (
        scores.where("verdict IS NOT NULL")
        .groupBy(place.cast("long").alias("bin"))
        .agg(
            F.count_if(F.col("verdict") == "allow").alias("allow"),
            F.count_if(F.col("verdict") == "block").alias("block"),
        )
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 4001 bins at most
    every = Window.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    gain = F.coalesce(F.sum("block").over(below), F.lit(0)) / F.sum("block").over(
        every
    ) - F.coalesce(F.sum("allow").over(below), F.lit(0)) / F.sum("allow").over(every)
    best = (
        bins.select("bin", F.try_divide(F.lit(1), F.sum("block").over(every)).alias("some"), "allow", "block")
        .where("some IS NOT NULL")
        .withColumn("total", F.sum("allow").over(every))
        .where("total > 0")
        .select(
            "bin",
            gain.alias("gain"),
            F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, "bin").alias("from"),
        )
    )
    middle = (F.col("bin") + F.col("from")) / (2 * _BINS)
    chosen = best.agg(F.max_by(middle, F.struct("gain", -F.col("bin"))).alias("cut"))
    return chosen.select(F.coalesce("cut", F.lit(0.0)).alias("cut"))


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` for every row of ``pages``.

    The longest rule whose host is the url's or a parent of it, and whose path
    begins the url's, gives the verdict. Other urls are judged by their ``score``:
    the log ratio of their characters' chances, among addresses that rules accept
    against addresses that rules reject, per character, from models that learn
    from four fifths of the ruled addresses (by a hash of the url) and are
    calibrated on the last fifth; ``allow`` at or above the calibrated cut.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is judged as an empty address. Null and repeated ``page_id`` stay as they
    are, one row each. Without ruled addresses of both kinds the cut is 0 and
    all scores are 0, so unruled urls are allowed. An empty table gives no rows;
    other columns are not read.

    Equal addresses are counted first and become grams once, however many rows have them.
    The models know every character and grow with the addresses. While they have at most
    BROADCAST_GRAMS grams they go to all tasks, and an address is scored where its grams
    are made; beyond that grams and models meet in a shuffle, which carries a digest of
    the address. Both give the same rows.
    """
    host, path = address(F.col("url"))
    rule, verdict = _ruled(rules)
    part = F.conv(F.substr(F.md5(F.coalesce("url", F.lit(""))), F.lit(1), F.lit(6)), 16, 10)
    judged = written(
        pages.select("page_id", "url")
        .select("page_id", "url", host.alias("host"), path.alias("path"))
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            verdict.alias("verdict"),
            (part.cast("bigint") % 5).alias("part"),
            F.unhex(F.md5(F.concat("host", "path"))).alias("key"),
        )
    )

    def learnt(kind: str) -> Column:
        return F.count_if((F.col("part") > 0) & (F.col("verdict") == kind)).alias(kind)

    addresses = written(
        judged.groupBy("key", F.concat("host", "path").alias("address")).agg(
            learnt("allow"), learnt("block")
        )
    )
    grams = _grams(addresses)
    counts = written(
        grams.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    )
    model = _smoothed(counts)
    if counts.count() <= BROADCAST_GRAMS:
        model = F.broadcast(model)
    scores = written(
        grams.select("key", "gram").join(model, "gram").groupBy("key").agg(F.avg("llr").alias("score"))
    )
    # Rounded, because the last bits of a mean depend on the order of addition.
    scored = written(judged.join(scores, "key").withColumn("score", F.round("score", 9)))
    cut = _threshold(scored.where("part = 0")).first()[0]
    judgement = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", judgement).alias("verdict"), "score"
    )
