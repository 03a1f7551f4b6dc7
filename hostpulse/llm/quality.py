"""Quality scores: random Fourier features, ridge by normal equations, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, written

FOLDS = 5  # rows of fold 0 are never learnt from
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_ENDS = [ord(mark) for mark in ".!?"]
_PAUSES = [ord(mark) for mark in ",;:"]
_SYMBOLS = [ord(mark) for mark in "#$%&*+/<=>@\\^_`{|}~"]
STATISTICS = 20


def text_statistics(text: str | None) -> list[float]:
    """What a whole text looks like, as ``STATISTICS`` numbers; all 0 if it is null or empty."""
    if not text:
        return [0.0] * STATISTICS
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    share = np.bincount(data, minlength=256) / len(data)
    words = text.split()
    number = max(len(words), 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    if not len(lengths):
        lengths = np.zeros(1, dtype=np.int64)
    pairs = len(set(zip(words, words[1:])))
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        share[_UPPER].sum(),
        share[_LOWER].sum(),
        share[_DIGIT].sum(),
        share[128:].sum(),
        share[32] + share[9] + share[10],
        share[_ENDS].sum(),
        share[_PAUSES].sum(),
        share[_SYMBOLS].sum(),
        share[ord("!")],
        share[ord("|")],
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(counts) / number,
        max(counts.values(), default=0) / number,
        pairs / number,
        repeats / number + (1 - len(set(lines)) / len(lines)),
    ]


@dataclass(frozen=True)
class Fourier:
    """Features whose inner products approximate a Gaussian kernel of scaled statistics."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, statistics: np.ndarray) -> np.ndarray:
        scaled = np.clip((statistics - self.mean) / self.scale, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases)
        features = waves * np.sqrt(2 / len(self.phases))
        return np.hstack([features, np.ones((len(features), 1))])


@dataclass(frozen=True)
class QualityModel:
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def __call__(self, statistics: np.ndarray) -> np.ndarray:
        raw = self.fourier(statistics) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.values), 0, 1)


def isotonic(place: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple:
    """Knots and values of the non-decreasing fit to ``positive / total`` along ``place``.

    Neighbouring bins are pooled while a later one has the lower rate; a pool's
    knot is its mean place.
    """
    pools: list[list[float]] = []
    for x, n, p in zip(place, total, positive):
        pools.append([x * n, n, p])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    knots = np.array([x / n for x, n, _ in pools])
    return knots, np.array([p / n for _, n, p in pools])


_STATED = pa.schema([("doc_id", pa.int64()), ("statistics", pa.list_(pa.float64()))])


def _stated(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield doc_id, [float(value) for value in text_statistics(text)]


def statistics_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``statistics`` of every row."""
    return map_rows(docs.select("doc_id", "text"), _STATED, _stated)


def fold_of(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def _blocks(rows: Iterable[tuple], size: int = 2048) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


_SUMS = pa.schema(
    [("fold", pa.int64()), ("place", pa.int64()), ("sums", pa.list_(pa.float64()))]
)


def _normal_equations(sample: DataFrame, fourier: Fourier) -> dict[int, tuple]:
    """Per fold the sums of z z' and z y, added up within partitions and then across them."""
    width = len(fourier.phases) + 1

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        for block in _blocks(found):
            folds = np.array([row[0] for row in block])
            target = np.array([row[1] for row in block], dtype=np.float64)
            features = fourier(np.array([row[2] for row in block]))
            for fold in np.unique(folds).tolist():
                own = features[folds == fold]
                both = np.hstack([own, target[folds == fold, None]])
                sums[fold] = sums.get(fold, 0) + own.T @ both
        for fold, matrix in sums.items():
            for place in range(width):
                yield fold, place, matrix[place].tolist()

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["sums"].to_list()), axis=0)
        return pd.DataFrame(
            {"fold": group["fold"][:1], "place": group["place"][:1], "sums": [total]}
        )

    parts = map_rows(sample.select("fold", "quality", "statistics"), _SUMS, rows)
    totals = parts.groupBy("fold", "place").applyInPandas(added, parts.schema)
    matrices: dict[int, np.ndarray] = {}
    for fold, place, sums in totals.collect():
        matrices.setdefault(fold, np.zeros((width, width + 1)))[place] = sums
    return {fold: (matrix[:, :-1], matrix[:, -1]) for fold, matrix in matrices.items()}


def _solved(equations: list[tuple], ridge: float) -> np.ndarray:
    left = sum(matrix for matrix, _ in equations)
    right = sum(vector for _, vector in equations)
    weight = np.full(len(left), ridge)
    weight[-1] = 1e-6  # the constant is hardly held back
    return np.linalg.solve(left + np.diag(weight), right)


_RAW = pa.schema([("bin", pa.int64()), ("quality", pa.int32())])
_BINS = 1000  # per unit of the raw score, which is cut off at -1 and 2


def fit_quality(
    stated: DataFrame,
    labels: DataFrame,
    max_rows: int = 200_000,
    features: int = 256,
    width: float = 3.0,
    ridge: float = 0.3,
) -> QualityModel | None:
    """A model of ``labels.quality`` from the statistics in ``stated``.

    Rows whose id is null or falls into fold 0 are not learnt from, nor are rows
    without a label. Beyond ``max_rows`` labelled documents a sample of about so
    many is taken by a hash of the id. The normal equations of four folds add up
    to the ridge fit; left out one at a time they give each fold scores from the
    others, on which the isotonic calibration is fitted. ``width`` is the kernel's,
    in standard deviations. Returns None without any label to learn from.
    """
    marks = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .withColumn("fold", fold_of())
        .where("fold <> 0")
    )
    total = marks.count()
    if not total:
        return None
    share = min(1.0, max_rows / total)
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = written(stated.join(chosen, "doc_id").select("fold", "quality", "statistics"))
    each = [F.col("statistics")[place] for place in range(STATISTICS)]
    moments = sample.agg(
        *(F.avg(one) for one in each), *(F.stddev_pop(one) for one in each)
    ).first()
    if moments[0] is None:
        return None
    moments = np.array(moments, dtype=np.float64)
    random = np.random.default_rng(7)
    fourier = Fourier(
        mean=moments[:STATISTICS],
        scale=np.maximum(moments[STATISTICS:], 1e-6),
        directions=random.normal(size=(STATISTICS, features)) / width,
        phases=random.uniform(0, 2 * np.pi, features),
    )
    equations = _normal_equations(sample, fourier)
    weights = _solved(list(equations.values()), ridge)
    others = {
        fold: _solved([own for other, own in equations.items() if other != fold], ridge)
        if len(equations) > 1
        else weights
        for fold in equations
    }

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for block in _blocks(found):
            raw = fourier(np.array([row[2] for row in block]))
            for (fold, quality, _), own in zip(block, raw):
                score = min(max(float(own @ others[fold]), -1.0), 2.0)
                yield round(score * _BINS), quality

    bins = (
        map_rows(sample, _RAW, rows)
        .groupBy("bin")
        .agg(F.count("*").alias("total"), F.sum("quality").alias("positive"))
        .orderBy("bin")
        .collect()  # at most 3 * _BINS + 1 rows
    )
    place = np.array([row.bin / _BINS for row in bins])
    knots, values = isotonic(place, [row.total for row in bins], [row.positive for row in bins])
    return QualityModel(fourier, weights, knots, values)


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` for every row of ``docs``.

    ``score`` (0 to 1) is the calibrated chance of quality 1, from statistics of
    the whole text alone; ``held_out`` says whether the row's fold, crc32 of its
    id as text modulo 5, is 0, so that its label was not learnt from. A null
    text is empty, and an empty one is scored like any other. A null id has a
    null ``held_out`` and is never learnt from; repeated rows are scored each.
    Without labels all scores are null. ``settings`` go to :func:`fit_quality`.

    Texts are read once, into a written table of statistics.
    """
    stated = written(statistics_of(docs))
    model = fit_quality(stated, labels, **settings)

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for block in _blocks(found):
            ids = [row[0] for row in block]
            if model is None:
                yield from ((doc_id, None) for doc_id in ids)
            else:
                scores = model(np.array([row[1] for row in block]))
                yield from zip(ids, scores.tolist())

    scored = map_rows(stated, _SCORED, rows)
    return scored.select("doc_id", (fold_of() == 0).alias("held_out"), "score")
