"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, written

_WORD = re.compile(r"[^\W\d_]+")
GRADES = 2  # above none


def text_features(text: str | None) -> Counter:
    """Occurrences of each word, and of the first four letters of longer ones (with a ``*``)."""
    words = Counter(_WORD.findall((text or "").lower()))
    stems: Counter = Counter()
    for word, count in words.items():
        if len(word) > 4:
            stems[word[:4] + "*"] += count
    return words + stems


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade > k) is the logistic of ``weights . x - cuts[k]``; all cuts share the weights."""

    terms: tuple[str, ...]
    weights: np.ndarray
    cuts: np.ndarray

    def above(self, values: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, from the weighted sums of documents."""
        return _logistic(values[:, None] - self.cuts[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(
    row: np.ndarray,
    column: np.ndarray,
    value: np.ndarray,
    grades: np.ndarray,
    terms: tuple[str, ...],
    ridge: float = 2e-4,
    steps: int = 400,
) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the full sparse matrix.

    ``value[i]`` stands at (``row[i]``, ``column[i]``). Cuts stay in order: the
    first is free, each further one is the one before plus an exponential.
    """
    documents, width = len(grades), len(terms)
    loose = np.zeros(width + GRADES)
    loose[width] = 2.0
    first, second = np.zeros_like(loose), np.zeros_like(loose)
    for step in range(1, steps + 1):
        weights, gaps = loose[:width], np.exp(loose[width + 1 :])
        cuts = loose[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        scores = np.bincount(row, value * weights[column], minlength=documents)
        above = _logistic(scores[:, None] - cuts[None, :])
        # P(grade) = P(> grade - 1) - P(> grade); its log's slope by each of the two.
        upper = np.hstack([np.ones((documents, 1)), above])
        lower = np.hstack([above, np.zeros((documents, 1))])
        place = np.arange(documents), grades
        share = np.maximum(upper[place] - lower[place], 1e-12)
        rise, fall = upper * (1 - upper), lower * (1 - lower)
        by_upper, by_lower = rise[place] / share, fall[place] / share
        by_score = by_lower - by_upper  # of the negative log likelihood
        slope = np.zeros_like(loose)
        slope[:width] = np.bincount(column, value * by_score[row], minlength=width) / documents
        slope[:width] += ridge * weights
        by_cut = np.zeros(GRADES)
        np.add.at(by_cut, grades[grades > 0] - 1, by_upper[grades > 0])
        np.add.at(by_cut, grades[grades < GRADES], -by_lower[grades < GRADES])
        by_cut /= documents
        slope[width] = by_cut.sum()
        slope[width + 1 :] = gaps * np.cumsum(by_cut[::-1])[::-1][1:]
        first += 0.1 * (slope - first)
        second += 0.001 * (slope**2 - second)
        loose -= (
            0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        )
    gaps = np.exp(loose[width + 1 :])
    return OrdinalModel(
        terms, loose[:width].copy(), loose[width] + np.concatenate([[0.0], np.cumsum(gaps)])
    )


_FEATURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("toxic", pa.int32()),
        ("terms", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def _featured(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, toxic, text in rows:
        found = text_features(text)
        yield doc_id, toxic, list(found), list(found.values())


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_terms: int = 3_000,
    min_docs: int = 4,
) -> OrdinalModel | None:
    """A model of grades 0 (none), 1 and 2, from the ``toxic`` column of ``labels``.

    Learns from a sample of about ``max_rows`` labelled documents, chosen by a
    hash of their id, and all of them if there are fewer; equal texts count once.
    The vocabulary is the ``max_terms`` features, each in ``min_docs`` documents or
    more, whose share among toxic documents differs most from that among others,
    in standard errors. Labels know no grade: a toxic document has grade 2 if it
    holds more than the median number of occurrences of features that mark
    toxic documents, else 1. Rows without a label or an id are left out. Returns
    None if there are no labels of both kinds, and then nothing can be scored.
    """
    marks = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    total = marks.count()
    if not total:
        return None
    share = min(1.0, max_rows / total)
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .groupBy(F.xxhash64("text").alias("same"))
        .agg(F.min(F.struct("doc_id", "toxic", "text")).alias("row"))
        .select("row.*")
    )
    sample = written(map_rows(texts, _FEATURES, _featured, batch=100))
    sizes = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return None
    rate = (F.col("marked") + F.col("unmarked")) / (toxic + clean)
    gap = F.col("marked") / toxic - F.col("unmarked") / clean
    ranked = (
        sample.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("marked"), F.sum(1 - F.col("toxic")).alias("unmarked"))
        .where(F.col("marked") + F.col("unmarked") >= min_docs)
        .withColumn("z", gap / F.sqrt(rate * (1 - rate + 1e-9) * (1 / toxic + 1 / clean)))
        .orderBy(F.abs("z").desc(), "term")
        .limit(max_terms)
        .select("term", "z", "unmarked")
        .collect()
    )
    if not ranked:
        return None
    terms = tuple(row.term for row in ranked)
    # Features that hardly any other document holds tell how toxic a toxic one is.
    telling = {row.term for row in ranked if row.z > 4 and row.unmarked <= 0.001 * clean}
    known = _restricted(sample, terms)
    rows = known.collect()
    place = {term: number for number, term in enumerate(terms)}
    row_of, column_of, value_of, exposure, flags = [], [], [], [], []
    for number, found in enumerate(rows):
        flags.append(found.toxic)
        exposure.append(sum(c for t, c in zip(found.terms, found.counts) if t in telling))
        row_of += [number] * len(found.terms)
        column_of += [place[term] for term in found.terms]
        value_of += found.counts
    flags, exposure = np.array(flags), np.array(exposure)
    middle = np.median(exposure[flags == 1])
    grades = np.where(flags == 1, np.where(exposure > middle, 2, 1), 0)
    return fit_ordinal(
        np.array(row_of, dtype=np.int64),
        np.array(column_of, dtype=np.int64),
        1 + np.log(np.array(value_of, dtype=np.float64)),
        grades,
        terms,
    )


def _restricted(sample: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """``toxic`` with the ``terms`` and ``counts`` that are among the given terms."""
    wanted = frozenset(terms)

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, toxic, names, counts in found:
            kept = [(name, count) for name, count in zip(names, counts) if name in wanted]
            yield doc_id, toxic, [name for name, _ in kept], [count for _, count in kept]

    return map_rows(sample, _FEATURES, rows)


def _weighted(text: str | None, weights: dict[str, float]) -> float:
    score = 0.0
    for term, count in text_features(text).items():
        weight = weights.get(term)
        if weight is not None:
            score += weight * (1 + math.log(count))
    return score


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("severity", pa.float64()),
        ("p_toxic", pa.float64()),
        ("grade", pa.int32()),
        ("toxic", pa.bool_()),
    ]
)


def score_toxicity(docs: DataFrame, model: OrdinalModel | None, cut: float = 0.5) -> DataFrame:
    """``doc_id``, ``severity``, ``p_toxic``, ``grade`` and ``toxic`` for every row of ``docs``.

    ``severity`` is the expected grade, 0 to 2; ``p_toxic`` the chance of a grade
    above 0; ``toxic`` whether that is ``cut`` or more; ``grade`` the most likely
    grade above 0 for a toxic document, else 0. All words of the whole text count.
    A null or empty text scores as one without features. Without a model all
    scores are null and no document is toxic. One pass, no shuffle.
    """

    def rows(texts: Iterable[tuple]) -> Iterator[tuple]:
        if model is None:
            for doc_id, _ in texts:
                yield doc_id, None, None, 0, False
            return
        weights = dict(zip(model.terms, model.weights.tolist()))
        for doc_id, text in texts:
            above = model.above(np.array([_weighted(text, weights)]))[0]
            toxic = bool(above[0] >= cut)
            likely = above - np.append(above[1:], 0.0)
            grade = 1 + int(likely.argmax()) if toxic else 0
            yield doc_id, float(above.sum()), float(above[0]), grade, toxic

    return map_rows(docs.select("doc_id", "text"), _SCORED, rows)


def without_toxic(docs: DataFrame, model: OrdinalModel | None, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`score_toxicity` does not call toxic, with all columns.

    Rows are judged where they are, so no text is shuffled; a column of any name
    may stand beside ``text``.
    """
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        weights = dict(zip(model.terms, model.weights.tolist()))
        scores = np.array([_weighted(text, weights) for text in texts])
        return pd.Series(model.above(scores)[:, 0] < cut)

    return docs.where(clean(F.col("text")))
