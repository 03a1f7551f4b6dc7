"""Hard negatives: exact integer scores, only where stored angles leave room for them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, written

SCALE = 256
SCORE_LIMIT = 1 << 56  # of a row with itself; a percentage of any score then fits a long
_EXACT = 1 << 53  # products of norms below it: double sums of integer products are exact
_EPS = 4e-6  # radians: far above what arc cosines and 32-bit angles are rounded by
_LIST, _ASK, _SLICE = 2048, 8192, 128  # rows and askers of a task's pair of blocks; askers at once
_CLOSEST = 6  # an asker's closest references, used row by row
_NEAR = 2  # cells that an asker searches first


# Angles


def angles_to(vectors: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angle of each row of ``vectors`` to each unit vector of ``refs``; 0 for a zero vector."""
    norms = np.linalg.norm(vectors, axis=1)
    cosines = vectors @ refs.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1.0, 1.0)), 0.0)


def angle_interval(one: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """Between which two angles a vector lies from others, over the references of the last axis.

    ``one`` has its angles to them, ``low`` and ``high`` the least and largest of
    the others. Angles obey the triangle inequality: none is less than the
    difference of the two angles to a reference, or more than their sum (on the
    sphere: than the full circle less their sum).
    """
    least = np.maximum(np.maximum(one - high, low - one), 0.0).max(axis=-1, initial=0.0)
    straight = np.where(one + high <= math.pi, one + high, math.pi)
    round_ = np.where(one + low >= math.pi, 2 * math.pi - one - low, math.pi)
    most = np.minimum(straight, round_).min(axis=-1, initial=math.pi)
    return np.maximum(least - _EPS, 0.0), np.minimum(most + _EPS, math.pi)


def score_bounds(least, most, low_norms, high_norms) -> tuple:
    """Bounds, safe against rounding, on scores at angles from ``least`` to ``most``."""
    top, bottom = np.cos(least), np.cos(most)
    high = np.where(top > 0, high_norms, low_norms) * top
    low = np.where(bottom > 0, low_norms, high_norms) * bottom
    slack = 1e-9 * high_norms + 1
    return low - slack, high + slack


def fit_references(sample: np.ndarray, number: int, rounds: int = 6) -> np.ndarray:
    """``number`` unit vectors: rows far from each other, moved to the middle of those around."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    refs, closest = [units[0]], units @ units[0]
    while len(refs) < min(number, len(units)) and closest.min() < 1 - 1e-9:
        refs.append(units[closest.argmin()])
        closest = np.maximum(closest, units @ refs[-1])
    refs = np.stack(refs)
    for _ in range(rounds):
        sums = np.zeros_like(refs)
        np.add.at(sums, (units @ refs.T).argmax(axis=1), units)
        lengths = np.linalg.norm(sums, axis=1)
        moved = lengths > 1e-9
        refs[moved] = sums[moved] / lengths[moved, None]
    return refs


# Rows as stored: whole numbers, angles and cell

_ROW = [
    ("vec_id", pa.int64()),
    ("label", pa.int64()),
    ("mark", pa.int64()),
    ("width", pa.int64()),
    ("cell", pa.int64()),
    ("norm", pa.float64()),
    ("whole", pa.binary()),
    ("angles", pa.binary()),
]
_STORED = pa.schema(_ROW)
_NAMES = [name for name, _ in _ROW]


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, each repeated one once, with a mark of their content."""
    vector = F.col("vector")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.aggregate(
        vector, F.lit(0.0), lambda sum_, x: sum_ + F.floor(SCALE * x).cast("double") ** 2
    )
    small = F.forall(vector, lambda x: F.abs(x) < float(1 << 30))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & small)
    rows = rows.where(norm < float(SCORE_LIMIT))
    rows = rows.withColumn("mark", F.xxhash64("label", "vector"))
    return written(rows.groupBy("vec_id", "label", "mark").agg(F.first("vector").alias("vector")))


def _references(rows: DataFrame, number: int, sample_rows: int) -> dict[int, np.ndarray]:
    """Reference directions per width, from a bounded sample chosen by the rows' marks."""
    total = rows.count()
    if not total:
        return {}
    share = max(1, math.ceil(min(1.0, sample_rows / total) * 1_000_000))
    sample = (
        rows.where(F.pmod("mark", F.lit(1_000_000)) < share)
        .orderBy("mark", "vec_id")
        .limit(2 * sample_rows)
        .select("vector")
        .collect()
    )
    by_width: dict[int, list] = {}
    for row in sample:
        by_width.setdefault(len(row.vector), []).append(row.vector)
    return {
        width: fit_references(np.floor(SCALE * np.array(found)), number)
        for width, found in by_width.items()
        if width
    }


def _stored(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    def task(found: Iterable[tuple]) -> Iterator[tuple]:
        held: dict[int, list[tuple]] = {}

        def done(width: int) -> Iterator[tuple]:
            block = held.pop(width)
            whole = np.floor(SCALE * np.array([row[3] for row in block], dtype=np.float64))
            whole = whole.reshape(len(block), width)
            angles = np.zeros((len(block), 0))
            if width in references:
                angles = angles_to(whole, references[width])
            cells = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(block), dtype=int)
            norms = np.linalg.norm(whole, axis=1)
            for row, numbers, angle, cell, norm in zip(block, whole, angles, cells, norms):
                yield (
                    *row[:3],
                    width,
                    int(cell),
                    float(norm),
                    numbers.astype("<i8").tobytes(),
                    angle.astype("<f4").tobytes(),
                )

        for row in found:
            width = len(row[3])
            held.setdefault(width, []).append(row)
            if len(held[width]) == 1024:
                yield from done(width)
        for width in list(held):
            yield from done(width)

    return written(map_rows(rows.select("vec_id", "label", "mark", "vector"), _STORED, task))


@dataclass(frozen=True)
class Cell:
    """Rows of one width whose closest reference is the same."""

    rows: int
    low_norm: float
    high_norm: float
    low: np.ndarray  # least angle to each reference
    high: np.ndarray


def _cells(stored: DataFrame) -> dict[int, dict[int, Cell]]:
    """Per width and cell what it holds; the driver gets one row each, as many as references."""
    kinds = "width bigint, cell bigint, n bigint, low_norm double, high_norm double, low binary, high binary"

    def summed(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[tuple, list] = {}
        for part in parts:
            for (width, cell), some in part.groupby(["width", "cell"]):
                angles = np.stack([np.frombuffer(raw, dtype="<f4") for raw in some["low"]])
                others = np.stack([np.frombuffer(raw, dtype="<f4") for raw in some["high"]])
                new = [
                    int(some["n"].sum()),
                    some["low_norm"].min(),
                    some["high_norm"].max(),
                    angles.min(axis=0),
                    others.max(axis=0),
                ]
                old = kept.get((width, cell))
                if old:
                    joins = (int.__add__, min, max, np.minimum, np.maximum)
                    new = [join(a, b) for join, a, b in zip(joins, old, new)]
                kept[width, cell] = new
        rows = [
            (*key, n, low, high, least.tobytes(), most.tobytes())
            for key, (n, low, high, least, most) in kept.items()
        ]
        yield pd.DataFrame(rows, columns=[part.split()[0] for part in kinds.split(", ")])

    single = stored.select(
        "width",
        "cell",
        F.lit(1).cast("bigint").alias("n"),
        F.col("norm").alias("low_norm"),
        F.col("norm").alias("high_norm"),
        F.col("angles").alias("low"),
        F.col("angles").alias("high"),
    )
    partial = single.mapInPandas(summed, kinds)
    merged = partial.groupBy("width", "cell").applyInPandas(lambda part: next(summed([part])), kinds)
    cells: dict[int, dict[int, Cell]] = {}
    for row in merged.collect():
        low, high = (np.frombuffer(raw, dtype="<f4").astype(float) for raw in (row.low, row.high))
        cells.setdefault(row.width, {})[row.cell] = Cell(row.n, row.low_norm, row.high_norm, low, high)
    return cells


# Search

_ASKER = [*_ROW, ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))]
_SENT = pa.schema(
    [("at", pa.int64()), ("list_block", pa.int64()), ("ask_block", pa.int64()), ("asks", pa.bool_()), *_ASKER]
)
_FOUND = "anchor_id bigint, anchor_mark bigint, win int, vec_id bigint, mark bigint, score bigint"


def _mixed(number: int) -> int:
    return (number * 0x9E3779B97F4A7C15) % (1 << 64) >> 32


def _routed(askers: DataFrame, cells: dict[int, dict[int, Cell]], blocks: int, near: bool) -> DataFrame:
    """Each asker once per block of the cells whose score bounds meet its windows."""

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for row in found:
            _, _, mark, width, _, norm, _, angles, lows, highs = row
            here = cells.get(width, {})
            names = sorted(here)
            own = np.frombuffer(angles, dtype="<f4").astype(float)
            least, most = angle_interval(
                own[None, :],
                np.stack([here[name].low for name in names]),
                np.stack([here[name].high for name in names]),
            )
            low, high = score_bounds(
                least,
                most,
                norm * np.array([here[name].low_norm for name in names]),
                norm * np.array([here[name].high_norm for name in names]),
            )
            meets = (high >= min(lows)) & (low <= max(highs))
            first = np.zeros(len(names), dtype=bool)
            first[np.lexsort((names, least))[:_NEAR]] = True
            for place in np.nonzero(meets & (first == near))[0]:
                name = names[place]
                for block in range(-(-here[name].rows // _LIST)):
                    yield name, block, _mixed(mark) % blocks, True, *row

    return map_rows(askers.select(*_NAMES, "lows", "highs"), _SENT, rows, batch=500)


def _listed(stored: DataFrame, cells: dict[int, dict[int, Cell]], blocks: int) -> DataFrame:
    """Each row in its block of its cell, once per block of askers."""

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for row in found:
            mine = cells[row[3]][row[4]]
            block = _mixed(row[0] ^ row[2]) % -(-mine.rows // _LIST)
            for ask in range(blocks):
                yield row[4], block, ask, False, *row, None, None

    return map_rows(stored.select(*_NAMES), _SENT, rows, batch=2000)


def _searched(sent: DataFrame, number: int, same_label: bool) -> DataFrame:
    """Per asker and window its best ``number`` rows of each block."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        names = [part.split()[0] for part in _FOUND.split(", ")]
        asks = group["asks"].to_numpy(dtype=bool)
        asking, listed = group[asks], group[~asks]
        found: list[tuple] = []
        if len(asking) and len(listed):
            ids, marks, labels = (listed[name].to_numpy() for name in ("vec_id", "mark", "label"))
            norms = listed["norm"].to_numpy()
            whole = np.stack([np.frombuffer(raw, dtype="<i8") for raw in listed["whole"]])
            angles = np.stack([np.frombuffer(raw, dtype="<f4") for raw in listed["angles"]]).astype(float)
            doubles = whole.astype(float)
            cell = int(group["at"].iloc[0])
            for start in range(0, len(asking), _SLICE):
                some = asking.iloc[start : start + _SLICE]
                own = np.stack([np.frombuffer(raw, dtype="<f4") for raw in some["angles"]]).astype(float)
                shape = (len(some), len(ids))
                least, most = np.zeros(shape), np.full(shape, math.pi)
                if angles.shape[1]:
                    picked = np.argsort(own, axis=1)[:, :_CLOSEST]
                    picked = np.hstack([np.full((len(some), 1), cell), picked])
                    for column in picked.T:
                        one, other = own[np.arange(len(some)), column][:, None], angles[:, column].T
                        least = np.maximum(least, np.abs(one - other))
                        sums = one + other
                        most = np.minimum(most, np.minimum(sums, 2 * math.pi - sums))
                least = np.maximum(least - _EPS, 0.0)
                most = np.minimum(most + _EPS, math.pi)
                both = some["norm"].to_numpy()[:, None] * norms[None, :]
                low, high = score_bounds(least, most, both, both)
                ends = np.array([(min(a), max(b)) for a, b in zip(some["lows"], some["highs"])])
                meets = (high >= ends[:, :1]) & (low <= ends[:, 1:])
                meets &= (labels[None, :] == some["label"].to_numpy()[:, None]) == same_label
                meets &= ids[None, :] != some["vec_id"].to_numpy()[:, None]
                for place, asker in enumerate(some.itertuples(index=False)):
                    rows = np.nonzero(meets[place])[0]
                    if not len(rows):
                        continue
                    numbers = np.frombuffer(asker.whole, dtype="<i8")
                    if both[place].max(initial=0.0) * 1.01 < _EXACT:
                        scores = (doubles[rows] @ numbers.astype(float)).astype(np.int64)
                    else:
                        scores = whole[rows] @ numbers
                    fit = (scores >= ends[place, 0]) & (scores <= ends[place, 1])
                    rows, scores = rows[fit], scores[fit]
                    order = np.lexsort((marks[rows], ids[rows], -scores))
                    rows, scores = rows[order], scores[order]
                    for window, (bottom, top) in enumerate(zip(asker.lows, asker.highs)):
                        begin = int(np.searchsorted(-scores, -top, side="left"))
                        for at in range(begin, min(begin + number, len(rows))):
                            if scores[at] < bottom:
                                break
                            row = rows[at]
                            found.append(
                                (asker.vec_id, asker.mark, window, ids[row], marks[row], scores[at])
                            )
        table = pd.DataFrame(found, columns=names).astype("int64")
        return table.astype({"win": "int32"})

    return sent.groupBy("width", "at", "list_block", "ask_block").applyInPandas(search, _FOUND)


def _ranked(found: DataFrame, number: int) -> DataFrame:
    order = "ORDER BY score DESC, vec_id, mark"
    window = f"row_number() OVER (PARTITION BY anchor_id, anchor_mark, win {order})"
    return found.withColumn("place", F.expr(window)).where(F.col("place") <= number)


def _best(
    askers: DataFrame, stored: DataFrame, cells: dict, blocks: int, number: int, same_label: bool
) -> DataFrame:
    """The best ``number`` rows in each window of each asker, in two rounds.

    The first round searches the cells next to an asker. Where it has filled a
    window, the score of its last row becomes the window's lower end, so that the
    second round scores only rows that can still displace one.
    """
    listed = written(_listed(stored, cells, blocks))

    def search(asking: DataFrame, near: bool) -> DataFrame:
        sent = written(_routed(asking, cells, blocks, near)).union(listed)
        return written(_searched(sent, number, same_label))

    first = search(askers, near=True)
    filled = _ranked(first, number).where(F.col("place") == number)
    filled = filled.groupBy("anchor_id", "anchor_mark").agg(
        F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("least")
    )
    raised = F.transform(
        "lows",
        lambda low, place: F.greatest(low, F.coalesce(F.element_at("least", place), low)),
    )
    again = (
        askers.join(
            filled,
            (F.col("vec_id") == F.col("anchor_id")) & (F.col("mark") == F.col("anchor_mark")),
            "left",
        )
        .withColumn("lows", raised)
        .select(*_NAMES, "lows", "highs")
    )
    return written(_ranked(first.union(search(again, near=False)), number))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    references: int = 64,
    sample_rows: int = 4096,
) -> DataFrame:
    """Different-label rows that score close below each anchor's positives.

    A component counts as floor(256 * x), a score is the integer inner product
    with the anchor; more is better, ties go to the smaller ``vec_id``. ``anchors``
    says which rows of ``vectors`` (``vec_id``, ``label``, ``embedding``) are anchors. An
    anchor's positives are its best ``positives`` other rows of the same label. For
    each of them, the best ``negatives`` rows of another label are returned whose
    score is from ``low_percent`` to ``high_percent`` of the positive's: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Every row stores its angles to reference directions, which are fitted on about
    ``sample_rows`` rows chosen by a hash. By the triangle inequality they give an
    interval for the angle to an anchor, and with both norms bounds on the score.
    Cells (rows with the same closest reference), then rows, whose bounds miss all
    windows of an anchor are passed over; the others are scored in integers, so
    the result is exact. Anchors meet rows in pairs of bounded blocks, and a task
    returns the best few per anchor and window.

    A null id, label, embedding or component, a non-finite component, and a row
    whose score with itself reaches 2**56 (a norm near a million before scaling)
    take no part. Vectors of different lengths never meet; a zero or empty vector
    scores 0. Rows that agree entirely count once; rows that share a ``vec_id`` but
    differ are anchors each, and never each other's positive or negative. A positive
    with a negative score has no window. An empty table gives no rows, other
    columns are not read.
    """
    rows = _usable(vectors)
    stored = _stored(rows, _references(rows, references, sample_rows))
    cells = _cells(stored)
    chosen = written(stored.where(anchors))
    blocks = max(1, -(-chosen.count() // _ASK))
    everything = chosen.withColumns(
        {
            "lows": F.array(F.lit(-SCORE_LIMIT)).cast("array<bigint>"),
            "highs": F.array(F.lit(SCORE_LIMIT)).cast("array<bigint>"),
        }
    )
    best = _best(everything, stored, cells, blocks, positives, same_label=True)
    # Whole-number forms of: low <= 100 * negative / positive <= high.
    low = F.expr(f"({low_percent} * score + 99) div 100")
    high = F.expr(f"({high_percent} * score) div 100")
    best = best.where("score >= 0").withColumns({"low": low, "high": high})
    windows = best.groupBy("anchor_id", "anchor_mark").agg(
        F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("windows")
    )
    asking = written(
        chosen.join(
            windows,
            (F.col("vec_id") == F.col("anchor_id")) & (F.col("mark") == F.col("anchor_mark")),
        ).select(
            *_NAMES,
            F.transform("windows", lambda w: w.low).alias("lows"),
            F.transform("windows", lambda w: w.high).alias("highs"),
        )
    )
    found = _best(asking, stored, cells, blocks, negatives, same_label=False)
    known = best.select(
        "anchor_id",
        "anchor_mark",
        (F.col("place") - 1).alias("win"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(known, ["anchor_id", "anchor_mark", "win"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
