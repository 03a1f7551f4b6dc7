"""Near-duplicate vectors: inverted lists, product quantisation, exact cosine afterwards."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.components import components
from hostpulse.llm.store import map_rows, written

BLOCK = 1024  # vectors of one side in a task's pair of blocks


def _assigned(points: np.ndarray, centres: np.ndarray, number: int) -> np.ndarray:
    """For each point the ``number`` nearest centres, nearest first, ties by place."""
    far = (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
    if number >= len(centres):
        return np.argsort(far, axis=1, kind="stable")
    near = np.argpartition(far, number - 1, axis=1)[:, :number]
    order = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def _means(points: np.ndarray, number: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of ``points`` by Lloyd's rounds; ``number`` of them, or one per point if fewer."""
    random = np.random.default_rng(seed)
    number = min(number, len(points))
    centres = points[random.choice(len(points), number, replace=False)].copy()
    for _ in range(rounds):
        nearest = _assigned(points, centres, 1)[:, 0]
        counts = np.bincount(nearest, minlength=number)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


@dataclass(frozen=True)
class Quantiser:
    """Coarse cells, and per subspace the codewords of what is left of a vector in its cell."""

    cells: np.ndarray
    words: np.ndarray  # subspace, code, part of a vector

    @property
    def parts(self) -> int:
        return len(self.words)

    def encode(self, units: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance from each vector to what its codes stand for."""
        left = units - self.cells[cells]
        split = left.reshape(len(units), self.parts, -1)
        codes = np.empty((len(units), self.parts), dtype=np.int64)
        error = np.zeros(len(units))
        for part, words in enumerate(self.words):
            codes[:, part] = _assigned(split[:, part], words, 1)[:, 0]
            error += ((split[:, part] - words[codes[:, part]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from exact queries to coded vectors of a cell, by table look-up."""
        split = (queries - self.cells[cell]).reshape(len(queries), self.parts, -1)
        total = np.zeros((len(queries), len(codes)))
        for part, words in enumerate(self.words):
            table = ((split[:, part, None, :] - words[None]) ** 2).sum(axis=2)
            total += table[:, codes[:, part]]
        return total


def fit_quantiser(
    sample: np.ndarray, cells: int, parts: int = 16, codes: int = 32, rounds: int = 8
) -> Quantiser:
    """A quantiser from unit vectors; ``parts`` is lowered to a divisor of their length."""
    width = sample.shape[1]
    parts = math.gcd(parts, width)
    coarse = _means(sample, cells, rounds, 1)
    left = (sample - coarse[_assigned(sample, coarse, 1)[:, 0]]).reshape(len(sample), parts, -1)
    words = [_means(left[:, part], codes, rounds, 2 + part) for part in range(parts)]
    return Quantiser(coarse, np.stack(words))


@dataclass(frozen=True)
class Shelf:
    """The quantiser of one width, whose cells are numbered from ``first`` on."""

    first: int
    quantiser: Quantiser


def _shelves(
    distinct: DataFrame, sample_rows: int, cell_rows: int, max_cells: int
) -> dict[int, Shelf]:
    """A quantiser per width; the sample is shared by all widths, by their numbers of vectors.

    A width with no vector in the sample has a single cell around zero.
    """
    counted = distinct.groupBy(F.size("unit").alias("width")).agg(F.count("*").alias("n")).collect()
    sizes = {row.width: row.n for row in counted}
    share = min(1.0, sample_rows / max(1, sum(sizes.values())))
    sample = (
        distinct.where(F.pmod("check", F.lit(1_000_000)) < max(1, math.ceil(share * 1_000_000)))
        .orderBy("hash", "check")
        .limit(2 * sample_rows)
        .select("unit")
        .collect()
    )
    points: dict[int, list[list[float]]] = {width: [] for width in sizes}
    for row in sample:
        points[len(row.unit)].append(row.unit)
    shelves, first = {}, 0
    for width, n in sorted(sizes.items()):
        cells = min(max_cells, math.ceil(n / cell_rows))
        quantiser = fit_quantiser(np.array(points[width] or [[0.0] * width]), cells)
        shelves[width] = Shelf(first, quantiser)
        first += len(quantiser.cells)
    return shelves


def local_roots(count: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest node it reaches over the links ``one``-``two``."""
    roots = np.arange(count)
    while True:
        low = np.minimum(roots[one], roots[two])
        now = roots.copy()
        np.minimum.at(now, one, low)
        np.minimum.at(now, two, low)
        np.minimum.at(now, roots[one], low)
        np.minimum.at(now, roots[two], low)
        now = now[now]
        if (now == roots).all():
            return roots
        roots = now


_CODED = pa.schema(
    [
        ("node", pa.int64()),
        ("copies", pa.int64()),
        ("unit", pa.list_(pa.float64())),
        ("cell", pa.int64()),
        ("probes", pa.list_(pa.int64())),
        ("codes", pa.list_(pa.int64())),
        ("error", pa.float64()),
    ]
)
_FOUND = "node bigint, links bigint, root bigint"


def _coded(distinct: DataFrame, shelves: dict[int, Shelf], probes: int) -> DataFrame:
    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        block: list[tuple] = []

        def coded(width: int, some: list[tuple]) -> Iterator[tuple]:
            shelf = shelves[width]
            quantiser = shelf.quantiser
            units = np.array([row[2] for row in some], dtype=np.float64)
            near = _assigned(units, quantiser.cells, min(probes, len(quantiser.cells)))
            codes, error = quantiser.encode(units, near[:, 0])
            for row, unit, probed, code, off in zip(some, units, near + shelf.first, codes, error):
                yield (
                    row[0],
                    row[1],
                    unit.tolist(),
                    int(probed[0]),
                    probed.tolist(),
                    code.tolist(),
                    float(off),
                )

        def done() -> Iterator[tuple]:
            widths: dict[int, list[tuple]] = {}
            for row in block:
                widths.setdefault(len(row[2]), []).append(row)
            for width, some in widths.items():
                yield from coded(width, some)

        for row in found:
            block.append(row)
            if len(block) == BLOCK:
                yield from done()
                block.clear()
        if block:
            yield from done()

    return written(map_rows(distinct, _CODED, rows))


def _linked(pairs: DataFrame, shelves: dict[int, Shelf], cosine: float) -> DataFrame:
    """Per vector and pair of blocks its links found there, and the smallest node they reach.

    A pair that both of its vectors find, each in the other's cell, counts where
    the smaller one asks.
    """
    reach = math.sqrt(2 - 2 * cosine)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        asking, listed = group[asks], group[~asks]
        empty = pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        if asking.empty or listed.empty:
            return empty
        cell = int(group["at"].iloc[0])
        queries = np.stack(asking["unit"].to_list())
        vectors = np.stack(listed["unit"].to_list())
        shelf = shelves[queries.shape[1]]
        far = shelf.quantiser.distances(queries, cell - shelf.first, np.stack(listed["codes"].to_list()))
        # The look-up is off by no more than the distance of a vector from its codes.
        within = reach + listed["error"].to_numpy() + 1e-6
        one, two = np.nonzero(far <= (within**2)[None, :])
        asker, answer = asking["node"].to_numpy(), listed["node"].to_numpy()
        own = asking["cell"].to_numpy()
        probes = np.stack(listed["probes"].to_list())
        other = asker[one] != answer[two]
        one, two = one[other], two[other]
        close = np.empty(len(one), dtype=bool)
        for start in range(0, len(one), 1 << 16):
            some = slice(start, start + (1 << 16))
            close[some] = np.einsum("ij,ij->i", queries[one[some]], vectors[two[some]]) >= cosine
        one, two = one[close], two[close]
        back = (probes[two] == own[one][:, None]).any(axis=1)
        first = ~back | (asker[one] < answer[two])
        one, two = one[first], two[first]
        if not len(one):
            return empty
        nodes, places = np.unique(np.concatenate([asker[one], answer[two]]), return_inverse=True)
        left, right = places[: len(one)], places[len(one) :]
        links = np.bincount(left, listed["copies"].to_numpy()[two], len(nodes))
        links += np.bincount(right, asking["copies"].to_numpy()[one], len(nodes))
        roots = nodes[local_roots(len(nodes), left, right)]
        return pd.DataFrame({"node": nodes, "links": links.astype("int64"), "root": roots})

    return pairs.groupBy("at", "list_block", "ask_block").applyInPandas(search, _FOUND)


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    sample_rows: int = 20_000,
    cell_rows: int = 256,
    max_cells: int = 4096,
    probes: int = 12,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Vectors (``vec_id``, ``embedding``) link if their cosine, in double precision,
    is ``cosine`` or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest ``vec_id`` reachable, itself included, and
    ``kept`` says whether it is the row's own.

    Equal vectors are one node with a number of copies. Vectors of different
    lengths don't link; each length has a quantiser and cells of its own, and the
    driver holds a row per length. The quantisers are fitted on about
    ``sample_rows`` nodes in all, chosen by a hash of the vector: a cell for every
    ``cell_rows`` nodes of a length, ``max_cells`` at most. Every node is coded, and asks in its
    ``probes`` nearest cells. A cell is searched in pairs of blocks of about
    ``BLOCK`` vectors, however many it holds. Table look-up passes all pairs whose
    distance can reach the limit, given how far a vector is from its codes, and
    the exact cosine decides; so a link is lost only if neither vector asks in
    the other's cell. A task returns counts and the smallest node each vector
    reaches in its blocks, never the pairs.

    A null embedding, a null or non-finite component, an empty and a zero vector
    link with nothing; a length that few vectors have is a length like any other. Rows that repeat a
    ``vec_id`` with the same vector are linked like other equal vectors. A null
    ``vec_id`` links with nothing and has a null ``component_id`` and ``kept``.
    Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    norm = F.expr("sqrt(aggregate(vector, double(0), (sum, x) -> sum + x * x))")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Scaled by the largest component first: squares of very small or large ones don't fit.
    largest = F.expr("array_max(transform(vector, x -> abs(x)))")
    usable = rows.where(F.col("vec_id").isNotNull() & finite & (F.size("vector") > 0))
    usable = usable.withColumn("largest", largest).where("largest > 0")
    usable = usable.select(
        "vec_id", F.expr("transform(vector, x -> x / largest)").alias("vector")
    ).withColumn("norm", norm)
    usable = usable.select("vec_id", F.expr("transform(vector, x -> x / norm)").alias("unit"))
    usable = written(
        usable.select(
            "vec_id",
            "unit",
            F.xxhash64("unit").alias("hash"),
            F.xxhash64(F.lit("unit"), "unit").alias("check"),
        )
    )
    distinct = written(
        usable.groupBy("hash", "check").agg(
            F.min("vec_id").alias("node"),
            F.count("*").alias("copies"),
            F.first("unit").alias("unit"),
        )
    )
    shelves = _shelves(distinct, sample_rows, cell_rows, max_cells)
    coded = _coded(distinct.select("node", "copies", "unit"), shelves, probes)
    blocks = _blocks(coded)
    linked = written(_linked(_block_pairs(coded, blocks), shelves, cosine))
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = linked.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.select("hash", "check", "node", "copies").join(found, "node", "left")
    nodes = nodes.join(roots, "node", "left").select(
        "hash",
        "check",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    linked_rows = usable.select("vec_id", "hash", "check").join(
        written(nodes), ["hash", "check"]
    )
    # Rows that took part, and those that did not, each as often as it occurs.
    answers = linked_rows.groupBy("vec_id", "hash", "check", "n_links", "component_id").count()
    answers = answers.select(
        "vec_id",
        "n_links",
        "component_id",
        F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("copy"),
    ).drop("copy")
    part = (
        F.col("vec_id").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & (F.size("vector") > 0)
        & (F.coalesce(largest, F.lit(0.0)) > 0)
    )
    apart = rows.where(~part).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return _answer(answers.union(apart))


def _answer(rows: DataFrame) -> DataFrame:
    return rows.select(
        "vec_id",
        "n_links",
        "component_id",
        (F.col("vec_id") == F.col("component_id")).alias("kept"),
    )


def _blocks(coded: DataFrame) -> dict[int, tuple[int, int]]:
    """Per cell the number of blocks of its list and of those that ask in it: a row per cell."""
    listed = coded.groupBy(F.col("cell").alias("at")).agg(F.count("*").alias("n"))
    asked = coded.select(F.explode("probes").alias("at")).groupBy("at").agg(F.count("*").alias("n"))
    sizes: dict[int, list[int]] = {}
    for side, table in enumerate((listed, asked)):
        for row in table.collect():
            sizes.setdefault(row.at, [1, 1])[side] = math.ceil(row.n / BLOCK)
    return {cell: (one, two) for cell, (one, two) in sizes.items()}


_SENT = pa.schema(
    [
        ("at", pa.int64()),
        ("list_block", pa.int64()),
        ("ask_block", pa.int64()),
        ("asks", pa.bool_()),
        *((field.name, field.type) for field in _CODED),
    ]
)


def _block_pairs(coded: DataFrame, blocks: dict[int, tuple[int, int]]) -> DataFrame:
    """Each vector once per block that it meets, as one that asks or as one in a list."""

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for row in found:
            node, cell, probes = row[0], row[3], row[4]
            mixed = (node * 0x9E3779B97F4A7C15) % (1 << 64) >> 32
            lists, askers = blocks[cell]
            for ask in range(askers):
                yield cell, mixed % lists, ask, False, *row
            for at in probes:
                if at in blocks:
                    lists, askers = blocks[at]
                    for block in range(lists):
                        yield at, block, mixed % askers, True, *row

    return map_rows(coded, _SENT, rows, batch=2000)
