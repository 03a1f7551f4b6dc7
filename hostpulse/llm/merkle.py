"""Merkle manifest of a dataset: trees of runs of three, kept as a postorder append log."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, written

ARITY = 3
LEVELS = 6  # a builder completes so many levels over aligned blocks of ARITY ** LEVELS nodes


# Closed forms of a tree that is appended to leaf by leaf


def height(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves; 0 for a lone leaf."""
    level = 0
    while ARITY**level < size:
        level += 1
    return level


def written_before(leaves: int) -> int:
    """Nodes the log holds once so many leaves are appended and every full run is closed."""
    total = leaves
    while leaves:
        leaves //= ARITY
        total += leaves
    return total


def position(level: int, place: int, size: int) -> int:
    """Where the log has node ``place`` of ``level`` in a tree of ``size`` leaves.

    A node is written when the last leaf below it is, after that leaf and the
    lower nodes that the leaf completes too.
    """
    last = min((place + 1) * ARITY**level, size) - 1
    return written_before(last) + level


def _joined(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


# Leaves


def field(column: Column) -> Column:
    """A value with the length of its UTF-8 text before it, or ``-`` for null."""
    value = column.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")
    )


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, digest, ...) with ``place`` in the tree and the tree's ``size``.

    Ranges of (tree, key, digest) are sorted each for itself; what precedes a
    range in its tree is summed over one row per range and tree. So no task holds
    a tree, however many of all leaves are its own.
    """
    order = ["tree", "key", "digest", "copy"]
    rows = leaves.withColumn("copy", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    rows = rows.withColumn("range", F.shiftright("row", 33))
    spans = rows.groupBy("tree", "range").agg(F.min("row").alias("low"), F.count("*").alias("n"))
    before = "PARTITION BY tree ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    spans = spans.select(
        "tree",
        "range",
        (F.expr(f"coalesce(sum(n) OVER ({before}), 0)") - F.col("low")).alias("shift"),
        F.expr("sum(n) OVER (PARTITION BY tree)").alias("size"),
    )
    rows, spans = rows.alias("rows"), written(spans).alias("spans")
    same = (F.col("rows.range") == F.col("spans.range")) & F.col("rows.tree").eqNullSafe(
        F.col("spans.tree")
    )
    placed = rows.join(spans, same).select(
        "rows.*", (F.col("row") + F.col("shift")).alias("place"), "size"
    )
    return written(placed.drop("row", "range"))


# The log

_NODE = pa.schema(
    [
        ("tree", pa.string()),
        ("size", pa.int64()),
        ("level", pa.int64()),
        ("place", pa.int64()),
        ("position", pa.int64()),
        ("digest", pa.string()),
        ("root", pa.bool_()),
    ]
)


def _appended(nodes: DataFrame, base: int) -> DataFrame:
    """Log rows that complete over ``nodes`` of level ``base``, up to ``LEVELS`` levels above.

    Blocks are aligned, so no run crosses one: each is built by one task, in
    memory of two nodes a level. The nodes of level 0 are part of the result.
    """
    span = ARITY**LEVELS

    def block(found: Iterable[tuple], size: int) -> Iterator[tuple]:
        top = min(base + LEVELS, height(size))
        open_runs: list[list[str]] = [[] for _ in range(top + 1)]

        def node(level: int, place: int, digest: str) -> Iterator[tuple]:
            if level > base or base == 0:
                whole = level == height(size)
                yield tree, size, level, place, position(level, place, size), digest, whole
            if level < top:
                run = open_runs[level]
                run.append(digest)
                if len(run) == ARITY or (place + 1) * ARITY**level >= size:
                    digest = _joined(run)
                    run.clear()
                    yield from node(level + 1, place // ARITY, digest)

        for tree, _, place, digest in found:
            yield from node(base, place, digest)

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for (_, size, _), nodes in groupby(found, lambda row: (row[0], row[1], row[2] // span)):
            yield from block(nodes, size)

    at = F.floor(F.col("place") / span).alias("block")
    dealt = nodes.select("tree", "size", "place", "digest", at).repartition("tree", "block")
    dealt = dealt.sortWithinPartitions("tree", "block", "place").drop("block")
    return written(map_rows(dealt, _NODE, rows, batch=5000))


def _log(placed: DataFrame) -> list[DataFrame]:
    """The log in passes, each of ``LEVELS`` levels; one number, the largest size, is collected."""
    largest = placed.agg(F.max("size")).first()[0] or 0
    passes = [_appended(placed, 0)]
    while ARITY ** (LEVELS * len(passes)) < largest:
        base = LEVELS * len(passes)
        below = passes[-1].where((F.col("level") == base) & (F.col("size") > ARITY**base))
        passes.append(_appended(below, base))
    return passes


# Proofs

_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_PATH_SQL = "array<struct<left: string, right: string>>"
_PROVED = pa.schema(
    [
        ("tree", pa.string()),
        ("place", pa.int64()),
        ("key", pa.int64()),
        ("digest", pa.string()),
        ("other", pa.string()),
        ("subroot", pa.string()),
        ("path", _PATH),
    ]
)
_ABOVE, _NODES, _ITEMS = 0, 1, 2


def _paths(size: int, base: int, block: int, nodes: dict[int, str], above: tuple) -> list[tuple]:
    """For each node of level ``base`` in a block its path to the root; siblings by position."""
    top = min(base + LEVELS, height(size))
    paths = [above]
    for level in range(top - 1, base - 1, -1):
        width = ARITY ** (base + LEVELS - level)
        end = min((block + 1) * width, -(-size // ARITY**level))
        digests = [nodes[position(level, place, size)] for place in range(block * width, end)]
        here = []
        for start in range(0, len(digests), ARITY):
            run = digests[start : start + ARITY]
            for place in range(len(run)):
                step = ("".join(run[:place]), "".join(run[place + 1 :]))
                here.append((step, *paths[start // ARITY]))
        paths = here
    return paths


def _proved(above: DataFrame, nodes: DataFrame, items: DataFrame, base: int) -> DataFrame:
    """``items`` (nodes of level ``base``) with the path to the root of all trees.

    ``above`` has the path of each block's own top, ``nodes`` the log of the levels
    that runs below it need. The three meet in a task per block, which is bounded.
    """
    span = ARITY**LEVELS

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for (tree, block), group in groupby(found, lambda row: row[:2]):
            path, subroot, log, paths = (), None, {}, None
            for _, _, kind, spot, size, digest, key, other, steps in group:
                if kind == _ABOVE:
                    path = tuple((step["left"], step["right"]) for step in steps)
                    subroot = digest
                elif kind == _NODES:
                    log[spot] = digest
                else:
                    if paths is None:
                        paths = _paths(size, base, block, log, path)
                    steps = paths[spot - block * span]
                    yield tree, spot, key, digest, other, subroot, steps

    def shaped(frame: DataFrame, kind: int, block: str, **columns: str) -> DataFrame:
        kinds = {
            "spot": "bigint",
            "size": "bigint",
            "digest": "string",
            "key": "bigint",
            "other": "string",
            "path": _PATH_SQL,
        }
        return frame.select(
            "tree",
            F.expr(block).cast("bigint").alias("block"),
            F.lit(kind).alias("kind"),
            *(
                F.expr(columns.get(name, "NULL")).cast(type_).alias(name)
                for name, type_ in kinds.items()
            ),
        )

    whole = " ".join(f"WHEN {level} THEN {ARITY ** (base + LEVELS - level)}"
                     for level in range(base, base + LEVELS))
    dealt = (
        shaped(above, _ABOVE, "block", digest="subroot", path="path")
        .union(
            shaped(
                nodes.where(F.col("level").between(base, base + LEVELS - 1)),
                _NODES,
                f"place div CASE level {whole} END",
                spot="position",
                digest="digest",
            )
        )
        .union(
            shaped(
                items,
                _ITEMS,
                f"place div {span}",
                spot="place",
                size="size",
                digest="digest",
                key="key",
                other="other",
            )
        )
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "kind", "spot")
    )
    return map_rows(dealt, _PROVED, rows, batch=500)


def _tree_proofs(passes: list[DataFrame], leaves: DataFrame, roots: DataFrame) -> DataFrame:
    """``leaves`` with their whole paths; ``roots`` has each tree's size, root and path above."""
    reach = [ARITY ** (LEVELS * number) for number in range(len(passes) + 1)]
    proved = None
    for number in range(len(passes) - 1, -1, -1):
        base = LEVELS * number
        here = F.col("size") <= reach[number + 1]
        if number:
            here &= F.col("size") > reach[number]
        above = roots.where(here).select("tree", F.lit(0).alias("block"), "subroot", "path")
        if proved is not None:
            above = above.union(proved.select("tree", F.col("place").alias("block"), "subroot", "path"))
        nodes, items = passes[number], leaves
        if number:
            below = passes[number - 1].where((F.col("level") == base) & (F.col("size") > reach[number]))
            nodes = nodes.union(below)
            items = below.withColumns(
                {"key": F.lit(None).cast("bigint"), "other": F.lit(None).cast("string")}
            )
        proved = _proved(above, nodes, items, base)
        if number:
            proved = written(proved)
    return proved


@dataclass(frozen=True)
class Manifest:
    """The trees of a dataset as stored tables, and the digest of all of it.

    ``leaves``: tree, key, digest, other, place, size. ``log``: one row per node of
    every tree (tree, size, level, place, position, digest, root); read in order of
    ``position``, a tree's rows are its append log. ``root_log`` is the same for the
    tree over the trees' roots. ``root`` is None for an empty dataset.
    """

    passes: list[DataFrame]
    root_passes: list[DataFrame]
    leaves: DataFrame
    subroots: DataFrame
    root: str | None

    @property
    def log(self) -> DataFrame:
        return reduce(DataFrame.union, self.passes)

    @property
    def root_log(self) -> DataFrame:
        return reduce(DataFrame.union, self.root_passes)

    def proofs(self) -> DataFrame:
        """Every leaf with ``subroot`` and ``path``: per level up to the root, the joined
        digests of the siblings to its left and to its right."""
        whole = self.subroots.select(
            F.lit(None).cast("string").alias("tree"),
            F.lit(0).alias("block"),
            F.col("size"),
            F.lit(self.root).cast("string").alias("subroot"),
            F.expr(f"cast(array() as {_PATH_SQL})").alias("path"),
        ).limit(1)
        tops = self.subroots.select(
            "tree", "place", "size", "digest", F.lit(None).cast("bigint").alias("key"), "other"
        )
        # The name of each subroot's tree travels as ``other``, with a mark where it is not null.
        above = _tree_proofs(self.root_passes, tops, whole)
        named = above.select(
            F.expr("substr(other, 2)").alias("name"), F.col("other").isNotNull().alias("named"), "digest", "path"
        )
        sizes = self.log.where("root").select("tree", "size")
        named = written(named.select(F.when(F.col("named"), F.col("name")).alias("tree"), "digest", "path"))
        joined = named.alias("n").join(
            sizes.alias("s"), F.col("n.tree").eqNullSafe(F.col("s.tree"))
        )
        roots = written(joined.select("n.tree", "s.size", F.col("n.digest").alias("subroot"), "n.path"))
        return _tree_proofs(self.passes, self.leaves, roots)


def write_manifest(leaves: DataFrame) -> Manifest:
    """Build the trees over ``leaves`` (tree string, key bigint, digest, other).

    Leaves of one tree ascend by ``key``; while there are several nodes, every
    three consecutive ones (at the end fewer, even one) become the SHA-256 of
    their joined hex digests. What remains of each tree likewise gives the root
    of all, by tree name in byte order, null first. ``other`` is carried along.

    A null ``key`` sorts first, a null ``tree`` is a tree of its own. Equal keys
    are ordered by digest, so rows that repeat entirely are leaves that can stand
    for each other. An empty table has no trees and the root None.
    """
    placed = _placed(written(leaves.select("tree", "key", "digest", "other")))
    passes = _log(placed)
    tops = reduce(DataFrame.union, passes).where("root").select(
        F.lit(None).cast("string").alias("tree"),
        F.col("tree").alias("key"),
        "digest",
        F.concat(F.lit("="), "tree").alias("other"),
    )
    subroots = _placed(written(tops))
    root_passes = _log(subroots)
    found = reduce(DataFrame.union, root_passes).where("root").select("digest").first()
    return Manifest(passes, root_passes, placed, subroots, found and found.digest)


def fold(path: str | Column, digest: Column) -> Column:
    """What a leaf's digest and its path give as root."""
    return F.aggregate(
        path, digest, lambda below, step: F.sha2(F.concat(step.left, below, step.right), 256)
    )


def document_manifest(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its leaf, the roots, its proof, and what tampering does.

    A leaf is the digest of doc_id, source, lang, n_chars and text, each with its
    length before it; trees are sources. Documents whose decimal ``doc_id`` has an
    even CRC-32 are tampered with: their text loses its line breaks. Returns doc_id,
    leaf, subroot, root, path, folded_root (from the tampered leaf, if any, and the
    original siblings) and verified (whether that is the root).

    Nulls are written as ``-``, so that they differ from empty texts; a row without
    a ``doc_id`` sorts first and is not tampered with; a text of any length is hashed
    whole, in the JVM. Repeated rows are leaves each. An empty table gives no rows.
    Other columns are not read.
    """
    names = ["doc_id", "source", "lang", "n_chars"]
    head, text = [F.col(name) for name in names], F.col("text")
    altered = F.replace(text, F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    manifest = write_manifest(
        docs.select(
            F.col("source").alias("tree"),
            F.col("doc_id").alias("key"),
            leaf_digest(*head, text).alias("digest"),
            F.when(even, leaf_digest(*head, altered)).alias("other"),
        )
    )
    root = F.lit(manifest.root).cast("string")
    return manifest.proofs().select(
        F.col("key").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        fold("path", F.coalesce("other", "digest")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
