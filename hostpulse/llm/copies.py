"""Near copies of documents: equal in at least four fifths of their word shingles, found by SimHash."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.llm.components import components
from hostpulse.llm.simhash import shingle_hashes
from hostpulse.llm.store import map_rows, written

SIZE = 5  # words of a shingle
# Chance that a pair at similarity 0.8 meets at a segment of so many bits (simulated; 0.15 of the bits differ).
MEETS = {20: 0.225, 22: 0.172, 24: 0.132, 26: 0.099, 28: 0.075, 30: 0.056, 32: 0.042}
MISSED = 0.0004  # pairs at 0.8 that meet at no segment
LEAST_WORDS = 24
CHECK = 22  # of the 64 bits kept beside a point a pair at 0.8 differs in 10 +- 3
FEW, FEW_CHECK = 32, 26  # sets too small for such a law differ in more bits
TINY, TINY_TIMES = 16, 4  # and the smallest meet less often at a segment, so they have more of them
_BLOCK = 240  # shingles whose bits are counted at once: one byte a count

_random = np.random.default_rng(42)
_FACTORS = _random.integers(1, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Layout:
    """How many bits a fingerprint has, and how they are cut, for about ``rows`` documents.

    Segments grow with the rows, so that at most every fourth point or so is shared by
    chance, and their number so that all but ``MISSED`` pairs at 0.8 meet.
    """

    def __init__(self, rows: int) -> None:
        bits = max(rows - 1, 1).bit_length() + 4
        self.bits = min(max(bits + bits % 2, min(MEETS)), max(MEETS))
        self.segments = math.ceil(math.log(MISSED) / math.log(1 - MEETS[self.bits]))
        # The last word lies in no segment.
        self.words = max(LEAST_WORDS, -(-self.segments * self.bits // 64) + 1)
        size, share = 64 * self.words, 0.1515
        self.limit = math.ceil(size * share + 4 * math.sqrt(size * share * (1 - share)))


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, in order; none for a text without words."""
    return np.unique(shingle_hashes(text or "", size))


def similarity(one: np.ndarray, two: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; 1 if both are empty."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    every = len(one) + len(two) - both
    return both / every if every else 1.0


def bit_counts(hashes: np.ndarray, words: int) -> np.ndarray:
    """How often each bit is set in ``words`` other 64-bit hashes of the shingles."""
    counts = np.zeros(64 * words, dtype=np.int64)
    for start in range(0, len(hashes), _BLOCK):
        mixed = hashes[start : start + _BLOCK, None] * _FACTORS[None, :words]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[-1]
        mixed = (mixed ^ (mixed >> np.uint64(29))).astype("<u8")
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
    return counts


def print_of(hashes: np.ndarray, layout: Layout) -> tuple[list[int], list[int]]:
    """Words of the SimHash fingerprint, as signed numbers, and its segments.

    A bit is set if it is set in over half the hashes. A segment is its value and,
    above 32 bits, the places of its two least certain bits, whose counts are the
    closest to one half: if a near copy differs there, it most often does in these.
    """
    size = len(hashes)
    if not size:
        return [0] * layout.words, []
    number = layout.segments * (TINY_TIMES if size < TINY else 1)
    used = number * layout.bits
    counts = 2 * bit_counts(hashes, max(layout.words, -(-used // 64)))
    print_ = np.packbits(counts[: 64 * layout.words] > size, bitorder="little").view("<i8")
    cut = counts[:used].reshape(number, layout.bits)
    values = (cut > size) @ (1 << np.arange(layout.bits, dtype=np.int64))
    unsure = np.argsort(np.abs(cut - size), axis=1, kind="stable")[:, :2]
    return print_.tolist(), (values | unsure[:, 0] << 32 | unsure[:, 1] << 37).tolist()


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("n", pa.int64()),
        ("print", pa.list_(pa.int64())),
        ("segments", pa.list_(pa.int64())),
    ]
)


def _signed(docs: DataFrame, layout: Layout) -> DataFrame:
    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in found:
            hashes = shingle_set(text)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            yield doc_id, digest, len(hashes), *print_of(hashes, layout)

    return map_rows(docs, _SIGNED, rows)


def _points(nodes: DataFrame) -> DataFrame:
    """Every node at the four points around each of its segments.

    The points are the segment and what it is with one or both of its unsure bits
    flipped; the segment's place stands above their 32 bits.
    """
    cut = nodes.select("node", "n", "check", F.posexplode("segments").alias("place", "segment"))
    one = "shiftleft(1L, int(shiftright(segment, 32) & 31))"
    two = "shiftleft(1L, int(shiftright(segment, 37) & 31))"
    value = "(shiftleft(bigint(place), 32) | (segment & 4294967295L))"
    around = f"array({value}, {value} ^ {one}, {value} ^ {two}, {value} ^ {one} ^ {two})"
    return cut.select("node", "n", "check", F.explode(F.expr(around)).alias("point"))


def _alike(one: str, two: str, least: float) -> Column:
    """Whether set sizes and the words kept beside the points allow the similarity."""
    smaller = f"least({one}n, {two}n)"
    return F.expr(
        f"""
        {smaller} >= {least} * greatest({one}n, {two}n) - 0.001
        AND bit_count({one}check ^ {two}check) <= if({smaller} < {FEW}, {FEW_CHECK}, {CHECK})
        """
    )


def _close(one: str, two: str, layout: Layout) -> Column:
    """Whether the whole fingerprints are close enough; sets under ``FEW`` are, whatever their bits."""
    words = range(layout.words)
    differ = " + ".join(f"bit_count({one}print[{word}] ^ {two}print[{word}])" for word in words)
    return F.expr(f"least({one}n, {two}n) < {FEW} OR {differ} <= {layout.limit}")


def _near(pairs: DataFrame, prints: DataFrame, layout: Layout) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose whole fingerprints are close enough."""
    one = prints.select(F.col("node").alias("a"), F.struct("n", "print").alias("one"))
    two = prints.select(F.col("node").alias("b"), F.struct("n", "print").alias("two"))
    both = written(pairs.distinct()).join(one, "a").join(two, "b")
    return written(both.where(_close("one.", "two.", layout)).select("a", "b"))


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirmed(pairs: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose whole shingle sets are similar enough."""

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        hashes = lru_cache(maxsize=64)(shingle_set)
        for a, b, one, two in found:
            if similarity(hashes(one), hashes(two)) >= least:
                yield a, b

    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = written(known.join(written(ends), "doc_id", "left_semi").distinct())
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("two"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return written(map_rows(both, _LINK, rows).distinct())


def copy_groups(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """``doc_id`` and ``component_id`` of every document that has a ``doc_id``.

    Documents link if the Jaccard similarity of their sets of five-word shingles
    is ``least`` (0.8 or more, for which the segments are laid out) or more;
    ``component_id`` is the smallest ``doc_id`` reachable by links, itself included.
    Fewer words make one shingle, texts without words are copies of each other.
    Rows of one ``doc_id`` are one document.

    Candidates come from SimHash fingerprints of the sets: each is cut into segments
    and entered at the small ball of points around every segment. Pairs that meet
    and whose whole fingerprints are close enough are confirmed on whole sets. Equal
    sets are one node. At each point every node is held against the smallest one
    there first, which ties a dense group with one pair a node; only nodes that are
    still in different components meet in pairs. Texts that meet no other are not
    compared.
    """
    known = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    layout = Layout(known.count())
    found = written(_signed(known, layout))
    nodes = found.groupBy("digest").agg(
        F.min("doc_id").alias("node"),
        *(F.first(name).alias(name) for name in ("n", "print", "segments")),
    )
    nodes = written(nodes.withColumn("check", F.element_at("print", -1)))
    prints = nodes.select("node", "n", "print")

    ordered = Window.partitionBy("point").orderBy("node")
    smallest = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = _points(nodes).select(
        "*",
        F.first(F.struct("node", "n", "check")).over(smallest).alias("hub"),
        F.row_number().over(ordered).alias("number"),
        F.lead("node").over(ordered).alias("following"),
    )
    met = met.where("number > 1").withColumns(
        {"alike": _alike("", "hub.", least), "third": F.expr("number > 2 OR following IS NOT NULL")}
    )
    columns = ["point", "node", "n", "check", "alike", "third", F.col("hub.node").alias("hub")]
    met = written(met.where("alike OR third").select(*columns))
    to_hub = met.where("alike").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = _confirmed(_near(to_hub, prints, layout), known, least)

    tied = components(links)
    left = met.where("third").select("point", "node", "n", "check")
    left = left.join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = written(left)
    mixed = left.groupBy("point").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = written(mixed.where("low <> high").select("point"))
    left = written(left.join(mixed, "point", "left_semi"))
    apart = F.expr("one.point = two.point AND one.root <> two.root")
    # Most meet others by chance; what is left takes its whole fingerprint along.
    left = left.alias("one").join(
        left.alias("two"), apart & _alike("one.", "two.", least), "left_semi"
    )
    left = written(written(left).join(prints.drop("n"), "node"))
    across = (
        left.alias("one")
        .join(
            left.alias("two"),
            apart
            & F.expr("one.node < two.node")
            & _alike("one.", "two.", least)
            & _close("one.", "two.", layout),
        )
        .select(F.col("one.node").alias("a"), F.col("two.node").alias("b"))
    )
    links = links.union(_confirmed(written(across.distinct()), known, least))
    same_doc = (
        found.groupBy("doc_id")
        .agg(F.min("digest").alias("one"), F.max("digest").alias("two"))
        .where("one <> two")
    )
    several = found.select("doc_id", "digest").join(same_doc.select("doc_id"), "doc_id")
    several = several.join(nodes.select("digest", "node"), "digest")
    roots = components(links.union(several.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))))
    grouped = written(
        nodes.join(roots, "node", "left").select(
            "digest", F.coalesce("root", "node").alias("component_id")
        )
    )
    return found.join(grouped, "digest").select("doc_id", "component_id").distinct()
