"""Benchmark passages in documents, found through an embedding of edit into Hamming distance."""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, written

# Blocks of Unicode whose scripts set no spaces between words (Thai, Lao, Myanmar,
# Khmer, kana, Han and its extensions).
_SPACELESS = (
    "\u0e00-\u0e7f\u0e80-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
)
_WORD = re.compile(rf"[^\W_{_SPACELESS}]+|(?=\w)[{_SPACELESS}]")
_ROUND = 6  # repetitions walked at once; an item found in one round needs no other
_END = -1  # what the walk reads behind a window


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; where a script has no spaces, each character."""
    return _WORD.findall((text or "").lower())


def allowed_edits(words: int, similarity: float) -> int:
    return math.floor((1 - similarity) * words + 1e-9)


def repetitions(agreement: float, samples: int, recall: float) -> int:
    """How many tables find a pair with the wanted chance, if one symbol agrees with ``agreement``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**samples))


class Walks:
    """CGK walks over windows of ``size`` words, of which a few output symbols are sampled.

    A walk reads the word under its pointer, outputs it, and moves on or stays,
    as a random bit of the step and the word says; 3 ``size`` steps in all. Two
    windows a few edits apart fall into step again behind each edit, so their
    outputs agree in most places. Each repetition has its own walk and its own
    sampled steps; the samples make its key.
    """

    def __init__(self, size: int, samples: int, repeats: int) -> None:
        random = np.random.default_rng([size, samples, repeats])
        self.size, self.repeats = size, repeats
        steps = 3 * size
        self.factor = random.integers(0, 1 << 63, (steps, repeats), dtype=np.uint64) | np.uint64(1)
        self.offset = random.integers(0, 1 << 63, (steps, repeats), dtype=np.uint64)
        taken = np.array([random.choice(steps, samples, replace=False) for _ in range(repeats)])
        self.taken = np.zeros((steps, repeats), dtype=bool)
        self.taken[taken.T, np.arange(repeats)] = True
        self.salt = random.integers(0, 1 << 63, repeats, dtype=np.uint64)

    def keys(self, windows: np.ndarray, low: int, high: int) -> np.ndarray:
        """One key for each repetition from ``low`` to ``high`` and each row of word ids."""
        count, reps = len(windows), np.arange(high - low)[:, None]
        # An end mark behind each window, so that no walk reads past it.
        windows = np.hstack([windows, np.full((count, 1), _END, dtype=np.int64)])
        symbols, places = np.unique(windows, return_inverse=True)
        places, rows = places.reshape(windows.shape), np.arange(count)[None, :]
        values = symbols.astype(np.uint64) + np.uint64(2)
        # The random bit of each step, repetition and word.
        mixed = values * self.factor[:, low:high, None]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        moves = ((mixed + self.offset[:, low:high, None]) >> np.uint64(63)).astype(np.int64)
        pointer = np.zeros((high - low, count), dtype=np.int64)
        keys = np.repeat(self.salt[low:high, None], count, axis=1)
        for step in range(len(moves)):
            read = places[rows, pointer]
            taken = np.nonzero(self.taken[step, low:high])[0]
            if len(taken):
                seen = values[read[taken]] + np.uint64(step)
                keys[taken] = (keys[taken] ^ seen) * np.uint64(0x9E3779B97F4A7C15)
                keys[taken] ^= keys[taken] >> np.uint64(29)
            pointer += moves[step][reps, read]
            np.minimum(pointer, self.size, out=pointer)
        return keys


def windows_at(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` words from each start, filled up with end marks behind the last word."""
    padded = np.concatenate([words, np.full(size, _END, dtype=np.int64)])
    return padded[starts[:, None] + np.arange(size)]


def fewest_edits(item: list[int], region: list[int]) -> tuple[int, int]:
    """Edits from ``item`` to the nearest run of ``region``, and where that run ends.

    Myers' bit vectors over whole numbers of any width; the run may start anywhere.
    """
    masks: dict[int, int] = defaultdict(int)
    for place, word in enumerate(item):
        masks[word] |= 1 << place
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, end = score, 0
    for place, word in enumerate(region):
        equal = masks.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, place + 1
    return best, end


class BenchmarkIndex:
    """Items of one block, entered under the keys of their walks."""

    def __init__(
        self,
        items: list[tuple[int | None, str]],
        similarity: float,
        min_words: int,
        samples: int,
        repeats: int,
    ) -> None:
        self.similarity = similarity
        split = [(item_id, words_of(text)) for item_id, text in items]
        # Too short to bear an edit: such items are looked for word by word.
        self.phrases: dict[tuple[str, ...], list[int | None]] = defaultdict(list)
        for item_id, words in split:
            if 0 < len(words) < min_words:
                self.phrases[tuple(words)].append(item_id)
        self.heads: dict[str, list[int]] = {
            head: sorted({len(phrase) for phrase in phrases})
            for head, phrases in groupby(sorted(self.phrases), key=lambda phrase: phrase[0])
        }
        split = [(item_id, words) for item_id, words in split if len(words) >= min_words]
        self.vocabulary: dict[str, int] = {}
        for _, words in split:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.width = len(self.vocabulary) + 1
        self.items = [(item_id, [self.vocabulary[word] for word in words]) for item_id, words in split]
        by_size: dict[int, list[int]] = defaultdict(list)
        for number, (_, words) in enumerate(self.items):
            by_size[len(words)].append(number)
        pairs = {code for _, words in self.items for code in self._pairs(words)}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        # Each edit spoils two neighbouring word pairs at most, so a window at the start
        # of a passage keeps at least this many pairs of its item.
        self.sizes = {}
        for size, numbers in sorted(by_size.items()):
            own = {code for number in numbers for code in self._pairs(self.items[number][1])}
            member = np.isin(self.pairs, np.array(sorted(own), dtype=np.int64))
            need = max(1, size - 1 - 2 * allowed_edits(size, similarity))
            walks = Walks(size, samples, repeats)
            table: dict[int, list[int]] = defaultdict(list)
            for number in numbers:
                words = np.array([self.items[number][1]], dtype=np.int64)
                for key in walks.keys(words, 0, repeats)[:, 0].tolist():
                    table[key].append(number)
            keys = np.array(sorted(table), dtype=np.uint64)
            lists = {
                number: np.searchsorted(self.pairs, sorted(set(self._pairs(self.items[number][1]))))
                for number in numbers
            }
            self.sizes[size] = (member, need, walks, table, keys, lists)
        self.least = min((need for _, need, *_ in self.sizes.values()), default=0)
        self.longest = max(self.sizes, default=0)

    def _pairs(self, words: list[int]) -> Iterator[int]:
        return (one * self.width + two for one, two in zip(words, words[1:]))

    @staticmethod
    def _starts(hits: np.ndarray, need: int, size: int, length: int) -> np.ndarray:
        """Starts of windows of ``size`` words that hold ``need`` of the hits."""
        far, near = hits[need - 1 :], hits[: len(hits) - need + 1]
        fits = far - near <= size - 2
        low, high = np.maximum(far[fits] - (size - 2), 0), near[fits]
        edges = np.zeros(length + 1, dtype=np.int64)
        np.add.at(edges, low, 1)
        np.add.at(edges, high + 1, -1)
        return np.nonzero(np.cumsum(edges[:-1]))[0]

    def search(self, text: str | None) -> Iterator[tuple[int | None, int, int, int]]:
        """Item id, its words, edits, and the place behind the passage, once per item found."""
        read = words_of(text)
        if self.phrases:
            yield from self._whole(read)
        if self.items:
            yield from self._passages(read)

    def _whole(self, read: list[str]) -> Iterator[tuple[int | None, int, int, int]]:
        """Short items at the first place where all their words follow each other."""
        found = set()
        for place, word in enumerate(read):
            for size in self.heads.get(word, ()):
                run = tuple(read[place : place + size])
                if run in self.phrases and run not in found:
                    found.add(run)
                    for item_id in self.phrases[run]:
                        yield item_id, size, 0, place + size

    def _passages(self, read: list[str]) -> Iterator[tuple[int | None, int, int, int]]:
        numbers = map(self.vocabulary.get, read, repeat(0))
        words = np.fromiter(numbers, dtype=np.int64, count=len(read))
        if len(words) < 2:
            return
        places = np.nonzero((words[:-1] > 0) & (words[1:] > 0))[0]
        codes = words[places] * self.width + words[places + 1]
        found = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        real = self.pairs[found] == codes
        hits, found = places[real], found[real]
        if len(hits) < self.least or not len(
            self._starts(hits, self.least, self.longest, len(words))
        ):
            return
        best: dict[int, tuple[int, int]] = {}
        for size, (member, need, walks, table, keys, lists) in self.sizes.items():
            own = member[found]
            if own.sum() < need:
                continue
            starts = self._starts(hits[own], need, size, len(words))
            if not len(starts):
                continue
            # Items of which enough pairs occur here, each as often as the item has it at most.
            seen = np.unique(found[own])
            open_items = {
                number
                for number, codes in lists.items()
                if np.isin(codes, seen).sum() + size - 1 - len(codes) >= need
            }
            if not open_items:
                continue
            # Equal windows, as of a word said again and again, walk once.
            windows, which = np.unique(
                windows_at(words, starts, size), axis=0, return_inverse=True
            )
            which = which.reshape(-1)
            tried: set[tuple[int, int]] = set()
            for low in range(0, walks.repeats, _ROUND):
                if not open_items:  # every item that may be here has been found
                    break
                probes = walks.keys(windows, low, min(low + _ROUND, walks.repeats))
                where = np.minimum(np.searchsorted(keys, probes), len(keys) - 1)
                _, columns = same = np.nonzero(keys[where] == probes)
                met: dict[int, set[int]] = defaultdict(set)
                for key, column in zip(probes[same].tolist(), columns.tolist()):
                    for number in table[key]:
                        if (number, column) not in tried:
                            tried.add((number, column))
                            met[number].update(starts[which == column].tolist())
                for number, at in met.items():
                    result = self._verified(number, sorted(at), words)
                    if result is not None:
                        open_items.discard(number)
                        best[number] = min(result, best.get(number, result))
        for number, (edits, end) in sorted(best.items()):
            item_id, item = self.items[number]
            yield item_id, len(item), edits, end

    def _verified(
        self, number: int, starts: list[int], words: np.ndarray
    ) -> tuple[int, int] | None:
        item = self.items[number][1]
        slack = allowed_edits(len(item), self.similarity)
        best = None
        place = 0
        while place < len(starts):
            low = high = starts[place]
            while place < len(starts) and starts[place] <= high + len(item):
                high, place = starts[place], place + 1
            low, high = max(0, low - slack), min(len(words), high + len(item) + slack)
            edits, end = fewest_edits(item, words[low:high].tolist())
            if edits <= slack and (best is None or (edits, low + end) < best):
                best = edits, low + end
        return best


_INDEXES: dict[str, BenchmarkIndex] = {}  # a worker's latest, for its next tasks

_LEAKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_words", pa.int64()),
        ("edits", pa.int64()),
        ("end_word", pa.int64()),
        ("similarity", pa.float64()),
    ]
)


def _indexes(
    benchmark: DataFrame,
    similarity: float = 0.8,
    min_words: int = 5,
    recall: float = 0.98,
    samples: int = 3,
    agreement: float = 0.5,
    block_items: int = 5_000,
    block_bytes: int = 32 << 20,
) -> list[Callable[[], BenchmarkIndex]]:
    """For each block of the benchmark a function that tasks call for its index."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(size[0] / block_items), math.ceil(size[1] / block_bytes))
    repeats = repetitions(agreement, samples, recall)
    if blocks > 1:
        items = written(items)
    found = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(sorted(map(tuple, part.collect()), key=repr))
        name = uuid.uuid4().hex

        def index(sent=sent, name=name) -> BenchmarkIndex:
            known = _INDEXES.get(name)
            if known is None:
                _INDEXES.clear()
                known = BenchmarkIndex(sent.value, similarity, min_words, samples, repeats)
                _INDEXES[name] = known
            return known

        found.append(index)
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document and benchmark item of which the document holds a passage.

    ``settings``, with their defaults: ``similarity`` 0.8, ``min_words`` 5, ``recall``
    0.98, ``samples`` 3, ``agreement`` 0.5, ``block_items`` 5000, ``block_bytes`` 32 MB.

    A passage is a run of words at most ``1 - similarity`` of the item's number
    of words in word edits away from it. Returns doc_id, item_id, n_words (of the
    item), edits, end_word (the word behind the passage) and similarity.

    Each document is read word by word. Windows of an item's size that keep as
    many word pairs of items of that size as a passage must are embedded by
    repeated walks (:class:`Walks`) and looked up by sampled output symbols; what
    meets is verified by its exact distance. There are as many repetitions as
    ``recall`` takes if a symbol of two windows at the limit agrees with a chance
    of ``agreement`` (0.61 on average for random edits, 0.48 or more for 95 of 100
    passages at a similarity of 0.8).

    ``edits``, ``end_word`` and ``similarity`` are those of the nearest passage that
    was met: an item found in one round of repetitions is not looked for further.

    Words are lower-case runs of letters and digits, so case and punctuation are
    no edits; in scripts without spaces each character is a word. Items of fewer
    than ``min_words`` words are found where all their words follow each other
    without an edit. Null or empty texts and texts without words hold and are no
    passages; long texts are searched as a whole, repeated documents and items
    give one row per pair of ids; an empty table on either side gives no rows.
    Other columns are not read.

    The benchmark is the stated query set. It goes to all tasks in blocks of about
    ``block_items`` items and ``block_bytes`` bytes, one pass over ``docs`` each;
    documents are not shuffled.
    """
    found = []
    for index in _indexes(benchmark, **settings):

        def rows(texts: Iterable[tuple], index=index) -> Iterator[tuple]:
            search = index().search
            for doc_id, text in texts:
                for item_id, n_words, edits, end in search(text):
                    yield doc_id, item_id, n_words, edits, end, 1 - edits / n_words

        found.append(map_rows(docs.select("doc_id", "text"), _LEAKS, rows))
    leaks = found[0]
    for more in found[1:]:
        leaks = leaks.union(more)
    nearest = F.min(F.struct("edits", "end_word", "n_words", "similarity")).alias("nearest")
    return (
        leaks.groupBy("doc_id", "item_id")
        .agg(nearest)
        .select(
            "doc_id",
            "item_id",
            "nearest.n_words",
            "nearest.edits",
            "nearest.end_word",
            "nearest.similarity",
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` in which :func:`find_leaks` finds nothing, with all columns.

    Rows are judged where they are, so no text is shuffled.
    """
    for index in _indexes(benchmark, **settings):

        docs = docs.where(_clean(index)(F.col("text")))
    return docs


def _clean(index: Callable[[], BenchmarkIndex]):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        search = index().search
        return pd.Series([next(search(text), None) is None for text in texts], dtype=bool)

    return clean
