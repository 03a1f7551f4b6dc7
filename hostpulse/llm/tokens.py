"""Token ids in a binary file format: frequency ranks, one to four bytes each, lengths apart."""

from __future__ import annotations

import json
import posixpath
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, tee

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, scratch, written

_SHORT = 48  # characters of the longest text whose ids a worker remembers
_RUNS, _PARTS = 500_000, 500_000  # how many a worker remembers anew before it forgets old ones
_GROUP = 1 << 20  # characters of the texts that are encoded together
_BLOCK_IDS = 1 << 16


# Ids of texts

# Fixed value: the split of a word tokenizer that drops white space.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANKS = "\n\t\r"
_MARKS = r"!-&(-/:-@\[-`{-~"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
# Between a Latin letter and an ASCII mark that is no apostrophe that split always cuts.
_EDGE = re.compile(rf"(?<=[{_LETTERS}])(?=[{_MARKS}])|(?<=[{_MARKS}])(?=[{_LETTERS}])")
# Letters that are composed already, have one lower-case letter each, and make one word.
_LATIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LATIN_LOWER = "".join(map(chr, (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100))))


class _Remembered:
    """Ids by text in two generations: what is asked for again outlives what is not."""

    def __init__(self, number: int) -> None:
        self._number = number
        self._old: dict[str, bytes] = {}
        self.ids: dict[str, bytes] = {}
        self._long: list[str] = []

    def missing(self, texts: Iterable[str]) -> list[str]:
        """Those of ``texts`` without ids, after the old generation's were taken over."""
        old, ids, left = self._old, self.ids, []
        for text in set(texts).difference(ids):
            known = old.get(text)
            if known is None:
                left.append(text)
            else:
                ids[text] = known
        return left

    def add(self, text: str, ids: bytes) -> None:
        self.ids[text] = ids
        if len(text) > _SHORT:
            self._long.append(text)

    def rest(self) -> None:
        """Forget long texts, and the old generation when the new one is full."""
        for text in self._long:
            self.ids.pop(text, None)
        self._long.clear()
        if len(self.ids) >= self._number:
            self._old, self.ids = self.ids, {}


class TextEncoder:
    """Ids of a text as the tokenizer's own library gives them, without special tokens added.

    A tokenizer that lower-cases, drops white space and splits into words encodes
    runs of text between blanks, and their parts between letters and marks, each for
    itself: a worker remembers their ids. New parts of Latin letters go to the library's
    model, if nothing but lower-casing and bytes written as letters comes before it;
    other new parts go to the library together, with a special token between them. Any
    other tokenizer gets whole texts.
    """

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(model)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        added = self.library.get_added_tokens_decoder()
        self._added = [token.content for token in added.values()]
        special = [(token.content, id_) for id_, token in added.items() if token.special]
        self._between = special[0] if special else None
        self._parted = self._splits_at_blanks()
        self._letters = self._letters_of_bytes() if self._parted else None
        self._model = self.library.model
        self._runs = _Remembered(_RUNS)
        self._parts = _Remembered(_PARTS)

    def _splits_at_blanks(self) -> bool:
        told = json.loads(self.library.to_str())
        normal, split = told.get("normalizer") or {}, told.get("pre_tokenizer") or {}
        steps = {step.get("type") for step in normal.get("normalizers", [normal])}
        first = (split.get("pretokenizers") or [split])[0]
        return (
            steps <= {"NFC", "Replace", "Lowercase"}
            and first.get("type") == "Split"
            and first.get("pattern") == {"Regex": _WORDS}
            and (first.get("behavior"), first.get("invert")) == ("Removed", True)
            and not any(set(token) & {" ", *_BLANKS} for token in self._added)
        )

    def _letters_of_bytes(self) -> dict[int, str] | None:
        """How the model's input writes lower-case letters; None if more than that is done to a word."""
        from tokenizers.pre_tokenizers import ByteLevel

        told = json.loads(self.library.to_str())
        normal, split = told.get("normalizer") or {}, told["pre_tokenizer"]
        steps = normal.get("normalizers", [normal])
        replaced = [step.get("pattern") for step in steps if step["type"] == "Replace"]
        last = (split.get("pretokenizers") or [split])[1:]
        plain = (
            any(step["type"] == "Lowercase" for step in steps)
            and all(pattern == {"Regex": r"\s+"} for pattern in replaced)
            and [step.get("type") for step in last] == ["ByteLevel"]
            and (last[0].get("add_prefix_space"), last[0].get("use_regex")) == (False, False)
            and told.get("post_processor") is None
            and told.get("truncation") is None
            and told.get("padding") is None
        )
        if not plain:
            return None
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {ord(letter): written(letter)[0][0] for letter in _LATIN_LOWER}

    def _learn_words(self, words: list[str]) -> None:
        letters, tokenize = self._letters, self._model.tokenize
        ids, ends = [], []
        for word in words:
            word = word.lower()
            found = tokenize(word if word.isascii() else word.translate(letters))
            ids += [token.id for token in found]
            ends.append(len(ids))
        numbers = np.array(ids, dtype=self.dtype)
        raw, width, start = numbers.tobytes(), numbers.itemsize, 0
        for word, end in zip(words, ends):
            self._parts.add(word, raw[start * width : end * width])
            start = end

    def _library_ids(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        if self._letters is not None:
            words = [part for part in parts if _LATIN_WORD.fullmatch(part)]
            self._learn_words(words)
            parts = list(set(parts).difference(words))
            if not parts:
                return
        if self._between is None:
            for part in parts:
                self._parts.add(part, self._library_ids(part))
            return
        text, mark = self._between
        ids = self._library_ids(f" {text} ".join(parts))
        numbers = np.frombuffer(ids, dtype=self.dtype)
        ends = [*np.nonzero(numbers == mark)[0].tolist(), len(numbers)]
        if len(ends) != len(parts):
            raise ValueError("a special token within a part")
        width, start = numbers.itemsize, 0
        for part, end in zip(parts, ends):
            self._parts.add(part, ids[start * width : end * width])
            start = end + 1

    def _learn_runs(self, runs: list[str]) -> None:
        joined = " ".join(runs)
        added = [token for token in self._added if token in joined]
        whole = [run for run in runs if any(token in run for token in added)] if added else []
        for run in whole:
            self._runs.add(run, self._library_ids(run))
        rest = set(runs).difference(whole)
        # The tokenizer lower-cases; in plain ASCII Python does so alike.
        split = {}
        for run in rest:
            lower = run.lower() if run.isascii() else run
            split[run] = [lower] if lower.isalpha() else _EDGE.split(lower)
        new = self._parts.missing(chain.from_iterable(split.values()))
        if new:
            self._learn_parts(new)
        ids = self._parts.ids
        for run, parts in split.items():
            known = ids[parts[0]] if len(parts) == 1 else b"".join([ids[part] for part in parts])
            self._runs.add(run, known)
        self._parts.rest()

    def _together(self, texts: list[str]) -> list[bytes]:
        split = []
        for text in texts:
            for blank in _BLANKS:
                text = text.replace(blank, " ")
            split.append(text.split(" "))
        new = self._runs.missing(chain.from_iterable(split))
        if new:
            self._learn_runs(new)
        known = self._runs.ids.__getitem__
        found = [b"".join(map(known, runs)) for runs in split]
        self._runs.rest()
        return found

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian ids of each text, two bytes each if the vocabulary allows, else four."""
        held, size = [], 0
        for text in texts:
            text = text or ""
            if not self._parted:
                yield self._library_ids(text)
                continue
            held.append(text)
            size += len(text)
            if size >= _GROUP:
                yield from self._together(held)
                held, size = [], 0
        if held:
            yield from self._together(held)


@cache
def _encoder(model: str) -> TextEncoder:
    """One per worker process."""
    if not model.startswith("/"):
        import public_tokenizers

        model = public_tokenizers.path(model)
    return TextEncoder(model)


# The code: per number one to four bytes, four lengths to a control byte

# Lengths of the four numbers whose control byte is the row: two bits each, lowest first.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers below 2**32."""
    numbers = numbers.astype("<u4")
    marks = np.zeros(-(-len(numbers) // 4) * 4, dtype=np.uint8)
    more = marks[: len(numbers)]  # bytes beyond the first
    largest, width = int(numbers.max(initial=0)), 1
    while largest >= 1 << 8 * width:
        more += numbers >= 1 << 8 * width
        width += 1
    used = np.arange(width, dtype=np.uint8) <= more[:, None]
    data = numbers.view(np.uint8).reshape(-1, 4)[:, :width][used]
    control = (marks.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again: lengths by table look-up, places by their running sum."""
    sizes = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:count]
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, dtype=np.uint8)
    numbers = raw[starts].astype(np.uint32)
    for place in range(1, int(sizes.max(initial=1))):
        longer = np.nonzero(sizes > place)[0]
        numbers[longer] |= raw[starts[longer] + place].astype(np.uint32) << np.uint32(8 * place)
    return numbers


# Files: a header with the ids by rank, then blocks of whole documents

_MAGIC = b"HPTOKEN1"
_HEADER = "<8sI"  # magic, number of ranked ids
_BLOCK = "<IQIIII"  # documents, ids, and the bytes of four parts


def _file_header(ranked: np.ndarray) -> bytes:
    return struct.pack(_HEADER, _MAGIC, len(ranked)) + ranked.astype("<u4").tobytes()


def _block(doc_ids: list[int | None], lengths: list[int], ranks: np.ndarray) -> bytes:
    """Document ids (with their nulls), lengths, and the coded ranks of one block."""
    absent = np.array([doc is None for doc in doc_ids])
    docs = np.array([doc or 0 for doc in doc_ids], dtype="<i8")
    head = docs.tobytes() + np.packbits(absent).tobytes()
    sizes = np.array(lengths, dtype="<u8").tobytes()
    control, data = pack(ranks)
    return b"".join(
        [
            struct.pack(_BLOCK, len(docs), len(ranks), len(head), len(sizes), len(control), len(data)),
            head,
            sizes,
            control,
            data,
        ]
    )


def _read_block(raw: bytes, ranked: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    count, total, *parts = struct.unpack_from(_BLOCK, raw)
    places = np.cumsum([struct.calcsize(_BLOCK), *parts])
    head, sizes, control, data = (raw[a:b] for a, b in zip(places, places[1:]))
    docs = np.frombuffer(head, dtype="<i8", count=count)
    absent = np.unpackbits(np.frombuffer(head[8 * count :], dtype=np.uint8))[:count]
    ids = ranked[unpack(control, data, total)]
    ends = np.cumsum(np.frombuffer(sizes, dtype="<u8")).astype(np.int64)
    for doc, gone, end, start in zip(docs, absent, ends, [0, *ends[:-1]]):
        yield None if gone else int(doc), ids[start:end]


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
_COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64())])
_WRITTEN = pa.schema(
    [
        ("part", pa.int64()),
        ("block", pa.int64()),
        ("file", pa.string()),
        ("place", pa.int64()),
        ("bytes", pa.int64()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
    ]
)
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def encode_texts(docs: DataFrame, model: str, end_id: int) -> DataFrame:
    """``doc_id`` and little-endian ids (two or four bytes each) of every text and its end.

    One more row a partition has no ids but ``counts``: the ids that occur there,
    and how often, as pairs of 64-bit numbers.
    """

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        encoder = _encoder(model)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        counts = np.zeros(max(encoder.size, end_id + 1), dtype=np.int64)
        one, two = tee(found)
        for (doc_id, _), ids in zip(one, encoder.encode(text for _, text in two)):
            ids += end
            here = np.bincount(np.frombuffer(ids, dtype=encoder.dtype))
            counts[: len(here)] += here
            yield doc_id, ids, None
        present = np.nonzero(counts)[0]
        if len(present):
            yield None, None, np.stack([present, counts[present]], axis=1).astype("<i8").tobytes()

    return written(map_rows(docs.select("doc_id", "text"), _ENCODED, rows, batch=200))


def rank_ids(encoded: DataFrame) -> np.ndarray:
    """All ids that occur, the most frequent first, equal counts by id.

    Counted over all rows. The driver gets one row per id of the vocabulary at most.
    """

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        for (counts,) in found:
            yield from map(tuple, np.frombuffer(counts, dtype="<i8").reshape(-1, 2).tolist())

    counted = map_rows(encoded.where("counts IS NOT NULL").select("counts"), _COUNTS, rows, batch=5000)
    total = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([row.id for row in sorted(total, key=lambda row: (-row.n, row.id))], dtype="<u4")


@dataclass(frozen=True)
class TokenFiles:
    """Where the written files lie, and one row per block: part, block, file, place, bytes,
    start (ids before it in its file) and n_ids. Parts ascend with the documents' ids."""

    folder: str
    blocks: DataFrame

    def part_starts(self) -> dict[int, int]:
        """Ids before each part; the driver holds one number per file."""
        sums = self.blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
        starts, before = {}, 0
        for row in sums:
            starts[row.part] = before
            before += row.n
        return starts


def write_token_files(encoded: DataFrame, folder: str, model: str) -> TokenFiles:
    """Write ``encoded`` in ascending ``doc_id`` order, one file per range of ids.

    Files hold ranks in place of ids, so the most frequent 256 ids take one byte;
    each begins with the ids by rank. A file's name carries the task's attempt, and
    only files whose tasks ended are in ``blocks``.
    """
    ranked = rank_ids(encoded)
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, dtype=np.uint32)
    rank_of[ranked] = np.arange(len(ranked))

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        encoder, out, block, place, start = _encoder(model), None, 0, 0, 0
        docs, lengths, held, size = [], [], [], 0
        task = TaskContext.get()
        part = task.partitionId()
        name = f"ids-{part:06d}-{task.taskAttemptId()}.bin"

        def flush() -> tuple:
            nonlocal block, place, start, size
            raw = _block(docs, lengths, rank_of[np.concatenate(held)])
            out.write(raw)
            row = (part, block, name, place, len(raw), start, size)
            block, place, start, size = block + 1, place + len(raw), start + size, 0
            for part_ in (docs, lengths, held):
                part_.clear()
            return row

        for doc_id, ids in found:
            if out is None:
                store, path = _store(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(posixpath.join(path, name), compression=None)
                header = _file_header(ranked)
                out.write(header)
                place = len(header)
            numbers = np.frombuffer(ids, dtype=encoder.dtype)
            docs.append(doc_id)
            lengths.append(len(numbers))
            held.append(numbers)
            size += len(numbers)
            if size >= _BLOCK_IDS:
                yield flush()
        if docs:
            yield flush()
        if out is not None:
            out.close()

    # A doc_id that many rows share may span ranges; rows that agree entirely may change places.
    order = ["doc_id", "digest", "copy"]
    keyed = encoded.where("ids IS NOT NULL").withColumns(
        {"digest": F.xxhash64("ids"), "copy": F.monotonically_increasing_id()}
    )
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return TokenFiles(folder, written(map_rows(ranges.select("doc_id", "ids"), _WRITTEN, rows)))


def read_token_files(files: TokenFiles) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian, four
    bytes each) of every document, decoded from the files block by block."""
    folder, starts = files.folder, files.part_starts()

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        store, path = _store(folder)
        opened, file, ranked = None, None, None
        for part, name, place, size, start in found:
            if name != opened:
                if file is not None:
                    file.close()
                opened, file = name, store.open_input_file(posixpath.join(path, name))
                magic, count = struct.unpack(_HEADER, file.read(struct.calcsize(_HEADER)))
                if magic != _MAGIC:
                    raise ValueError(f"{name} is no file of token ids")
                ranked = np.frombuffer(file.read(4 * count), dtype="<u4")
            file.seek(place)
            before = starts[part] + start
            for doc_id, ids in _read_block(file.read(size), ranked):
                yield doc_id, before, ids.astype("<u4").tobytes()
                before += len(ids)
        if file is not None:
            file.close()

    # By number, as adaptive execution would merge so small rows into few tasks.
    run = F.floor(F.col("block") / 64)
    runs = files.blocks.where("block % 64 = 0").count()
    spread = files.blocks.repartition(max(1, runs), "part", run)
    spread = spread.sortWithinPartitions("part", "block")
    return map_rows(spread.select("part", "file", "place", "bytes", "start"), _READ, rows, batch=200)


def token_files(
    docs: DataFrame, model: str, end_id: int = 1, folder: str | None = None
) -> DataFrame:
    """Encode ``docs``, write their ids to files, and read those back.

    ``model`` is the path of a tokenizer file on the executors, or the name of a
    public one, which each executor finds itself. Each document ends with
    ``end_id``. Returns doc_id, start (ids of all documents before it in ascending
    order of doc_id) and ids for every row of ``docs``. The files stay in ``folder``,
    by default a new one in the shared folder.

    A null text is empty and has the one end id; texts of any length are encoded
    whole and lie in one block. A null ``doc_id`` comes first and stays null. Rows of
    one ``doc_id`` are written each, in an order by their ids. An empty table gives
    no files and no rows. Other columns are not read.
    """
    folder = folder or scratch(docs.sparkSession)
    encoded = encode_texts(docs, model, end_id)
    return read_token_files(write_token_files(encoded, f"{folder}/ids", model))


def checked_ids(read: DataFrame) -> DataFrame:
    """Number and CRC-32 of each document's ids."""
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
