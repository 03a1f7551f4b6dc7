"""Encoding with a merge-type piece model, by a table of each prefix's last token."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from hostpulse.llm.store import map_rows

SPACE = "▁"
_KEPT = 400_000  # segments whose ids a worker remembers, of up to _SHORT characters each
_SHORT = 48
_PAIRS = 1_000_000  # tested pairs a worker remembers


class _Remembered(dict):
    """Ids of segments; a segment that is not here is encoded, and kept while there is room."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, segment: str) -> bytes:
        ids = self._encode(segment)
        if len(segment) <= _SHORT:
            if len(self) >= _KEPT:
                self.clear()
            self[segment] = ids
        return ids


class PieceEncoder:
    """Ids for texts, as the model's own library gives them.

    Merging joins, again and again, the neighbours whose joint piece scores best,
    the leftmost first. A sequence of pieces is what merging arrives at if and
    only if that holds for every two neighbours alone. So each prefix of a text
    has exactly one last token: a piece that ends there, that merging arrives at,
    and that is compatible with the last token of the prefix before it. The
    pieces that end at a place come from an automaton over all pieces; the table
    is filled from the left, and the ids are read from it backwards. Time and
    memory are linear in the length of the text.
    """

    def __init__(self, model: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.library.get_piece_size()
        special = {
            place
            for place in range(size)
            if self.library.is_control(place)
            or self.library.is_unknown(place)
            or self.library.is_byte(place)
        }
        if any(self.library.is_unused(place) for place in range(size)):
            raise ValueError("models with unused pieces merge by other rules")
        self.ids = {
            self.library.id_to_piece(place): place for place in range(size) if place not in special
        }
        self.scores = {piece: self.library.get_score(place) for piece, place in self.ids.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{value:02X}>") for value in range(256)]
        if self.library.unk_id() in self.bytes:
            raise ValueError("the model must spell unknown characters as bytes")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self._whole: dict[str, bool] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._segments = self._segment_pattern()
        self._remembered = _Remembered(self._segment_ids)

    def _segment_pattern(self) -> re.Pattern:
        """Segments that no piece crosses: none holds a space after another character."""
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            return re.compile(r".+", re.DOTALL)
        joined = set().union(*(piece for piece in self.ids if len(piece) > 1)) - {SPACE}
        letters = "".join(map(re.escape, sorted(joined)))
        return re.compile(f"{SPACE}+[{letters}]*|[{letters}]+|[^{SPACE}{letters}]", re.DOTALL)

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            scored = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
            best = max((score for score in scored if score is not None), default=None)
            if best is None:
                break
            place = scored.index(best)
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def _is_whole(self, piece: str) -> bool:
        known = self._whole.get(piece)
        if known is None:
            known = self._whole[piece] = self._merged(piece) == [piece]
        return known

    def _compatible(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= _PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = self._merged(left + right) == [left, right]
        return known

    def _last_tokens(self, segment: str) -> list[str]:
        """For each prefix of the segment the last token of its encoding."""
        last: list[str | None] = [None] * len(segment)
        for end, piece in self.automaton.iter(segment):
            if last[end] is None and self._is_whole(piece):
                before = end - len(piece)
                if before < 0 or self._compatible(last[before] or segment[before], piece):
                    last[end] = piece
        return [piece or segment[place] for place, piece in enumerate(last)]

    def _segment_ids(self, segment: str) -> bytes:
        last, end, ids = self._last_tokens(segment), len(segment), []
        while end:
            piece = last[end - 1]
            known = self.ids.get(piece)
            if known is None:
                ids.extend(self.bytes[value] for value in reversed(piece.encode()))
            else:
                ids.append(known)
            end -= len(piece)
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text between begin and end, as little-endian 32-bit numbers."""
        segments = self._segments.findall(self.library.normalize(text or ""))
        inner = b"".join(map(self._remembered.__getitem__, segments))
        ends = np.array([self.library.bos_id(), self.library.eos_id()], dtype="<u4").tobytes()
        return np.frombuffer(ends[:4] + inner + ends[4:], dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@cache
def _encoder(model: str) -> PieceEncoder:
    """One per worker process."""
    if not model.startswith("/"):
        import public_tokenizers

        model = public_tokenizers.path(model)
    return PieceEncoder(model)


_OUTPUTS = {
    "n_tokens": (pa.int64(), lambda ids, text: len(ids)),
    "ids": (pa.list_(pa.int32()), lambda ids, text: ids.astype(np.int32)),
    "decoded": (pa.string(), lambda ids, text: text),
    "ids_sha256": (pa.string(), lambda ids, text: hashlib.sha256(ids.tobytes()).hexdigest()),
    "decoded_sha256": (
        pa.string(),
        lambda ids, text: hashlib.sha256(text.encode()).hexdigest(),
    ),
}


def encode_pieces(
    docs: DataFrame, model: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")
) -> DataFrame:
    """``doc_id`` and the wanted ``outputs`` for every row of ``docs``.

    ``model`` is the path of a piece model on the executors, or the name of a
    public one, which each executor finds itself. Outputs: ``n_tokens``, ``ids``
    (begin and end included), ``decoded`` (what the model makes of the ids), and
    the digests ``ids_sha256`` (of little-endian 32-bit ids) and ``decoded_sha256``.

    A null text is empty and has the two ids of begin and end. Null ids stay
    null, repeated rows are encoded each, and other columns are not read. One
    pass, no shuffle. A worker holds one Arrow batch of texts, the model, the
    tested pairs and the ids of up to 400,000 short segments.
    """
    wanted = [_OUTPUTS[name] for name in outputs]

    def rows(texts: Iterable[tuple]) -> Iterator[tuple]:
        encoder = _encoder(model)
        for doc_id, text in texts:
            ids = encoder.encode(text)
            decoded = encoder.decode(ids)
            yield doc_id, *(make(ids, decoded) for _, make in wanted)

    schema = pa.schema(
        [("doc_id", pa.int64()), *((name, kind) for name, (kind, _) in zip(outputs, wanted))]
    )
    return map_rows(docs.select("doc_id", "text"), schema, rows, batch=200)
