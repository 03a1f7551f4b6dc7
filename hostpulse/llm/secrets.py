"""Secret scan: patterns, and candidates that are confirmed by what they decode to."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from hostpulse.llm.store import map_rows

# Order of kinds among spans that start together.
BASE = ("assign", "access", "hex")
CONFIRMED = ("pem", "der", "openssh", "token")
_RANK = {kind: place for place, kind in enumerate(BASE + CONFIRMED)}

# The leftmost matches that are too short still use up their text.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
# These two match whole runs, so the shortest length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# What may stand between the lines of a key: breaks, also escaped ones, and marks of quotation.
_BREAK = r"""(?:\\[nr]|[\s>|#*"',])"""
# The possessive parts keep a header without an end, before a long run of blanks, linear, and
# a line of headers never runs into the next mark.
_PEM = re.compile(
    r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----" + _BREAK + r"*+"
    r"((?:[A-Za-z][A-Za-z-]*+: (?:(?!-----)[^\n\\])*+(?:\n|\\[nr])" + _BREAK + r"*+)*+)"
    r"""([A-Za-z0-9+/=\s\\>|#*"',]++)-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"""
)
_CONCATENATED = re.compile(r"""(?:^|["'])\s*+\+\s*+["']""")  # the first quote may lie before the body
_BETWEEN = re.compile(_BREAK + r"++")
_CIPHER = re.compile(r"DEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]+)")
_NEXT_LINE = re.compile(_BREAK + r"++([A-Za-z0-9+/]++={0,2})")
_WRAPPED_BYTES = 1 << 16  # no private key is longer; bounds the lines joined from one start
_BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){30,}(?![0-9A-Fa-f])")
_TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.[A-Za-z0-9_-]*"
)

_SEQUENCE, _INTEGER, _OCTETS, _OID = 0x30, 0x02, 0x04, 0x06
_OPENSSH = b"openssh-key-v1\0"
_OPENSSH_BASE64 = base64.b64encode(_OPENSSH).decode()


def _decoded(run: str) -> bytes | None:
    plain = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of the elements that fill data[at:end] exactly."""
    found = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            width = size - 0x80
            if not 1 <= width <= 4 or at + width > end:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > end:
            return None
        found.append((tag, at, at + size))
        at += size
    return found


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    inner = _elements(data, *element[1:]) if element[0] == _SEQUENCE else None
    return bool(inner) and inner[0][0] == _OID


def is_private_key(data: bytes) -> bool:
    """Whether nested lengths and tags make a private key: RSA, EC, plain or encrypted PKCS 8."""
    outer = _elements(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = _elements(data, *outer[0][1:]) or []
    tags = [tag for tag, _, _ in parts]
    if len(tags) >= 9 and set(tags[:9]) == {_INTEGER}:
        return parts[0][2] - parts[0][1] == 1
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS]:
        return _algorithm(data, parts[1])
    if tags[:2] == [_INTEGER, _OCTETS]:
        return data[parts[0][1] : parts[0][2]] == b"\x01" and parts[1][2] - parts[1][1] >= 16
    return tags == [_SEQUENCE, _OCTETS] and _algorithm(data, parts[0])


def is_openssh_key(data: bytes) -> bool:
    """Whether the data is a private key file of OpenSSH, by its mark and nested lengths."""
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        if at + 4 > len(data):
            return False
    return 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def is_signed_token(header: str, claims: str) -> bool:
    """Whether both parts are JSON objects and the first names an algorithm."""
    try:
        parsed = [json.loads(_decoded(part) or b"") for part in (header, claims)]
    except (ValueError, RecursionError):
        return False
    return all(isinstance(part, dict) for part in parsed) and isinstance(parsed[0].get("alg"), str)


def is_encrypted_body(headers: str, data: bytes) -> bool:
    """Whether the headers name a cipher and its start value, whose blocks the data fills."""
    named = _CIPHER.search(headers)
    block = len(named[1]) // 2 if named else 0
    return block in (8, 16) and len(data) >= 32 and len(data) % block == 0


def _bare(body: str) -> str:
    """A key's body without line breaks, quotation marks and string concatenation."""
    return _BETWEEN.sub("", _CONCATENATED.sub("", body))


def _stated_size(data: bytes) -> int | None:
    """The bytes of a key that begins so, by the lengths stated at its beginning.

    None if it isn't the beginning of a key. What OpenSSH states lies further in, so its
    size is known once all lengths but the last part are there.
    """
    if data.startswith(_OPENSSH):
        at, keys = len(_OPENSSH), None
        parts = 3  # cipher, key derivation, its options
        while parts:
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            parts -= 1
            if at + 4 > len(data):
                return None
            if not parts and keys is None:
                keys = parts = int.from_bytes(data[at : at + 4], "big")
                if not 1 <= keys <= 16:
                    return None
                at += 4
        return at + 4 + int.from_bytes(data[at : at + 4], "big")
    if len(data) < 12 or data[0] != _SEQUENCE:
        return None
    at, size = 2, data[1]
    if size >= 0x80:
        width = size - 0x80
        if not 1 <= width <= 4:
            return None
        at, size = 2 + width, int.from_bytes(data[2 : 2 + width], "big")
    begins = data[at : at + 2] == b"\x02\x01" or data[at] == _SEQUENCE
    return at + size if begins else None


def _joined(text: str, start: int, end: int) -> tuple[bytes, int] | None:
    """A key that begins with the run and goes on in lines of its width; its bytes and its end."""
    width, lines = end - start, [(start, end)]
    openssh = text.startswith(_OPENSSH_BASE64[:19], start)
    size = None if openssh else _stated_size(_decoded(text[start : start + 16]) or b"")
    if not openssh and (size is None or size > _WRAPPED_BYTES):
        return None
    most = -(-(size or _WRAPPED_BYTES) // 3) * 4
    held = width
    while held < most and (following := _NEXT_LINE.match(text, end)):
        begin, end = following.span(1)
        if end - begin > width:
            break
        lines.append((begin, end))
        held += end - begin
        if end - begin < width:
            break
    run = "".join(text[begin:end] for begin, end in lines)
    if openssh:
        size = _stated_size(_decoded(run[: len(run.rstrip("=")) // 4 * 4]) or b"")
        if size is None:
            return None
    whole, rest = divmod(size, 3)
    wanted = whole * 4 + (rest and rest + 1)
    data = _decoded(run[:wanted])
    if not data or len(data) != size:
        return None
    for begin, end in lines:
        if wanted <= end - begin:
            padded = begin + wanted
            while padded < end and text[padded] == "=":
                padded += 1
            return data, padded
        wanted -= end - begin
    return None


def _confirmed(text: str) -> Iterator[tuple[int, str, int]]:
    armoured = []
    for match in _PEM.finditer(text):
        data = _decoded(_bare(match[2]))
        if data and (
            is_encrypted_body(match[1], data) or is_private_key(data) or is_openssh_key(data)
        ):
            armoured.append(match.span())
            yield match.start(), "pem", match.end()
    for match in _HEX_RUN.finditer(text):
        if match[0].startswith("30") and is_private_key(bytes.fromhex(match[0])):
            yield match.start(), "der", match.end()
        elif match[0].startswith("6") and is_openssh_key(bytes.fromhex(match[0])):
            yield match.start(), "openssh", match.end()
    inside, reached = iter([*armoured, (len(text), len(text))]), 0
    begin, close = next(inside)
    for match in _BASE64_RUN.finditer(text):
        start, end = match.span()
        if text[start] in "nr" and start and text[start - 1] == "\\":
            start += 1  # the letter belongs to an escaped break
        # The first letter of an encoded sequence, or of the mark; lines of a key found are done.
        if start < reached or text[start] not in "Mb":
            continue
        while close <= start and begin < len(text):
            begin, close = next(inside)
        data = _decoded(text[start:end])
        if data and is_private_key(data):
            yield start, "der", end
            continue
        alone = bool(data) and is_openssh_key(data)
        wrapped = None if begin <= start < close else _joined(text, start, end)
        if wrapped and is_private_key(wrapped[0]):
            reached = wrapped[1]
            yield start, "der", reached
        elif wrapped and is_openssh_key(wrapped[0]):
            reached = wrapped[1]
            yield start, "openssh", reached
        elif alone:
            yield start, "openssh", end
    for match in _TOKEN.finditer(text):
        if is_signed_token(match[1], match[2]):
            yield match.start(), "token", match.end()


def _base(text: str) -> Iterator[tuple[int, str, int]]:
    for match in _ASSIGN.finditer(text):
        if len(match[2]) >= 6:
            yield match.start(), "assign", match.end()
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        for match in pattern.finditer(text):
            yield match.start(), kind, match.end()


def secrets_in(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) of all findings, in order."""
    found = [] if not text else [*_base(text), *_confirmed(text)]
    found.sort(key=lambda span: (span[0], _RANK[span[1]], span[2]))
    return [(kind, start, end) for start, kind, end in found]


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        (
            "findings",
            pa.list_(
                pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            ),
        ),
    ]
)


def _scan(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield (
            doc_id,
            [dict(zip(("kind", "start", "end"), span)) for span in secrets_in(text)],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``findings`` (kind, start, end) of every row of ``docs``.

    The kinds ``assign``, ``access`` and ``hex`` are patterns. The others are
    reported only once confirmed: ``pem``, ``der`` and ``openssh`` decode to a
    private key whose nested lengths add up, ``token`` to a JSON header that
    names an algorithm and JSON claims. A ``pem`` with a cipher in its headers has no
    readable structure; its body must fill the cipher's blocks. Lines may be broken by
    escapes, quoted line by line or joined as strings, and base64 without armour may be
    wrapped in lines of one width (at least 40, keys up to 64 KiB). Kinds may overlap;
    within one they don't.

    A null or empty text has no findings, a null ``doc_id`` stays null, repeated
    rows are scanned each, other columns are not read. One pass, no shuffle; a
    task holds one Arrow batch of texts.
    """
    return map_rows(docs.select("doc_id", "text"), _FOUND, _scan)
