"""WARC archives: write them, make every record its own gzip member, and read by offset."""

from __future__ import annotations

import gzip
import posixpath
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import map_rows, scratch, written

_GZIP = 31  # zlib's window bits for one gzip member
_CHUNK = 1 << 20
_RUN = 2048  # records of an archive that are read in a row
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # pages have no date


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def _record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": _DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
    }
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    block = _HTTP.format(len(payload)).encode()
    if refers_to is None:
        block += payload
    else:
        headers |= {"WARC-Profile": _SAME, "WARC-Refers-To": _record_id(refers_to)}
    headers |= {
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _headers(stream: BinaryIO) -> tuple[bytes, dict[str, str]] | None:
    """The next record's headers, as they are and parsed; None at the end of the stream."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record starts with {line[:40]!r}")
    raw, parsed = [line], {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        raw.append(line)
        name, _, value = line.decode().partition(":")
        parsed[name.strip().lower()] = value.strip()
    return b"".join(raw) + b"\r\n", parsed


_ARCHIVE = pa.schema([("archive", pa.string()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str, target_bytes: int = 1 << 30) -> DataFrame:
    """``archive`` and ``records`` of the gzip streams now written to ``folder``.

    ``pages`` has page_id, url, html, digest and refers_to. Each task writes its
    pages to one stream after another, each of about ``target_bytes`` before
    compression, under names of its own attempt; only names that tasks returned
    count, so a lost or repeated task leaves at most files that nobody reads.
    """

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        store, path = _store(folder)
        task = TaskContext.get()
        store.create_dir(path, recursive=True)
        part, out, squeeze, size, count = 0, None, None, 0, 0
        for page_id, url, html, digest, refers_to in found:
            if out is None:
                name = f"pages-{task.partitionId()}-{task.taskAttemptId()}-{part}.warc.gz"
                out = store.open_output_stream(posixpath.join(path, name), compression=None)
                squeeze, size, count = zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0, 0
            record = _record(page_id, url, (html or "").encode(), digest, refers_to)
            out.write(squeeze.compress(record))
            size, count = size + len(record), count + 1
            if size >= target_bytes:
                out.write(squeeze.flush())
                out.close()
                yield name, count
                part, out = part + 1, None
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield name, count

    wanted = pages.select("page_id", "url", "html", "digest", "refers_to")
    return written(map_rows(wanted, _ARCHIVE, rows))


_INDEX = pa.schema(
    [
        ("archive", pa.string()),
        ("record", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
    ]
)


def _members(stream: BinaryIO, out: pa.NativeFile) -> Iterator[tuple[int, int]]:
    """Copy each record of an inflated stream to a gzip member; yield its place and length."""
    start = 0
    while (found := _headers(stream)) is not None:
        raw, parsed = found
        squeeze = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
        pieces, left = [squeeze.compress(raw)], int(parsed["content-length"])
        length = 0
        while left:
            data = stream.read(min(left, _CHUNK))
            if not data:
                raise EOFError("the archive ends within a record")
            left -= len(data)
            pieces.append(squeeze.compress(data))
            length += sum(map(len, pieces))
            out.write(b"".join(pieces))
            pieces.clear()
        pieces.append(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        length += sum(map(len, pieces))
        out.write(b"".join(pieces))
        yield start, length
        start += length


def normalize_archives(archives: DataFrame, source: str, target: str) -> DataFrame:
    """``archive``, ``record``, ``start``, ``length``: where each record now lies in ``target``.

    Each archive of ``source``, be it one gzip stream or several members, is
    inflated once from front to back and rewritten with one member per record.
    Beside it goes ``<archive>.idx`` with a line ``start length`` per record. One
    task per archive, in memory of one chunk. Names carry the attempt.
    """

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        store, path = _store(target)
        origin, folder = _store(source)
        store.create_dir(path, recursive=True)
        for (archive,) in found:
            name = f"{TaskContext.get().taskAttemptId()}-{archive}"
            place = posixpath.join(path, name)
            with (
                origin.open_input_stream(posixpath.join(folder, archive), compression=None) as raw,
                gzip.GzipFile(fileobj=raw) as stream,
                store.open_output_stream(place, compression=None) as out,
                store.open_output_stream(place + ".idx", compression=None) as index,
            ):
                for record, (start, length) in enumerate(_members(stream, out)):
                    index.write(f"{start} {length}\n".encode())
                    yield name, record, start, length

    # By number, as adaptive execution would merge so few and small rows into one task.
    spread = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return written(map_rows(spread, _INDEX, rows))


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` points to, each fetched by its place alone.

    ``payload_bytes`` and ``payload_digest`` are of the full payload: as its
    headers say for a revisit, checked against the payload for a response.
    ``payload`` is null for a revisit, and everywhere without ``payloads``.
    """

    def rows(found: Iterable[tuple]) -> Iterator[tuple]:
        import hashlib
        import io

        store, path = _store(folder)
        opened, file = None, None
        for archive, start, length in found:
            if archive != opened:
                if file is not None:
                    file.close()
                opened, file = archive, store.open_input_file(posixpath.join(path, archive))
            file.seek(start)
            stream = io.BytesIO(gzip.decompress(file.read(length)))
            _, headers = _headers(stream)
            block = stream.read(int(headers["content-length"]))
            _, _, payload = block.partition(b"\r\n\r\n")
            digest = headers["warc-payload-digest"].removeprefix("sha256:")
            size = int(headers["x-payload-length"])
            revisit = headers["warc-type"] == "revisit"
            if not revisit and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                raise ValueError(f"{archive} at {start}: payload and headers differ")
            yield (
                _page_id(headers["warc-record-id"]),
                size,
                digest,
                headers["warc-type"],
                _page_id(headers.get("warc-refers-to")),
                payload if payloads and not revisit else None,
            )
        if file is not None:
            file.close()

    # Records of an archive stay in runs, and a large archive is read by several tasks.
    part = F.floor(F.col("record") / _RUN)
    runs = index.where(F.col("record") % _RUN == 0).count()
    spread = index.repartition(max(1, runs), "archive", part).sortWithinPartitions(
        "archive", "start"
    )
    return map_rows(spread.select("archive", "start", "length"), _READ, rows, batch=64)


def with_revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest`` and ``refers_to``.

    Of rows with equal payloads of ``min_bytes`` or more, those with the smallest
    ``page_id`` refer to nothing, the others to it. A row without a ``page_id``
    neither refers nor is referred to.
    """
    html = F.coalesce("html", F.lit(""))
    facts = pages.select("page_id", "html").select(
        "page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size")
    )
    facts = written(facts.where(f"size >= {min_bytes} AND page_id IS NOT NULL"))
    first = (
        facts.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where("refers_to < last")
        .select("digest", "refers_to")
    )
    again = (
        facts.join(written(first), "digest")
        .where("page_id > refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )
    return (
        pages.select("page_id", "url", "html", F.sha2(html, 256).alias("digest"))
        .join(again, ["page_id", "digest"], "left")
        .select("page_id", "url", "html", "digest", "refers_to")
    )


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 100,
    target_bytes: int = 1 << 30,
    payloads: bool = True,
) -> DataFrame:
    """Write ``pages`` as WARC records, normalise the archives, and read them back.

    Returns page_id, payload_bytes, payload_digest (SHA-256 in hex), record_type
    (``response`` or ``revisit``), refers_to and payload for every row of
    ``pages``. The archives stay in ``folder`` (by default a new one in the shared
    folder): gzip streams in ``streams``, archives of one member per record and
    their sidecar indexes in ``records``.

    A null html is an empty payload; a null url is left out; characters a header
    cannot hold are percent-encoded. Repeated rows are written each; rows that
    repeat the smallest ``page_id`` of a payload are all responses. An empty table
    gives no archives and no rows. Other columns are not read.

    Digests decide before payloads move, so a payload that a third of all pages
    share meets as digests only, in a join that can be split.
    """
    folder = folder or scratch(pages.sparkSession)
    streams, records = f"{folder}/streams", f"{folder}/records"
    archives = write_archives(with_revisits(pages, min_bytes), streams, target_bytes)
    return read_archives(normalize_archives(archives, streams, records), records, payloads)
