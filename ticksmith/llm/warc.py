"""WARC archives with a two-level capture index.

Archives and index are written by the tasks into a folder that every executor reaches, through
Arrow's file systems (local, HDFS, object stores by their URIs). A task's files bear a name of
their own, so a task that runs again leaves an unused file behind and never a wrong one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm.shared import require, shared_folder, written

_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"CAPIDX01"
_CAPTURE = "key string, file string, at long, length long"
_RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload binary, "
    "payload_bytes long, payload_digest string"
)
_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))


def url_key(url: str | None) -> str:
    """The URL with its host's labels reversed, so that a domain's captures sort together."""
    url = quote(url or "", safe=_SAFE)
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return ")" + url
    if not host:
        return ")" + url
    labels = ",".join(reversed(host.split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{f':{port}' if port else ''}){parts.path or '/'}{query}"


def capture_key(url: str | None, page: int | None) -> str:
    """Key of one capture: its URL's key, then its page in order of number, null first."""
    return f"{url_key(url)} {'' if page is None else f'{page + (1 << 63):020d}'}"


def _keys(urls: pa.Array, pages: pa.Array) -> pa.Array:
    both = zip(urls.to_pylist(), pages.to_pylist(), strict=True)
    return pa.array([capture_key(u, p) for u, p in both], pa.string())


def key_column(url: Column, page: Column) -> Column:
    return F.arrow_udf(_keys, "string")(url, page)


def with_roles(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Pages with payload, digest, type and the page that a revisit refers to.

    Of equal payloads of ``least_bytes`` or more, the smallest page_id is the response; rows that
    repeat it are responses too. The smallest is found by digest, map-side first; only digests
    that repeat are joined back.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = written(firsts.where("n > 1").select("digest", "first"), "firsts")
    joined = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to")
    )

# Schemes that Spark's readers name, and Arrow's names for them.
_SCHEMES = {
    "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss",
    "hdfs": "hdfs", "viewfs": "viewfs",
}


def _record(page, url, payload: bytes, digest: str, refers_to) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        *([] if url is None else [f"WARC-Target-URI: {quote(url, safe=_SAFE)}"]),
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _parsed(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    page = fields["WARC-Record-ID"][len("<urn:page:") : -1]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the record of page {page} is damaged")
    return {
        "page_id": int(page) if page else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers[len("<urn:page:") : -1]) if refers else None,
        "payload": None if refers else payload,
        "payload_bytes": size,
        "payload_digest": digest,
    }


def _place(folder: str) -> str:
    """The folder by the name that Arrow's file systems know its scheme by."""
    scheme, mark, path = folder.partition("://")
    if not mark:
        return folder
    known = _SCHEMES.get(scheme.lower())
    if known is None:
        raise ValueError(f"archives cannot be kept under {scheme}://, choose one of {sorted(_SCHEMES)}")
    return f"{known}://{path}"


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    system, path = pafs.FileSystem.from_uri(_place(folder))
    system.create_dir(path, recursive=True)
    return system, path


def _write_archives(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        out, at, name = None, 0, ""
        for batch in batches:
            found = []
            for page, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(_record(page, url, payload, digest, refers)) + packer.flush()
                out.write(member)
                found.append((capture_key(url, page), name, at, len(member)))
                at += len(member)
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "file", "at", "length"],
            )
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str, file_bytes: int = 256 << 20, level: int = 6) -> DataFrame:
    """One record per row of ``pages`` (``page_id``, ``url``, ``html``), each a gzip member, in
    files of about ``file_bytes`` under ``folder``; returns where every capture lies."""
    require(pages, "page_id", "url", "html")
    _place(folder)  # refused here rather than in a task
    rows = with_roles(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    rows = rows.select("page_id", "url", "payload", "digest", "refers_to")
    return written(rows.mapInArrow(_write_archives(folder, file_bytes, level), _CAPTURE), "captures")


class Part(NamedTuple):
    first: bytes
    file: str


def _write_index(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        out, name, directory, lines, at = None, "", [], [], 0

        def flush() -> None:
            nonlocal at
            packed = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((lines[0].split("\t", 1)[0], at, len(packed)))
            out.write(packed)
            at += len(packed)
            lines.clear()

        for batch in batches:
            for key, file, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.cdx"
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(f"{key}\t{file}\t{start}\t{length}")
                if len(lines) == block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(packed + len(packed).to_bytes(8, "big") + _MAGIC)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], ["first", "file"])

    return run


def write_index(captures: DataFrame, folder: str, block_lines: int = 2000) -> list[Part]:
    """Captures sorted by key into compressed blocks, each part file with a sparse directory of
    the blocks' first keys at its end; returns the parts in order, one per range of keys.

    Keys end with the page, so that a host or URL with very many captures is cut like any other.
    """
    ranged = captures.repartitionByRange("key").sortWithinPartitions("key", "file", "at")
    parts = ranged.mapInArrow(_write_index(folder, block_lines), "first string, file string")
    # As many rows as the session has shuffle partitions.
    return sorted(Part(r.first.encode(), r.file) for r in parts.select("first", "file").collect())


class CaptureIndex:
    """Looks captures up: the part by its first key, the block by the part's directory, then one
    range read and a search in the block's lines."""

    def __init__(self, folder: str, parts: list[Part]) -> None:
        self._system, self._base = _files(folder)
        self._parts, self._firsts = parts, [p.first for p in parts]
        self._directories: dict = {}
        self._block: tuple = (None, [])

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """File, offset and length of every capture with the key."""
        wanted, found = key.encode(), []
        # Equal keys may go on over the end of a block or part.
        part = max(bisect_left(self._firsts, wanted) - 1, 0)
        while part < len(self._parts) and self._firsts[part] <= wanted:
            keys, places = self._directory(self._parts[part].file)
            block = max(bisect_left(keys, wanted) - 1, 0)
            while block < len(keys) and keys[block] <= wanted:
                lines = self._lines(self._parts[part].file, *places[block])
                at = bisect_left(lines, wanted, key=lambda x: x[0])
                end = bisect_right(lines, wanted, key=lambda x: x[0])
                found += [(f.decode(), int(a), int(n)) for _, f, a, n in lines[at:end]]
                block += 1
            part += 1
        return found

    def _directory(self, file: str) -> tuple[list, list]:
        if file not in self._directories:
            path = f"{self._base}/{file}"
            size = self._system.get_file_info(path).size
            with self._system.open_input_file(path) as source:
                tail = source.read_at(16, size - 16)
                if tail[8:] != _MAGIC:
                    raise ValueError(f"{path} has no directory")
                length = int.from_bytes(tail[:8], "big")
                rows = json.loads(zlib.decompress(source.read_at(length, size - 16 - length)))
            if len(self._directories) > 64:
                self._directories.clear()
            self._directories[file] = [r[0].encode() for r in rows], [r[1:] for r in rows]
        return self._directories[file]

    def _lines(self, file: str, at: int, length: int) -> list:
        if self._block[0] != (file, at):
            with self._system.open_input_file(f"{self._base}/{file}") as source:
                text = zlib.decompress(source.read_at(length, at))
            self._block = (file, at), [tuple(x.split(b"\t")) for x in text.split(b"\n")]
        return self._block[1]


def lookup(keys: DataFrame, folder: str, parts: list[Part]) -> DataFrame:
    """Where the captures of distinct ``key`` values lie; keys without capture give no row.

    Sorted keys make neighbouring searches meet the same block. The part list has a row per
    index file, as many as the index had partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(folder, parts)
        for batch in batches:
            found = [(k, *place) for k in batch.column(0).to_pylist() for place in index.find(k)]
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "file", "at", "length"],
            )

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, _CAPTURE)


def read_records(places: DataFrame, folder: str, gap: int = 1 << 16, most: int = 4 << 20) -> DataFrame:
    """The records at ``file``, ``at``, ``length``, checked against their digests.

    Neighbouring places of a file, up to ``gap`` bytes apart, are fetched by one range read of at
    most about ``most`` bytes. Files are spread over tasks in slices of 16 MB, so that one large
    file is not one task's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        opened: dict = {}
        for batch in batches:
            files, ats, lengths = (batch.column(n).to_pylist() for n in ("file", "at", "length"))
            rows, i = [], 0
            while i < len(files):
                j, end = i + 1, ats[i] + lengths[i]
                while (
                    j < len(files) and files[j] == files[i]
                    and ats[j] - end <= gap and ats[j] + lengths[j] - ats[i] <= most
                ):
                    end = max(end, ats[j] + lengths[j])
                    j += 1
                if files[i] not in opened:
                    opened = {files[i]: system.open_input_file(f"{base}/{files[i]}")}
                data = opened[files[i]].read_at(end - ats[i], ats[i])
                for k in range(i, j):
                    member = data[ats[k] - ats[i] : ats[k] - ats[i] + lengths[k]]
                    rows.append(_parsed(zlib.decompress(member, 31)))
                    if len(rows) == 500:
                        yield _record_batch(rows)
                        rows = []
                i = j
            if rows:
                yield _record_batch(rows)

    slice_ = F.floor(F.col("at") / (16 << 20))
    spread = places.select("file", "at", "length").repartition("file", slice_)
    return spread.sortWithinPartitions("file", "at").mapInArrow(run, _RECORD)


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]))


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written as WARC archives with their index, looked up in it and read back.

    One record comes back per row of ``pages``: page_id, url, record_type, refers_to, payload
    (null for a revisit), payload_bytes and payload_digest, both of the full payload. A null
    html is an empty payload, a null url has an empty key and comes back null; URLs come back
    with blanks and non-ASCII characters percent-encoded. Rows that repeat a page are records
    each. An empty table gives an empty result.
    """
    folder = folder or f"{shared_folder(spark)}/warc"
    captures = write_archives(pages, folder)
    parts = write_index(captures, folder)
    keys = pages.select(key_column(F.col("url"), F.col("page_id").cast("long")).alias("key")).distinct()
    return read_records(lookup(keys, folder, parts), folder)
