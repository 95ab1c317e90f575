"""WARC archives as a PySpark data source, and archives of pages with revisit records for repeated payloads.

Writing: each task writes its records, every one a gzip member of its own, and starts a new file at ``max_bytes``. A member's
header states its length in the standard's ``sl`` field. The driver commits the names of all files in a manifest, so
files of failed or repeated tasks are never read.

Reading: the driver lists files and sizes and plans partitions of about ``split_bytes``. Filters on the record type and other
header columns are taken over; a task inflates only as far as a record's headers and, where they do not match,
skips to the next member without inflating the payload. Paths may be of any file system that Arrow opens.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from vintora.llm.common import ship
from vintora.sources.workspace import new_folder

VERSION = b"WARC/1.1"
READ_BYTES = 1 << 18
OUT_BYTES = 8 << 20  #: payload bytes of an output batch, about
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, headers map<string,string>, payload binary"
)
ARROW = pa.schema(
    [(c, pa.string()) for c in HEADER_COLUMNS]
    + [("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/[^/]", path):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """One gzip member with its compressed and plain length in the ``sl`` field; left out beyond 4 GB."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 24 + len(body) + len(tail)
    if size >= 1 << 32 or len(data) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, size, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def _line(name: str, value) -> bytes:
    """A header line; line ends inside a value are percent-encoded."""
    return f"{name}: {value}".encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A") + b"\r\n"


def warc_record(record_type: str, record_id: str, uri: str | None, refers_to: str | None, payload: bytes | None, digest: str | None, size: int | None) -> bytes:
    """A record with an HTTP block; the payload of a revisit is left out, its digest and size are stated."""
    body = payload or b""
    if payload is not None:
        digest, size = base32_sha1(payload), len(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", size or 0) + b"\r\n"
    head = [VERSION + b"\r\n", _line("WARC-Type", record_type), _line("WARC-Record-ID", f"<{record_id}>")]
    if uri is not None:
        head.append(_line("WARC-Target-URI", uri))
    if refers_to is not None:
        head.append(_line("WARC-Refers-To", f"<{refers_to}>"))
        head.append(_line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    if digest is not None:
        head += [_line("WARC-Payload-Digest", f"sha1:{digest}"), _line("WARC-Payload-Bytes", size)]
    head += [_line("WARC-Date", "1970-01-01T00:00:00Z"), _line("Content-Type", "application/http; msgtype=response")]
    return b"".join([*head, _line("Content-Length", len(http) + len(body)), b"\r\n", http, body, b"\r\n\r\n"])


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, refers_to, payload, payload_sha1, payload_bytes) to archives."""

    def __init__(self, path: str, max_bytes: int, level: int):
        self.path, self.max_bytes, self.level = path, max_bytes, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        files: list[str] = []
        out, written = None, 0
        try:
            for batch in iterator:
                for r in batch.to_pylist():
                    sha1 = r["payload_sha1"]
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode() if sha1 else None
                    record = warc_record(r["record_type"], r["record_id"], r["target_uri"], r["refers_to"], r["payload"], digest, r["payload_bytes"])
                    if out is None:
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, written = system.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    member = gzip_member(record, self.level)
                    out.write(member)
                    written += len(member)
                    if written >= self.max_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing is read without a manifest, so there is nothing to take back."""


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class _Source:
    """Bytes of a file by position, read ahead in blocks."""

    def __init__(self, system: pafs.FileSystem, path: str, size: int):
        self.file, self.size, self.at, self.held = system.open_input_file(path), size, 0, b""

    def peek(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(n, READ_BYTES))
        return self.held[at - self.at : at - self.at + n]


def _gzip_head(source: _Source, at: int) -> tuple[int, int | None]:
    """(where the compressed data begin, the member's length if its header states it)."""
    head = source.peek(at, 12)
    flags, begin, length = head[3], at + 10, None
    if flags & 4:
        size = struct.unpack("<H", head[10:12])[0]
        extra = source.peek(at + 12, size)
        while len(extra) >= 4:
            name, n = extra[:2], struct.unpack("<H", extra[2:4])[0]
            if name == b"sl" and n == 8:
                length = struct.unpack("<I", extra[4:8])[0] or None
            extra = extra[4 + n :]
        begin += 2 + size
    for flag in (8, 16):
        if flags & flag:
            while source.peek(begin, 1) != b"\0":
                begin += 1
            begin += 1
    return begin + (2 if flags & 2 else 0), length


def _headers(block: bytes) -> dict[str, str]:
    """Header names in lower case; a line that begins with white space continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in block.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
        elif ":" in text:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _field(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(HEADER_COLUMNS[column])
    if value is None:
        return None
    return value.removeprefix("sha1:") if column == "payload_digest" else value.strip("<>") if column in ("record_id", "refers_to") else value


def _members(source: _Source, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers of each record and, where ``wanted`` takes them, its block."""
    at = 0
    while at < source.size:
        if source.peek(at, 2) != b"\x1f\x8b":
            head, end = b"", at
            while b"\r\n\r\n" not in head and end < source.size:
                more = source.peek(end, min(READ_BYTES, source.size - end))
                head, end = head + more, end + len(more)
            if not head.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {at}")
            begin = at + head.index(b"\r\n\r\n") + 4
            headers = _headers(head[: begin - at - 4])
            size = int(headers["content-length"])
            yield headers, source.peek(begin, size) if wanted(headers) else None
            at = begin + size + 4
            continue
        begin, length = _gzip_head(source, at)
        inflate, data, headers, take = zlib.decompressobj(-zlib.MAX_WBITS), [], None, True
        head, position = b"", begin
        while not inflate.eof:
            chunk = source.peek(position, min(READ_BYTES if headers else 2048, source.size - position))
            if not chunk:
                raise ValueError(f"archive ends within the member at byte {at}")
            plain = inflate.decompress(chunk)
            position += len(chunk)
            if headers is None:
                head += plain
                if b"\r\n\r\n" in head or inflate.eof:
                    cut = head.index(b"\r\n\r\n")
                    headers = _headers(head[:cut])
                    take = wanted(headers)
                    data = [head[cut + 4 :]]
                    if not take and length:
                        break
            elif take:
                data.append(plain)
        at = at + length if length else position - len(inflate.unused_data) + 8
        if headers is None:
            raise ValueError("a member without record headers")
        yield headers, b"".join(data)[: int(headers["content-length"])] if take else None


class WarcReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, with_payload: bool, verify: bool):
        self.path, self.split_bytes, self.with_payload, self.verify = path, split_bytes, with_payload, verify
        self.tests: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in HEADER_COLUMNS:
                self.tests.append((column, [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, root = _open(self.path)
        infos = system.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True))
        manifests = [i for i in infos if i.base_name.startswith("_manifest-")]
        listed: set[str] | None = set() if manifests else None
        for m in manifests:
            with system.open_input_stream(m.path) as f:
                listed |= set(json.loads(f.read()))
        files = [(i.path, i.size) for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name) and (listed is None or i.base_name in listed)]
        plan: list[list[tuple[str, int]]] = []
        held = 0
        for path, size in sorted(files):
            if not plan or held + size > self.split_bytes:
                plan.append([])
                held = 0
            plan[-1].append((path, size))
            held += size
        return [Files(p) for p in plan] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.path)
        rows: list[tuple] = []
        held = 0
        wanted = lambda headers: all(_field(headers, c) in values for c, values in self.tests)
        for path, size in partition.files:
            for headers, block in _members(_Source(system, path, size), lambda h: self.with_payload and wanted(h)):
                if not wanted(headers):
                    continue
                payload = self._payload(headers, block) if block is not None else None
                stated = headers.get("warc-payload-bytes")
                n = len(payload) if payload is not None else int(stated) if stated else None
                rows.append((*(_field(headers, c) for c in HEADER_COLUMNS), n, list(headers.items()), payload))
                held += len(payload or b"") + 200
                if held >= OUT_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _payload(self, headers: dict[str, str], block: bytes) -> bytes | None:
        """The body of an HTTP block, or the block itself; None for revisits. Its digest is checked."""
        if headers.get("warc-type") == "revisit":
            return None
        body = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
        stated = _field(headers, "payload_digest")
        if self.verify and stated and base32_sha1(body) != stated:
            raise ValueError(f"payload digest of {headers.get('warc-record-id')} does not match")
        return body

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class WarcSource(DataSource):
    """``format("warc")``; options ``path``, ``max_bytes``, ``level``, ``split_bytes``, ``payload``, ``verify``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        flag = lambda name: self.options.get(name, "true").lower() == "true"
        return WarcReader(self.options["path"], int(self.options.get("split_bytes", 128 << 20)), flag("payload"), flag("verify"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added; choose a new folder")
        return WarcWriter(self.options["path"], int(self.options.get("max_bytes", 64 << 20)), int(self.options.get("level", 1)))


def register_warc(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let filters reach it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows for the writer: of equal payloads of ``min_bytes`` or more, the smallest page is the response, the others revisit it.

    Null html is an empty payload. Rows that repeat the responding page's id are responses too. A null page id revisits
    where its payload has a numbered page. The payloads of revisits are not carried on.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("payload_sha1"), F.length("payload").cast("long").alias("payload_bytes"))
    firsts = rows.groupBy(F.col("payload_sha1").alias("_sha1")).agg(F.min("page_id").alias("_first"))
    again = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_first"))
    named = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.join(firsts, F.col("payload_sha1") == F.col("_sha1")).select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        named(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(again, named(F.col("_first"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
        "payload_sha1",
        "payload_bytes",
    )


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives under ``path`` (a new shared folder by default) and read them back, digests checked."""
    spark = pages.sparkSession
    register_warc(spark)
    path = path or new_folder(spark, "warc")
    page_records(pages, min_bytes).write.format("warc").option("path", path).mode("append").save()
    return spark.read.format("warc").option("path", path).load()


def page_report(records: DataFrame) -> DataFrame:
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
