"""WARC records in ZIP-packaged archives, written and read by range.

A package is a ZIP file whose members are stored, not deflated: `archive/data.warc.gz`, a concatenation of WARC records
each in a gzip member of its own, and `indexes/index.cdx`, a line of JSON a record with its offset and length. A reader
takes the end of the file, finds the central directory (or, by its locator, the ZIP64 one), finds both members and reads
each record by its range; nothing is extracted.

Packages are written by the tasks of one map, each under a name of its own attempt, and listed in a manifest table that is
written before anything reads it: a task that runs twice leaves an unlisted file at worst.

Which records are revisits is decided by digest before writing: digests are counted with map-side combining, so an empty
or very common payload doesn't meet in one task.

Defined results: a null html counts as empty, its payload is empty and its digest that of no bytes; of pages with equal
payloads of at least `min_bytes` the largest page_id is the response; rows that repeat it too (same id, same payload) are
responses; a null page_id is a page of its own kind that reads back as null and is the response only where no equal
payload has an id; a null url is written as `urn:page:<id>`; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import MIN_LONG, Work, parts_for

PACKAGE_BYTES, REQUEST = 48 << 20, 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
LIMIT32 = 0xFFFFFFFF


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit that carries the HTTP header alone."""
    name = "" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = (url or f"urn:page:{name}").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    head += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record; field names in lower case."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class Packer:
    """Writes one package: records as they come, then the index, the directory and, where 32 bits don't do, ZIP64."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.zip64, self.entries, self.lines = out, 0, zip64, [], []
        self._open(DATA)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _open(self, name: str) -> None:
        # sizes follow in a data descriptor (flag 8): the output is written once, from front to end
        self.name, self.head, self.crc = name, self.at, 0
        self._write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8, 0, 0, 33, 0, 0, 0, len(name), 0) + name.encode())
        self.start = self.at

    def _close(self) -> None:
        size = self.at - self.start
        wide = self.zip64 or size > LIMIT32
        self._write(struct.pack("<IIQQ" if wide else "<IIII", 0x08074B50, self.crc, size, size))
        self.entries.append((self.name, self.crc, size, self.head))

    def _body(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._write(data)

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 4, mtime=0)
        self.lines.append(json.dumps({"offset": self.at - self.start, "length": len(member)}))
        self._body(member)

    def close(self) -> None:
        self._close()
        self._open(INDEX)
        self._body("\n".join(self.lines).encode())
        self._close()
        begin = self.at
        for name, crc, size, head in self.entries:
            wide = self.zip64 or max(size, head) > LIMIT32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, head) if wide else b""
            small = (LIMIT32, LIMIT32, LIMIT32) if wide else (size, size, head)
            self._write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8, 0, 0, 33, crc, *small[:2], len(name), len(extra), 0, 0, 0, 0, small[2]) + name.encode() + extra)
        n, size = len(self.entries), self.at - begin
        if self.zip64 or max(begin, size) > LIMIT32 or n > 0xFFFF:
            end = self.at
            self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, begin))
            self._write(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
            n, size, begin = 0xFFFF, LIMIT32, LIMIT32
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, size, begin, 0))


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    start: int


class Package:
    """Reads a package by ranges. read(offset, length) -> bytes."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 65557)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP package")
        n, size, begin = struct.unpack_from("<HII", tail, at + 10)
        if n == 0xFFFF or LIMIT32 in (size, begin):
            locator = tail_at + at - 20
            signature, _, where, _ = struct.unpack("<IIQI", self.read(locator, 20)) if locator >= 0 else (0, 0, 0, 0)
            if signature == 0x07064B50:
                signature, _, _, _, _, _, _, n, size, begin = struct.unpack("<IQHHIIQQQQ", self.read(where, 56))
                if signature != 0x06064B50:
                    raise ValueError("broken ZIP64 directory")
        data, p = self.read(begin, size), 0
        for _ in range(n):
            signature, method, packed, full, ln, lx, lc, head = *struct.unpack_from("<I", data, p), *struct.unpack_from("<H", data, p + 10), *struct.unpack_from("<IIHHH", data, p + 20), *struct.unpack_from("<I", data, p + 42)
            if signature != 0x02014B50:
                raise ValueError("broken central directory")
            name, extra = data[p + 46 : p + 46 + ln].decode(), data[p + 46 + ln : p + 46 + ln + lx]
            q = 0
            while q + 4 <= len(extra):
                kind, length = struct.unpack_from("<HH", extra, q)
                if kind == 1:  # ZIP64: only the values that don't fit, in this order
                    v = q + 4
                    if full == LIMIT32:
                        (full,), v = struct.unpack_from("<Q", extra, v), v + 8
                    if packed == LIMIT32:
                        (packed,), v = struct.unpack_from("<Q", extra, v), v + 8
                    if head == LIMIT32:
                        (head,) = struct.unpack_from("<Q", extra, v)
                q += 4 + length
            p += 46 + ln + lx + lc
            ln2, lx2 = struct.unpack_from("<HH", self.read(head, 30), 26)
            yield Member(name, method, packed, head + 30 + ln2 + lx2)

    def range(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} isn't stored")
        length = m.size - offset if length is None else length
        if offset < 0 or offset + length > m.size:
            raise ValueError("range outside the member")
        return self.read(m.start + offset, length)

    def index(self) -> list[tuple[int, int]]:
        lines = self.range(INDEX).decode().split("\n")
        return [(x["offset"], x["length"]) for x in map(json.loads, filter(None, lines))]

    def records(self) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
        """Neighbouring ranges are read together, REQUEST bytes at a time."""
        todo = self.index()
        i = 0
        while i < len(todo):
            begin, end = todo[i][0], sum(todo[i])
            j = i + 1
            while j < len(todo) and todo[j][0] == end and sum(todo[j]) - begin <= REQUEST:
                end = sum(todo[j])
                j += 1
            data = self.range(DATA, begin, end - begin)
            for offset, length in todo[i:j]:
                yield parse_record(gzip.decompress(data[offset - begin : offset - begin + length]))
            i = j


def arrow_uri(folder: str) -> str:
    """A Hadoop path as the URI by which pyarrow opens the same place."""
    if "://" not in folder:
        return "file://" + folder.removeprefix("file:")
    scheme, rest = folder.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}.get(scheme, scheme)
    if scheme in ("abfs", "abfss"):
        rest = rest.replace(".blob.core.", ".dfs.core.", 1)
    return f"{scheme}://{rest}"


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(arrow_uri(folder))


def _writer(folder: str, zip64: bool):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        pack = out = path = None
        n = 0

        def done() -> pa.RecordBatch:
            pack.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "n"])

        for batch in batches:
            for page_id, url, html, ref in zip(*(batch.column(c) for c in ("page_id", "url", "html", "ref")), strict=True):
                if pack is None:
                    path, n = f"{uuid.uuid4().hex}.wacz", 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{path}")
                    pack = Packer(out, zip64)
                payload = (html.as_py() or "").encode()
                pack.add(record(page_id.as_py(), url.as_py(), payload, digest(payload), ref.as_py()))
                n += 1
                if pack.at > PACKAGE_BYTES:
                    yield done()
                    pack = None
        if pack is not None:
            yield done()

    return f


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, package string, html string"


def _reader(folder: str, with_payload: bool):
    def number(urn: str | None) -> int | None:
        tail = (urn or "").strip("<>").rpartition(":")[2]
        return int(tail) if tail else None

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(f"{base}/{path}") as file:
                    package = Package(lambda at, n, file=file: file.read_at(n, at), file.size())
                    rows: list[tuple] = []
                    size = 0
                    for fields, http, payload in package.records():
                        sha, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                        if kind == "response" and digest(payload) != sha:
                            raise ValueError(f"{path}: payload doesn't match its digest")
                        full = len(payload) if kind == "response" else int(http["content-length"])
                        body = payload.decode("utf-8", "replace") if with_payload and kind == "response" else None
                        rows.append((number(fields["warc-record-id"]), full, sha, kind, number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), path, body))
                        size += len(body or "")
                        if len(rows) >= 2000 or size > 4 << 20:
                            yield pack(rows)
                            rows, size = [], 0
                    if rows:
                        yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "package", "html"])

    return f


def write(pages: DataFrame, work: Work, min_bytes: int = 0, zip64: bool = False) -> tuple[DataFrame, str]:
    """Packages of all pages: the manifest (path, n) and the folder that holds them."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"))
    sums = p.select("page_id", F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("size")).where(F.col("size") >= min_bytes)
    twice = sums.groupBy("sha").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1").select("sha", "last")
    twice = work.keep(twice, "equal")
    # who refers to whom is found over narrow rows; payloads then meet it by page and digest, so that a common one spreads
    p = p.withColumns({"pid": F.coalesce("page_id", F.lit(MIN_LONG)), "sha": F.sha1(F.col("html").cast("binary"))})
    refs = sums.join(twice, "sha").where(~F.col("page_id").eqNullSafe(F.col("last")))
    refs = refs.select(F.coalesce("page_id", F.lit(MIN_LONG)).alias("pid"), "sha", F.col("last").alias("ref")).distinct()
    marked = p.join(work.keep(refs, "refers"), ["pid", "sha"], "left")
    folder = f"{work.root}/packages"
    manifest = work.keep(marked.select("page_id", "url", "html", "ref").mapInArrow(_writer(folder, zip64), "path string, n long"), "manifest")
    return manifest, folder


def read(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, package, html (null for revisits)."""
    spark = manifest.sparkSession
    n = manifest.count()  # one row a package
    return manifest.repartition(parts_for(spark, n, 1), "path").mapInArrow(_reader(folder, with_payload), READ_SCHEMA)


def report(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from the packages."""
    manifest, folder = write(pages, Work(pages.sparkSession, "warc"), min_bytes)
    return read(manifest, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
