"""Web archives packaged in ZIP: written by tasks, read back by byte ranges.

A package is a ZIP file whose members are stored, not compressed: WARC files with one gzip member per
record under ``archive/``, and an index under ``indexes/`` that names member, offset and length of
each record. A reader parses the end of the package (end record, ZIP64 records, central directory),
finds where members begin, reads the index, and fetches records by ranges; nothing is extracted.

Files are opened by URI through Arrow's file systems, so packages may lie in any store these know.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.llm.common import checkpoint, column
from voxledger.session import shared_dir

MEMBER_BYTES = 8 << 20  # WARC file within a package, compressed; held in memory while written
PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20  # neighbouring records that are read at once
LEAST_BYTES = 0  # smaller payloads are never revisits
WRITTEN = "2024-01-01T00:00:00Z"

# Signatures and names of the two formats.
END, END64, LOCATE64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_ID}{page}>",
        f"WARC-Date: {WRITTEN}",
        *([f"WARC-Target-URI: {one_line(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def parse_record(raw: bytes) -> dict:
    """Fields of a record: id, url, type, digest, refers_to, payload (None for a revisit), payload_bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next((int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"), len(payload))
    name = lambda v: v[1:-1].removeprefix(RECORD_ID) if v is not None else None
    kind = fields["warc-type"]
    return {
        "id": name(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "type": kind,
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": name(fields.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
    }


class PackageWriter:
    """Writes records into packages of bounded size below a directory."""

    def __init__(self, directory: str, prefix: str, member_bytes: int, package_bytes: int):
        self.fs, self.root = pafs.FileSystem.from_uri(directory)
        self.directory, self.prefix = directory.rstrip("/"), prefix
        self.member_bytes, self.package_bytes = member_bytes, package_bytes
        self.number, self.out, self.done = 0, None, []

    def add(self, page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> None:
        if self.out is None:
            self._begin()
        packed = gzip.compress(record_bytes(page, url, payload, digest, refers_to), 6, mtime=0)
        line = {"id": page, "url": url, "digest": digest, "filename": self._member(), "offset": self.buffer.tell(), "length": len(packed)}
        self.index.append(json.dumps(line))
        self.buffer.write(packed)
        if self.buffer.tell() >= self.member_bytes:
            self._flush()
            if self.written >= self.package_bytes:
                self.finish()

    def _begin(self) -> None:
        self.name = f"{self.prefix}-{self.number:04d}.zip"
        self.number += 1
        self.fs.create_dir(self.root, recursive=True)
        self.stream = self.fs.open_output_stream(f"{self.root.rstrip('/')}/{self.name}")
        self.out = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.buffer, self.index, self.members, self.written = io.BytesIO(), [], 0, 0

    def _member(self) -> str:
        return f"data-{self.members:05d}.warc.gz"

    def _store(self, name: str, content: bytes) -> None:
        self.out.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), content)

    def _flush(self) -> None:
        if self.buffer.tell():
            self._store(f"archive/{self._member()}", self.buffer.getvalue())
            self.written += self.buffer.tell()
            self.members += 1
            self.buffer = io.BytesIO()

    def finish(self) -> None:
        """Close the package that is open, if any."""
        if self.out is None:
            return
        self._flush()
        self._store("indexes/index.cdxj", "".join(f"{x}\n" for x in self.index).encode())
        self.out.close()
        size = self.stream.tell()
        self.stream.close()
        self.done.append((f"{self.directory}/{self.name}", size, len(self.index)))
        self.out = None


@dataclass(frozen=True)
class Member:
    """A member of a package: its method (0: stored), its size, and where its local header begins."""

    name: str
    method: int
    size: int
    header: int


def central_directory(file, size: int) -> list[Member]:
    """Members listed at the end of a ZIP file; 64-bit sizes and places where the ZIP64 records give them."""
    tail_at = max(0, size - 65_557 - 20)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    locator = at - 20
    if locator >= 0 and tail[locator : locator + 4] == LOCATE64:
        place = struct.unpack("<Q", tail[locator + 8 : locator + 16])[0]
        record = read_range(file, place, 56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 locator leads nowhere")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    raw, at, out = read_range(file, start, length), 0, []
    for _ in range(count):
        if raw[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack("<H", raw[at + 10 : at + 12])[0]
        packed, plain = struct.unpack("<II", raw[at + 20 : at + 28])
        n, extra, comment = struct.unpack("<HHH", raw[at + 28 : at + 34])
        header = struct.unpack("<I", raw[at + 42 : at + 46])[0]
        name = raw[at + 46 : at + 46 + n].decode("utf-8", "replace")
        wide = _zip64_extra(raw[at + 46 + n : at + 46 + n + extra])
        # The extra field holds 64-bit values only for those that do not fit, in this order.
        if plain == 0xFFFFFFFF:
            plain, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
        if packed == 0xFFFFFFFF:
            packed, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
        if header == 0xFFFFFFFF:
            header = struct.unpack("<Q", wide[:8])[0]
        out.append(Member(name, method, packed, header))
        at += 46 + n + extra + comment
    return out


def _zip64_extra(extra: bytes) -> bytes:
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack("<HH", extra[at : at + 4])
        if tag == 1:
            return extra[at + 4 : at + 4 + length]
        at += 4 + length
    return b""


def read_range(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    out = file.read(length)
    if len(out) != length:
        raise ValueError(f"{length} bytes asked for at {offset}, {len(out)} found")
    return out


def content_start(file, member: Member) -> int:
    """Where the bytes of a member begin: its local header has name and extra fields of its own length."""
    head = read_range(file, member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"{member.name}: no local header")
    name, extra = struct.unpack("<HH", head[26:30])
    return member.header + 30 + name + extra


def record_places(file, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of every record in a package.

    From the stored indexes; WARC members that no index names are walked through, one gzip member after
    another. A compressed WARC member can't be read by ranges and is an error.
    """
    members = {m.name: m for m in central_directory(file, size)}
    starts: dict[str, int] = {}
    for name, member in members.items():
        if name.startswith("indexes/") and name.endswith(".cdxj") and member.method == 0:
            for line in _lines(file, content_start(file, member), member.size):
                entry = json.loads(line)
                target = f"archive/{entry['filename']}"
                if target not in starts:
                    starts[target] = content_start(file, _stored(members[target]))
                yield starts[target] + entry["offset"], entry["length"]
    for name, member in members.items():
        if name.startswith("archive/") and name.endswith(".warc.gz") and name not in starts:
            yield from _walk(file, content_start(file, _stored(member)), member.size)


def _stored(member: Member) -> Member:
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed in its package")
    return member


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    rest, at = b"", 0
    while at < size:
        part = read_range(file, start + at, min(RANGE_BYTES, size - at))
        at += len(part)
        *lines, rest = (rest + part).split(b"\n")
        yield from (x for x in lines if x)
    if rest:
        yield rest


def _walk(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Places of the gzip members in a run of bytes, which is decompressed but not kept."""
    at, begin, member, rest = 0, 0, zlib.decompressobj(31), b""
    while at < size or rest:
        if not rest:
            rest = read_range(file, start + at, min(1 << 20, size - at))
            at += len(rest)
        member.decompress(rest)
        if member.eof:
            rest = member.unused_data
            end = at - len(rest)
            yield start + begin, end - begin
            begin, member = end, zlib.decompressobj(31)
        else:
            rest = b""


def write_packages(
    pages: DataFrame,
    directory: str,
    *,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = LEAST_BYTES,
    member_bytes: int = MEMBER_BYTES,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write one WARC record per row into packages below ``directory``; returns their ``path``, ``size``
    and ``records``, a stored table.

    Of records with equal payloads of at least ``least_bytes``, that with the largest id is a response;
    the others are revisits without payload. A null payload is empty. Rows that repeat the largest id are
    all responses; a row with a null id is a revisit if its payload has an id, else a response. A null
    URL has no header. Extra columns are not looked at. An empty table writes nothing.

    Equal payloads are those of equal SHA-256 and length; the largest id per digest is an aggregate with
    partial sums, and meets the pages by an equality join that adaptive execution splits. A task that is
    run again writes new files: the returned table names only those of the run that counts.
    """
    source = pages.select(
        column(id_col).alias("id"),
        column(url).cast("string").alias("url"),
        F.coalesce(column(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    largest = source.groupBy("key").agg(F.max("id").alias("largest")).withColumnRenamed("key", "of")
    joined = source.join(largest, F.col("key") == F.col("of"))
    again = (F.length("payload") >= least_bytes) & F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest"))
    rows = joined.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        "url",
        "payload",
        F.when(again, F.col("largest").cast("string")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer = PackageWriter(directory, f"part-{context.partitionId():06d}-{uuid.uuid4().hex}", member_bytes, package_bytes)
        for batch in batches:
            for page, link, body, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                writer.add(page, link, body, base32_sha1(body), refers)
        writer.finish()
        paths, sizes, records = ([d[i] for d in writer.done] for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(records, pa.int64())],
            names=["path", "size", "records"],
        )

    return checkpoint(rows.mapInArrow(write, "path string, size bigint, records bigint"))


def index_packages(packages: DataFrame) -> DataFrame:
    """``path``, ``offset``, ``length`` of every record of the packages (``path``, ``size``)."""

    def run(batches):
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = pafs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    held: list[tuple[int, int]] = []
                    for entry in record_places(file, size):
                        held.append(entry)
                        if len(held) == 10_000:
                            yield _places(path, held)
                            held = []
                    yield _places(path, held)

    return packages.select("path", "size").mapInArrow(run, "path string, offset bigint, length bigint")


def _places(path: str, held: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(held), pa.string()), pa.array([o for o, _ in held], pa.int64()), pa.array([n for _, n in held], pa.int64())],
        names=["path", "offset", "length"],
    )


RECORD = "id string, url string, type string, digest string, refers_to string, payload_bytes bigint, payload binary, intact boolean"
_RECORD_ARROW = pa.schema(
    [("id", pa.string()), ("url", pa.string()), ("type", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_())]
)


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the packages (``path``, ``size``): id, url, type, digest, refers_to, payload_bytes,
    payload, intact.

    The places are dealt out in ranges of path and offset, so a package of any size is read by many
    tasks; neighbouring records are fetched together. ``intact`` tells whether a response has the length
    and digest that its headers state (null for a revisit, which has no payload of its own).
    """

    def run(batches):
        name, file, out, size = None, None, [], 0
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            at = 0
            while at < len(rows):
                path, start, length = rows[at]
                to, end = at + 1, start + length
                while to < len(rows) and rows[to][0] == path and rows[to][1] == end and end - start < RANGE_BYTES:
                    end += rows[to][2]
                    to += 1
                if path != name:
                    if file is not None:
                        file.close()
                    system, place = pafs.FileSystem.from_uri(path)
                    name, file = path, system.open_input_file(place)
                raw = read_range(file, start, end - start)
                for _, offset, n in rows[at:to]:
                    record = parse_record(gzip.decompress(raw[offset - start : offset - start + n]))
                    body = record["payload"]
                    record["intact"] = None if body is None else len(body) == record["payload_bytes"] and base32_sha1(body) == record["digest"]
                    size += len(body or b"")
                    if not with_payload:
                        record["payload"] = None
                    out.append(record)
                    if size >= RANGE_BYTES or len(out) >= 2_000:
                        yield pa.RecordBatch.from_pylist(out, _RECORD_ARROW)
                        out, size = [], 0
                at = to
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_pylist(out, _RECORD_ARROW)

    places = index_packages(packages).repartitionByRange("path", "offset").sortWithinPartitions("path", "offset")
    return places.mapInArrow(run, RECORD)


def archive_table(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written to packages in the shared folder and read back: one row per page."""
    packages = write_packages(pages, shared_dir(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    records = read_packages(packages, with_payload=False)
    return records.select(
        F.col("id").try_cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").try_cast(kind).alias("refers_to"),
        F.coalesce("intact", F.lit(True)).alias("intact"),
    )
