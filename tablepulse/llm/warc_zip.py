"""WARC records in ZIP packages: a writer, and a reader that range-reads records without extraction.

A package holds two stored (not compressed) members: ``archive/data.warc.gz``,
where each record is a gzip member of its own, and ``indexes/index.cdxj``, with
one JSON line for each record (its offset in the data member and its length).
The reader finds the end record of the ZIP file, follows the ZIP64 locator where
sizes or counts need it, parses the central directory, locates the members'
bytes from their local headers, reads the index by range, and then reads each
record by its own range.

Spark deals out the work: payload groups are found by a shuffle on the payload
digest (counts and the largest id are combined before it), writing tasks roll
over to a new package at ``PACKAGE_BYTES``, index lines are dealt anew, and
records are read in small tasks. A task holds one record and one package's index
at a time. Packages are written under a temporary name and renamed, and their
names depend on the partition alone, so a task that runs twice leaves one package.

Defined cases: a null payload counts as empty; a null url is written as the
record's own name; an empty table gives no packages and no rows. Of records with
equal payloads that with the largest id is the response, others revisit it; rows
that repeat this id are responses too. A null id is smaller than all others.
Payloads shorter than ``least_revisit_bytes`` are always responses. Other columns
are not read. A record that differs from its digest raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import filled, small_batches
from tablepulse.session import checkpointed, work_path

PACKAGE_BYTES = 256 << 20
PACKAGE_RECORDS = 50_000
#: packed bytes of records that one reading task takes
READ_BYTES = 16 << 20
LEAST_REVISIT_BYTES = 0
RECORD_DATE = "2024-01-01T00:00:00Z"
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"

# fixed values of the formats: ZIP signatures (PKWARE APPNOTE) and the WARC 1.1 revisit profile
END_RECORD, END_RECORD_64, LOCATOR_64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
DIRECTORY_ENTRY, LOCAL_HEADER = b"PK\x01\x02", b"PK\x03\x04"
EXTRA_64 = 0x0001
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file, from a URI or an absolute path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- ZIP directory


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


def read_at(file: BinaryIO, at: int, n: int) -> bytes:
    file.seek(at)
    found = file.read(n)
    if len(found) != n:
        raise ValueError(f"the file ends before byte {at + n}")
    return found


def members(file: BinaryIO, size: int) -> list[Member]:
    """Entries of the central directory, with 64-bit sizes and offsets where they are needed."""
    tail_at = max(0, size - 22 - 0xFFFF - 20)
    tail = read_at(file, tail_at, size - tail_at)
    end = tail.rfind(END_RECORD)
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(END_RECORD, 0, end)
    if end < 0:
        raise ValueError("not a ZIP file: no end record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if end < 20 or tail[end - 20 : end - 16] != LOCATOR_64:
            raise ValueError("no ZIP64 locator")
        at = struct.unpack_from("<Q", tail, end - 20 + 8)[0]
        record = read_at(file, at, 56)
        if record[:4] != END_RECORD_64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, found = read_at(file, start, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != DIRECTORY_ENTRY:
            raise ValueError("damaged central directory")
        method, packed, plain = struct.unpack_from("<10xH8xII", directory, at)
        n_name, n_extra, n_comment, header_at = struct.unpack_from("<28xHHH8xI", directory, at)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8")
        extra, k = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == EXTRA_64:
                # only the fields that are full in the entry are here, in this order
                field = k + 4
                if plain == 0xFFFFFFFF:
                    plain, field = struct.unpack_from("<Q", extra, field)[0], field + 8
                if packed == 0xFFFFFFFF:
                    packed, field = struct.unpack_from("<Q", extra, field)[0], field + 8
                if header_at == 0xFFFFFFFF:
                    header_at = struct.unpack_from("<Q", extra, field)[0]
            k += 4 + n
        found.append(Member(name, method, packed, header_at))
        at += 46 + n_name + n_extra + n_comment
    return found


def data_start(file: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed in the package; only stored members can be read by range")
    header = read_at(file, member.header_at, 30)
    if header[:4] != LOCAL_HEADER:
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<26xHH", header)
    return member.header_at + 30 + n_name + n_extra


# ---------------------------------------------------------------- WARC records


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def named_page(name: str) -> int | None:
    found = name.strip("<>").rpartition(":")[2]
    return None if found == "null" else int(found)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(page_id)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else record_name(page_id).strip("<>")),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
    ]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_name(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse_record(packed: bytes) -> dict:
    """Fields of a record: page_id, url, payload (empty for a revisit), payload_bytes, payload_digest, record_type, refers_to."""
    data = gzip.decompress(packed)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, revisit = field["WARC-Payload-Digest"].removeprefix("sha1:"), field["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != n or payload_digest(payload) != digest):
        raise ValueError(f"{field['WARC-Record-ID']}: the payload differs from its digest")
    return {
        "page_id": named_page(field["WARC-Record-ID"]),
        "url": field["WARC-Target-URI"],
        "payload": payload,
        "payload_bytes": n,
        "payload_digest": digest,
        "record_type": field["WARC-Type"],
        "refers_to": named_page(field["WARC-Refers-To"]) if revisit else None,
    }


# ---------------------------------------------------------------- Spark


def with_references(pages: DataFrame, least_revisit_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, revisit, refers_to."""
    rows = pages.select("page_id", "url", filled("html").cast("binary").alias("payload"))
    keyed = rows.withColumns({"_sha": F.unhex(F.sha1("payload")), "_n": F.octet_length("payload")})
    groups = keyed.groupBy("_sha", "_n").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # written out, so that both sides of the join are plain exchanges and a hot payload can be split
    shared = checkpointed(groups.where((F.col("_rows") > 1) & (F.col("_n") >= least_revisit_bytes)).drop("_rows"))
    both = keyed.join(shared, ["_sha", "_n"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return both.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("_first")).alias("refers_to"))


class _Package:
    """A package that is being written."""

    def __init__(self, folder: str, name: str):
        self.files, path = open_store(folder)
        self.files.create_dir(path, recursive=True)
        self.uri, self.path = f"{folder}/{name}", f"{path}/{name}"
        self.draft = f"{path}/.{name}-{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.draft)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        self.data.write(record)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(record)}))
        self.size += len(record)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX_MEMBER), "w") as f:
            f.write("".join(line + "\n" for line in self.index).encode())
        self.zip.close()
        self.out.close()
        self.files.move(self.draft, self.path)
        return self.uri, len(self.index), self.size


def write_packages(pages: DataFrame, folder: str, least_revisit_bytes: int = LEAST_REVISIT_BYTES, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record for each page below ``folder`` (seen by all executors); gives uri, records, bytes of each package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # named by the attempt: a repeated task may get its rows in another order, and must not replace a package of
        # the first one; the list of packages, written once, says which count
        part, attempt, package, k, done = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), None, 0, []
        for batch in small_batches(batches, "payload"):
            for row in batch.to_pylist():
                if package is None:
                    package = _Package(folder, f"pages-{part:06d}-{attempt:08d}-{k:04d}.wacz")
                package.add(row["page_id"], make_record(**row))
                if package.size >= package_bytes or len(package.index) >= PACKAGE_RECORDS:
                    done.append(package.close())
                    package, k = None, k + 1
        if package is not None:
            done.append(package.close())
        if done:
            columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["uri", "records", "bytes"])

    # written once: later reads don't write the packages again
    return checkpointed(with_references(pages, least_revisit_bytes).mapInArrow(run, "uri string, records long, bytes long"))


def index_rows(packages: DataFrame) -> DataFrame:
    """uri, start, length of every record, from the packages' directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                files, path = open_store(uri)
                with files.open_input_file(path) as f:
                    by_name = {m.name: m for m in members(f, f.size())}
                    base, index = data_start(f, by_name[DATA_MEMBER]), by_name[INDEX_MEMBER]
                    lines = [json.loads(x) for x in read_at(f, data_start(f, index), index.size).splitlines()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri] * len(lines)),
                        pa.array([base + x["offset"] for x in lines], pa.int64()),
                        pa.array([x["length"] for x in lines], pa.int64()),
                    ],
                    ["uri", "start", "length"],
                )

    return packages.select("uri").mapInArrow(run, "uri string, start long, length long")


def read_records(packages: DataFrame) -> DataFrame:
    """Every record of the packages, read by range: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    # neighbouring records stay together; the number of tasks follows the records' bytes, not the index's
    tasks = max(1, -(-(packages.agg(F.sum("bytes")).first()[0] or 0) // READ_BYTES))
    block = F.floor(F.col("start") / (READ_BYTES // 8))
    rows = index_rows(packages).repartition(tasks, "uri", block).sortWithinPartitions("uri", "start")
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file, held, size = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["uri"] != uri:
                    if file is not None:
                        file.close()
                    files, path = open_store(row["uri"])
                    uri, file = row["uri"], files.open_input_file(path)
                held.append(parse_record(read_at(file, row["start"], row["length"])))
                size += held[-1]["payload_bytes"]
                if size >= 4 << 20 or len(held) >= 1000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)
        if file is not None:
            file.close()

    names = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return rows.mapInArrow(run, names)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages to packages and read them back."""
    return read_records(write_packages(pages, folder or work_path(pages.sparkSession, "warc")))
