"""WARC records in ZIP packages: written once per task, read back by ranges without extraction.

A package is a ZIP file with two stored members: ``archive/data.warc.gz`` (one gzip member per
record) and ``indexes/index.cdx`` (one line per record: offset, length). The reader opens a package,
parses the end record, the ZIP64 end record and the central directory, locates the data of stored
members through their local headers, range-reads the index, and then range-reads only the records
that it was asked for.

Defined cases: a NULL payload is the empty payload; a NULL or odd URL is percent-encoded (NULL:
empty); a NULL page_id writes ``null`` and reads back as NULL; repeated rows each have a record; an
empty table makes no package and no rows; payloads of any length are streamed into the package, a
package ends after ``package_bytes``. Executors may be lost at any time: a package name is never
used twice, and only packages of tasks that ended are in the (checkpointed) manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import table
from tidings.session import cut_lineage, drop_scratch, scratch_path

DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
# Fixed values of the ZIP format: signatures and the marker "see ZIP64".
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
MANIFEST = "path string, bytes long, records long"
RANGES = "path string, start long, lengths array<long>"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder (file, hdfs, s3, ...) and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


# --- writing ---------------------------------------------------------------------------------

def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {urllib.parse.quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Package:
    """One ZIP package under construction."""

    def __init__(self, store: pafs.FileSystem, path: str):
        self.path, self.lines, self.offset = path, [], 0
        self.stream = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA_MEMBER, "w", force_zip64=True)

    def add(self, record: bytes) -> None:
        packed = gzip_member(record)
        self.member.write(packed)
        self.lines.append(f"{self.offset} {len(packed)}\n")
        self.offset += len(packed)

    def close(self) -> tuple[int, int]:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "".join(self.lines))
        self.zip.close()
        size = self.stream.tell()
        self.stream.close()
        return size, len(self.lines)


def write_packages(pages: DataFrame, folder: str, package_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write rows (page_id, url, payload, sha1, refers_to, revisit) below ``folder``; one manifest row per package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        made, open_one = [], None
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "sha1", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, payload, sha1, refers_to, revisit = (c[i].as_py() for c in columns)
                if open_one is None:
                    store.create_dir(root, recursive=True)
                    open_one = Package(store, f"{root}/{uuid.uuid4().hex}.zip")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                open_one.add(warc_record(page_id, url, payload, digest, refers_to, revisit, date))
                if open_one.offset >= package_bytes:
                    made.append((open_one.path, *open_one.close()))
                    open_one = None
        if open_one is not None:
            made.append((open_one.path, *open_one.close()))
        paths, sizes, counts = ([m[k] for m in made] for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["path", "bytes", "records"])

    return pages.select("page_id", "url", "payload", "sha1", "refers_to", "revisit").mapInArrow(run, MANIFEST)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Mark each row (page_id, url, payload) as response or revisit of the largest page_id with its payload.

    The payload of a page with an equal partner is moved once, next to the one row of its group; a
    payload that a third of all rows share is a skewed join partition, which Spark splits. If a group
    has only NULL ids, all its rows are responses.
    """
    keyed = pages.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload"))
    groups = keyed.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"), F.max("payload_bytes").alias("longest"))
    shared = cut_lineage(groups.where((F.col("n") > 1) & (F.col("longest") >= least_bytes)).select("sha1", "refers_to"))
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return keyed.join(shared.hint("shuffle_hash"), "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


# --- reading ---------------------------------------------------------------------------------

def read_range(file: BinaryIO, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"{length} bytes wanted at {start}, {len(data)} read")
    return data


def zip_directory(file: BinaryIO, size: int) -> list[tuple[str, int, int, int, int]]:
    """(name, method, packed size, size, offset of the local header) of each member, ZIP64 included."""
    tail_start = max(0, size - 22 - FULL16)
    tail = read_range(file, tail_start, size - tail_start)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        end64 = read_range(file, struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != END64:
            raise ValueError("the ZIP64 locator leads to no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    data, at, found = read_range(file, start, length), 0, []
    for _ in range(count):
        if data[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, full, name_n, extra_n, note_n = struct.unpack_from("<IIHHH", data, at + 20)
        offset = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = data[at + 46 + name_n:at + 46 + name_n + extra_n], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # the ZIP64 field holds, in this order, only what did not fit
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                offset = next(wide) if offset == FULL32 else offset
            k += 4 + n
        found.append((name, method, packed, full, offset))
        at += 46 + name_n + extra_n + note_n
    return found


def stored_start(file: BinaryIO, member: tuple[str, int, int, int, int]) -> int:
    """Where the bytes of a stored member begin."""
    name, method, _, _, offset = member
    if method != 0:
        raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
    head = read_range(file, offset, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {name}")
    return offset + 30 + sum(struct.unpack_from("<HH", head, 26))


def locate_ranges(manifest: DataFrame, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Runs of neighbouring records of all packages: (path, start, lengths), about ``chunk_bytes`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                rows: list[tuple[str, int, list[int]]] = []
                store, inside = open_store(path)
                with store.open_input_file(inside) as file:
                    members = {m[0]: m for m in zip_directory(file, size)}
                    base = stored_start(file, members[DATA_MEMBER])
                    index = read_range(file, stored_start(file, members[INDEX_MEMBER]), members[INDEX_MEMBER][3])
                for line in index.decode().splitlines():
                    offset, length = map(int, line.split())
                    if not rows or sum(rows[-1][2]) >= chunk_bytes:
                        rows.append((path, base + offset, []))
                    rows[-1][2].append(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return manifest.select("path", "bytes").mapInArrow(run, RANGES)


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _page_of(urn: str | None) -> int | None:
    text = (urn or "<urn:page:null>").removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def read_records(ranges: DataFrame) -> DataFrame:
    """Range-read the runs and parse each record; a response's digest is computed from its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(n).to_pylist() for n in ("path", "start", "lengths"))):
                store, inside = open_store(path)
                with store.open_input_file(inside) as file:
                    data, at, rows = memoryview(read_range(file, start, sum(lengths))), 0, []
                for length in lengths:
                    fields, http, payload = parse_record(zlib.decompress(data[at:at + length], 31))
                    at += length
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest:
                            raise ValueError(f"{path}: a payload of {fields['WARC-Record-ID']} does not match its digest")
                    rows.append((_page_of(fields["WARC-Record-ID"]), int(http["Content-Length"]), digest,
                                 fields["WARC-Type"], _page_of(fields.get("WARC-Refers-To"))))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return ranges.mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages (page_id, url, html) to packages and read every record back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    manifest = cut_lineage(write_packages(with_revisits(rows, least_bytes), folder))
    ranges = locate_ranges(manifest)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    records = cut_lineage(read_records(ranges.repartition(int(tasks), "path", "start")))
    drop_scratch(spark, folder)
    return records


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
