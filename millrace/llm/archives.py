"""WARC records in ZIP-packaged archives, read by ranges of bytes.

An archive is a ZIP file of stored (not deflated) members: WARC files under ``archive/`` and an index of their
records under ``indexes/``. The reader parses the central directory, with ZIP64 where sizes need it, finds where a
stored member's bytes begin, and then reads single records by their places in the archive; nothing is extracted.

Archives are written by tasks, one for each, into a folder that all executors share, through the file system that
the folder's URI names. A task that is run again writes under a new name, and only archives that a finished task
has reported are read.
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

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved, small_batches, steps
from millrace.session import scratch_path

# Signatures and sizes of the ZIP format's structures.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_SIZE, CENTRAL_SIZE, END_SIZE, END64_SIZE, LOCATOR64_SIZE = 30, 46, 22, 56, 20
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 1

INDEX_MEMBER = "indexes/index.cdxj"
WARC_MEMBER = "archive/data-{:05d}.warc.gz"
#: A WARC member is closed beyond this size, and an archive beyond so many members.
MEMBER_BYTES = 64 << 20
ARCHIVE_MEMBERS = 8
#: Records that are near each other in an archive are read together.
READ_BYTES = 2 << 20


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


# --- writing -----------------------------------------------------------------------------------------------


class ZipWriter:
    """Stored members, written one after the other to a stream that cannot go back.

    Sizes and checksums follow the data (in a descriptor) and stand in the central directory. ``zip64`` forces the
    large form, which is otherwise used where a number needs it.
    """

    def __init__(self, stream, zip64: bool = False):
        self.stream, self.zip64, self.at, self.members = stream, zip64, 0, []

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.current = [raw, self.at, 0, 0]
        # An empty ZIP64 field tells readers of the descriptor that its sizes have eight bytes.
        extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, 0, 0)
        self.write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x808, 0, 0, 0x21, 0, MAX32, MAX32, len(raw), len(extra)) + raw + extra)

    def data(self, data: bytes) -> int:
        """Append to the open member; returns where the data begin in the archive."""
        at = self.at
        self.current[2] = zlib.crc32(data, self.current[2])
        self.current[3] += len(data)
        self.write(data)
        return at

    def end(self) -> None:
        _, _, crc, size = self.current
        self.write(b"PK\x07\x08" + struct.pack("<IQQ", crc, size, size))
        self.members.append(self.current)

    def close(self) -> None:
        directory = self.at
        for raw, at, crc, size in self.members:
            large = self.zip64 or max(at, size) >= MAX32
            extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, at) if large else b""
            size, at = (MAX32, MAX32) if large else (size, at)
            self.write(
                CENTRAL
                + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x808, 0, 0, 0x21, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, at)
                + raw + extra
            )
        length, count = self.at - directory, len(self.members)
        if self.zip64 or max(directory, length) >= MAX32 or count >= MAX16:
            end64 = self.at
            self.write(END64 + struct.pack("<QHHIIQQQQ", END64_SIZE - 12, 45, 45, 0, 0, count, count, length, directory))
            self.write(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
            count, length, directory = MAX16, MAX32, MAX32
        self.write(END + struct.pack("<HHHHIIH", 0, 0, count, count, length, directory, 0))


def warc_record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = {"WARC-Type": kind, **headers, "Content-Length": str(len(block))}
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in lines.items()], "\r\n"]).encode() + block + b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- reading -----------------------------------------------------------------------------------------------


class ZipReader:
    """Members of an archive of which only ranges are read."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = {name: rest for name, *rest in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        if at < 0 or at + n > self.size:
            raise ValueError("archive is cut off")
        self.source.seek(at)
        return self.source.read(n)

    def _directory(self) -> Iterator[tuple[str, int, int, int]]:
        tail = self.read(start := max(0, self.size - END_SIZE - MAX16), self.size - start)
        at = tail.rfind(END)
        # A comment may hold the signature: the right one states where the archive ends.
        while at >= 0 and (len(tail) < at + END_SIZE or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP archive")
        count, length, first = struct.unpack_from("<HII", tail, at + 10)
        if MAX16 == count or MAX32 in (length, first):
            end = start + at
            locator = self.read(end - LOCATOR64_SIZE, LOCATOR64_SIZE) if end >= LOCATOR64_SIZE else b""
            if locator[:4] == LOCATOR64:
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
                if record[:4] != END64:
                    raise ValueError("no ZIP64 end of the central directory")
                count, length, first = struct.unpack_from("<QQQ", record, 32)
        entries, at = self.read(first, length), 0
        for _ in range(count):
            if entries[at : at + 4] != CENTRAL:
                raise ValueError("central directory is damaged")
            method, = struct.unpack_from("<H", entries, at + 10)
            packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", entries, at + 20)
            place, = struct.unpack_from("<I", entries, at + 42)
            name = entries[at + CENTRAL_SIZE : at + CENTRAL_SIZE + n_name].decode()
            extra = entries[at + CENTRAL_SIZE + n_name : at + CENTRAL_SIZE + n_name + n_extra]
            while len(extra) >= 4:
                field, n = struct.unpack_from("<HH", extra)
                if field == ZIP64_FIELD:
                    large = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                    size = large.pop(0) if size == MAX32 else size
                    packed = large.pop(0) if packed == MAX32 else packed
                    place = large.pop(0) if place == MAX32 else place
                extra = extra[4 + n :]
            yield name, method, size, place
            at += CENTRAL_SIZE + n_name + n_extra + n_comment

    def range_of(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member begin and how many they are."""
        method, size, place = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        local = self.read(place, LOCAL_SIZE)
        if local[:4] != LOCAL:
            raise ValueError(f"{name} has no local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return place + LOCAL_SIZE + n_name + n_extra, size


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[: int(headers["content-length"])]


# --- on Spark ----------------------------------------------------------------------------------------------

ARCHIVES = "path string, bytes long, records long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in steps(batches, "payload"):
        z = [pack.compress(x) for x in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(z, pa.binary()), batch.column("_key")],
            names=["page_id", "url", "z", "_key"],
        )


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with their payload (``z``, compressed) and, where an equal one of at least ``least_bytes`` has a larger id, that id."""
    # Compressed on the way: pages are the bulk of what is shuffled.
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    raw = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"), F.sha1(payload).alias("_key"))
    base = raw.mapInArrow(_compressed, "page_id long, url string, z binary, _key string")
    # Only payloads that occur again meet the pages, and of each one row.
    again = (
        raw.where(F.octet_length("payload") >= least_bytes)
        .groupBy("_key")
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _last is not null")
        .drop("_n")
    )
    return (
        base.join(again, "_key", "left")
        .withColumn("refers_to", F.expr("if(_last > page_id or (_last is not null and page_id is null), _last, null)"))
        .select("page_id", "url", "z", "refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages as WARC records into archives under ``folder``; returns (path, bytes, records) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root)
        archive, unpack = None, zstandard.ZstdDecompressor()
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            if archive:
                writer, stream, name, index = archive
                writer.end()
                writer.begin(INDEX_MEMBER)
                for line in index:
                    writer.data(line)
                writer.end()
                writer.close()
                stream.close()
                done.append((f"{folder}/{name}", writer.at, len(index)))

        for row in (r for batch in batches for k in range(0, batch.num_rows, 200) for r in batch.slice(k, 200).to_pylist()):
            if archive and archive[0].current[3] >= MEMBER_BYTES:
                if len(archive[0].members) + 1 >= ARCHIVE_MEMBERS:
                    close()
                    archive = None
                else:
                    archive[0].end()
                    archive[0].begin(WARC_MEMBER.format(len(archive[0].members)))
            if not archive:
                name = f"{uuid.uuid4().hex}.wacz"
                stream = store.open_output_stream(f"{root}/{name}")
                archive = (ZipWriter(stream), stream, name, [])
                archive[0].begin(WARC_MEMBER.format(0))
            writer, _, _, index = archive
            payload, revisit = unpack.decompress(row["z"]), row["refers_to"] is not None
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
            headers = {
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Target-URI": json.dumps(row["url"])[1:-1] if row["url"] is not None else "",
                "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
                "Content-Type": "application/http; msgtype=response",
                "X-Page-ID": "" if row["page_id"] is None else str(row["page_id"]),
            }
            if row["url"] is None:
                del headers["WARC-Target-URI"]
            if revisit:
                headers |= {
                    "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    "X-Refers-To-Page-ID": str(row["refers_to"]),
                }
            record = warc_record("revisit" if revisit else "response", headers, http if revisit else http + payload)
            # Each record is a gzip member of its own, so it can be read alone; the ZIP member stays stored.
            record = gzip.compress(record, mtime=0)
            member = WARC_MEMBER.format(len(writer.members))
            in_member = writer.current[3]
            writer.data(record)
            index.append(json.dumps({"page_id": row["page_id"], "filename": member, "offset": in_member, "length": len(record)}).encode() + b"\n")
        close()
        paths, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(paths), pa.string()), pa.array(list(sizes), pa.int64()), pa.array(list(counts), pa.int64())],
            names=["path", "bytes", "records"],
        )

    return saved(pages.select("page_id", "url", "z", "refers_to").mapInArrow(run, ARCHIVES), "archives")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, place = open_store(path)
            with store.open_input_file(place) as source:
                reader = ZipReader(source, source.size())
                starts = {m: reader.range_of(m)[0] for m in reader.members if m.startswith("archive/")}
                lines = [json.loads(x) for x in reader.read(*reader.range_of(INDEX_MEMBER)).splitlines()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(lines), pa.string()),
                    pa.array([starts[x["filename"]] + x["offset"] for x in lines], pa.int64()),
                    pa.array([x["length"] for x in lines], pa.int64()),
                ],
                names=["path", "at", "length"],
            )


def list_records(archives: DataFrame) -> DataFrame:
    """(path, at, length) of every record of the archives, from their directories and indexes alone."""
    return archives.mapInArrow(_listed, "path string, at long, length long")


def read_records(ranges: DataFrame) -> DataFrame:
    """Records by (path, at, length); neighbours in an archive are read in one go of bounded size."""
    return ranges.mapInArrow(_read, RECORDS)


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the archives, listed and read by one worker of each task."""
    return archives.mapInArrow(lambda batches: _read(_listed(batches)), RECORDS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = sorted(zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length")), strict=True))
        first = 0
        while first < len(wanted):
            path, begin, n = wanted[first]
            last, end = first + 1, begin + n
            while last < len(wanted) and wanted[last][0] == path and wanted[last][1] <= end and wanted[last][1] + wanted[last][2] - begin <= READ_BYTES:
                end = max(end, wanted[last][1] + wanted[last][2])
                last += 1
            store, place = open_store(path)
            with store.open_input_file(place) as source:
                data = source.read_at(end - begin, begin)
            rows = [_record(data[at - begin : at - begin + n]) for _, at, n in wanted[first:last]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)],
                names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"],
            )
            first = last


def _record(data: bytes) -> tuple:
    headers, block = parse_record(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != int(http["content-length"]) or payload_digest(payload) != stated):
        raise ValueError("payload differs from its digest")
    url = headers.get("warc-target-uri")
    number = lambda key: int(headers[key]) if headers.get(key) else None
    return (
        number("x-page-id"), None if url is None else json.loads(f'"{url}"'), headers["warc-type"], number("x-refers-to-page-id"),
        int(http["content-length"]), stated, None if revisit else payload,
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write every page into archives in the shared folder and read all records back by their ranges.

    A null html is an empty payload. Pages with equal payloads of at least ``least_bytes`` are revisits of the one
    with the largest id; repeated rows of that largest id are all responses, and a null id is smaller than any. A
    group of null ids only has no revisits. An empty table gives no records. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    folder = scratch_path(pages.sparkSession, "wacz")
    archives = write_archives(with_revisits(pages, least_bytes), folder)
    # A fixed number: paths are few bytes, and adaptive execution would read all archives in one task.
    return read_archives(archives.repartition(min(max(archives.count(), 1), 10_000), "path"))


def digests(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same in SQL.
SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), named AS (
    SELECT page_id, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY payload) AS response,
        array_to_string(list_transform(range(4), lambda k: translate(lpad(to_base(('0x' || substr(digest, 10 * k + 1, 10))::BIGINT, 32), 8, '0'),
            '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM named
"""
