"""WARC records in ZIP packages: a writer, and a reader that extracts nothing.

A package is a ZIP file with stored (uncompressed) members: WARC files whose records
are gzip members of their own, and an index beside each. The reader parses the ZIP's
directories, finds where the members lie, reads the index and then only the byte
ranges of records.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.llm.common import decided
from dimload.sources.scratch import cut_lineage, scratch_dir

#: Payloads shorter than this are always written in full.
LEAST_BYTES = 100
#: Records in one package at most, and bytes that one read asks for (one record at least).
RECORDS, RANGE = 20_000, 4 << 20
DATE = "1970-01-01T00:00:00Z"
ARCHIVE, INDEX = "archive/pages.warc.gz", "indexes/pages.cdxj"
_END, _END64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def file_system(uri: str):
    """The file system of a URI, or of an absolute local path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def urn(row_id: str | None) -> str:
    return "urn:row:" + quote(row_id or "", safe="")


def record(row_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"), f"WARC-Record-ID: <{urn(row_id)}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    block = http + payload
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{urn(refers_to)}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        block = http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The record's fields; a payload that does not match its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    bare = lambda x: unquote(x[len("<urn:row:") : -1]) or None
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != sizes[0] or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest or length")
    return {
        "record_id": bare(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "url": fields.get("warc-target-uri"),
        "refers_to": bare(fields["warc-refers-to"]) if revisit else None,
        "payload_bytes": sizes[0],
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


class _Package:
    """A ZIP package being written to a stream that cannot seek."""

    def __init__(self, target):
        self.zip = zipfile.ZipFile(target, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, name: str, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        self.member.write(packed)
        self.lines.append(f"{name} {json.dumps({'offset': self.at, 'length': len(packed)})}\n")
        self.at += len(packed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX, "w") as index:
            for line in self.lines:
                index.write(line.encode())
        self.zip.close()


def _writer(folder: str, records: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        task, package, written = TaskContext.get().partitionId(), None, []

        def close() -> None:
            package.close()
            stream.close()
            written.append((name, len(package.lines)))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if package is None:
                    # A name of its own for each attempt: only those of tasks that end are ever read.
                    name = f"{folder}/pages-{task:06d}-{uuid.uuid4().hex}.wacz"
                    files.create_dir(path, recursive=True)
                    stream = files.open_output_stream(f"{path}/{name.rsplit('/', 1)[1]}")
                    package = _Package(stream)
                package.add(urn(row[0]), record(*row))
                if len(package.lines) >= records:
                    close()
                    package = None
        if package is not None:
            close()
        yield pa.RecordBatch.from_pydict({"archive": [w[0] for w in written], "records": pa.array([w[1] for w in written], pa.int64())})

    return write


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    records: int = RECORDS,
) -> DataFrame:
    """Writes a record per row of ``pages`` and returns ``archive, records`` of what was written.

    Payloads are the texts in UTF-8, empty for NULL. Of rows whose payloads are equal and
    have ``least_bytes`` at least, that with the smallest id is a response and the others
    are revisits of it; rows that repeat the smallest id are all responses, a NULL id is
    larger than any. Shorter payloads are all responses. A NULL URL is left out; other
    columns are not looked at; no rows, no archives.

    Packages go to ``folder`` (a new one in the checkpoint folder if not given), under
    names that no second attempt shares. The list of packages is written to the
    checkpoint folder, so reading them never writes them again. Equal payloads meet as
    digests, combined before the shuffle; what is joined back are the digests that
    stand more than once."""
    spark = pages.sparkSession
    folder = folder or f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("id"), F.make_valid_utf8(F.col(url).cast("string")).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
    )
    rows = decided(rows, cut_lineage(first), F.col("digest") == F.col("of"), "left", F.lit(64 + 16))
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", refers.alias("refers_to"))
    return cut_lineage(rows.mapInArrow(_writer(folder, records), "archive string, records long"))


def stored_members(file, size: int) -> dict[str, tuple[int, int]]:
    """``{name: (offset, length)}`` of the stored members of a ZIP file, from its directories.

    Looks for the end record in the last 64 KB, follows the ZIP64 locator where a field
    is saturated, reads the central directory (ZIP64 extra fields included) and each
    local header. Compressed or encrypted members are passed over."""

    def read(offset: int, length: int) -> bytes:
        file.seek(offset)
        data = file.read(length)
        if len(data) != length:
            raise ValueError("the ZIP file is cut off")
        return data

    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = tail[end - 20 : end]
        if locator[:4] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        end64 = read(struct.unpack("<Q", locator[8:16])[0], 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack("<QQQ", end64[32:56])
    directory, at, found = read(start, length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("bad entry in the central directory")
        flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
        packed, full, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        offset = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n :]
        if method == 0 and not flags & 1 and packed == full:
            local = read(offset, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"{name}: bad local header")
            found[name] = (offset + 30 + sum(struct.unpack("<HH", local[26:30])), packed)
    return found


#: Ranges that a task reads, about.
RANGES = 8


def _ranges(bytes_at_once: int):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each package the byte ranges of its records, neighbours together."""
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, path = file_system(archive)
                out: list[tuple[int, int]] = []
                with files.open_input_file(path) as file:
                    members = stored_members(file, file.size())
                    for name, (offset, length) in members.items():
                        if not name.startswith("indexes/"):
                            continue
                        base = members["archive/" + name[len("indexes/") :].removesuffix(".cdxj") + ".warc.gz"][0]
                        file.seek(offset)
                        for line in file.read(length).splitlines():
                            at = json.loads(line.split(b" ", 1)[1])
                            begin, n = base + at["offset"], at["length"]
                            if out and sum(out[-1]) == begin and out[-1][1] + n <= bytes_at_once:
                                out[-1] = (out[-1][0], out[-1][1] + n)
                            else:
                                out.append((begin, n))
                yield pa.RecordBatch.from_pydict(
                    {
                        "archive": pa.array([archive] * len(out), pa.string()),
                        "offset": pa.array([o for o, _ in out], pa.int64()),
                        "length": pa.array([n for _, n in out], pa.int64()),
                    }
                )

    return ranges


_RECORD = pa.schema(
    [
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


#: Bytes of unpacked records passed on at a time, and of packed ones unpacked at a time.
BATCH, BLOCK = 16 << 20, 1 << 16


def _unpacked(data: bytes) -> Iterator[tuple[int, bytes]]:
    """The gzip members of a range, each with its place. What is beyond a member's end is copied
    by ``zlib``, so it gets a block at a time, not the rest of the range."""
    at = 0
    while at < len(data):
        begin, unpack, parts = at, zlib.decompressobj(31), []
        while not unpack.eof:
            block = data[at : at + BLOCK]
            if not block:
                raise ValueError("a record is cut off")
            parts.append(unpack.decompress(block))
            at += len(block)
        at -= len(unpack.unused_data)
        yield begin, b"".join(parts)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            files, path = file_system(archive)
            with files.open_input_file(path) as file:
                data = file.read_at(length, offset)
            rows, size = [], 0
            for at, record in _unpacked(data):
                rows.append(parse_record(record) | {"archive": archive, "offset": offset + at})
                size += len(record)
                if size >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def read_archives(spark: SparkSession, archives: DataFrame, bytes_at_once: int = RANGE) -> DataFrame:
    """All records of the packages in column ``archive``: ``archive, offset, record_id,
    record_type, url, refers_to, payload_bytes, payload_digest, payload``.

    ``payload`` is NULL for a revisit; size and digest are those of the full payload.
    First the directories and indexes are read, then ranges of a few megabytes are
    dealt to tasks, ``RANGES`` each or fewer, so one large package is read by many. A package without records
    gives none; a damaged one is an error."""
    found = archives.select("archive").mapInArrow(_ranges(bytes_at_once), "archive string, offset long, length long")
    # Few rows that are much work: without a number of tasks they would be merged into one.
    found = cut_lineage(found)
    total = found.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (RANGES * bytes_at_once))
    found = found.repartition(tasks, "archive", "offset")
    schema = (
        "archive string, offset long, record_id string, record_type string, url string, refers_to string, "
        "payload_bytes long, payload_digest string, payload binary"
    )
    return found.mapInArrow(_read, schema)
