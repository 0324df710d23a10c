import gzip
import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from dimload.llm import warc

PAGES = [
    (5, "http://a/?q=1 2\r\nX: y", "p" * 100),
    (3, "http://b", "p" * 100),
    (3, "http://b", "p" * 100),
    (9, None, "p" * 100),
    (None, "http://c", "p" * 100),
    (10, "u", "short"),
    (11, "u", "short"),
    (12, "u", None),
    (13, "", ""),
    (14, "é", "ü" * 49 + "x"),
    (15, "é", "ü" * 50),
    (16, "é", "ü" * 50),
    (17, "long", "line \r\n\r\n WARC/1.1\r\n" * 60_000),
    (18, "long", "line \r\n\r\n WARC/1.1\r\n" * 60_000),
    (None, None, None),
]


@pytest.mark.parametrize("records, bytes_at_once", [(20_000, 4 << 20), (3, 4 << 20), (4, 1)])
def test_round_trip(spark, records, bytes_at_once):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumns({c: F.lit("extra") for c in ("id", "digest", "payload", "first", "archive")})
    written = warc.write_archives(pages, records=records)
    found = warc.read_archives(spark, written, bytes_at_once).collect()
    assert written.agg(F.sum("records")).first()[0] == len(found) == len(PAGES)
    bodies = [(i, (h or "").encode()) for i, _, h in PAGES]
    want = []
    for i, b in bodies:
        first = min((j for j, c in bodies if c == b and j is not None), default=None)
        refers = first if len(b) >= 100 and first is not None and i != first else None
        want.append((str(i), len(b), hashlib.sha256(b).hexdigest(), "revisit" if refers else "response", str(refers)))
    got = [(str(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in found]
    assert sorted(got) == sorted(want)
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        else:
            assert r.payload is None
    assert {r.url for r in found if r.record_id == "9"} == {None}
    assert "\n" not in "".join(r.url or "" for r in found)


def test_no_rows(spark):
    written = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert written.count() == 0 and warc.read_archives(spark, written).count() == 0


def packed(comment=b"", many=0, compressed=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", b"first")
        for i in range(many):
            z.writestr(f"m/{i}", b"")
        with z.open("b.txt", "w", force_zip64=True) as f:
            f.write(b"second member")
        if compressed:
            z.writestr("c.txt", b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("options", [{}, {"comment": b"PK" * 300}, {"compressed": True}, {"many": 66_000}])
def test_directories(options):
    data = packed(**options)
    members = warc.stored_members(io.BytesIO(data), len(data))
    for name, content in (("a.txt", b"first"), ("b.txt", b"second member")):
        offset, length = members[name]
        assert data[offset : offset + length] == content
    assert "c.txt" not in members and len(members) == 2 + options.get("many", 0)


def test_zip64_fields():
    """Sizes and offsets that only the extra field of the central directory holds."""
    data = packed()
    at = data.index(b"PK\x01\x02")
    size, offset = struct.unpack("<I", data[at + 20 : at + 24])[0], struct.unpack("<I", data[at + 42 : at + 46])[0]
    extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
    full = b"\xff" * 4
    entry = data[at : at + 20] + full * 2 + data[at + 28 : at + 30] + struct.pack("<H", len(extra)) + data[at + 32 : at + 42] + full
    entry += data[at + 46 : at + 51] + extra
    end = data.rindex(b"PK\x05\x06")
    rest = data[at + 51 : end]
    directory = entry + rest
    head = data[:at]
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 2, 2, len(directory), len(head))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(head) + len(directory), 1)
    last = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    wide = head + directory + end64 + locator + last
    assert warc.stored_members(io.BytesIO(wide), len(wide)) == warc.stored_members(io.BytesIO(data), len(data))


@pytest.mark.parametrize("data", [b"", b"not a zip file", packed()[:-30], packed()[30:]])
def test_damage_is_an_error(data):
    with pytest.raises((ValueError, struct.error)):
        warc.stored_members(io.BytesIO(data), len(data))


def test_changed_payload_is_an_error():
    record = warc.record("1", "u", b"body", hashlib.sha256(b"body").hexdigest(), None)
    assert warc.parse_record(record)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"body", b"bode"))


def test_ranges_are_dealt_to_tasks_by_their_bytes(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "repeat(md5(string(id)), 40) AS html").repartition(2)
    written = warc.write_archives(pages)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64m")
    few = warc.read_archives(spark, written, bytes_at_once=1 << 20)
    many = warc.read_archives(spark, written, bytes_at_once=200)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    tasks = [df.select(F.spark_partition_id().alias("p")).distinct().count() for df in (few, many)]
    assert tasks[0] <= 8 < 20 < tasks[1]
    assert few.count() == many.count() == 400


def test_records_of_a_range_are_unpacked_block_by_block(monkeypatch):
    records = [bytes([k % 251]) * (k * 37) for k in range(200)]
    data = b"".join(gzip.compress(r) for r in records)
    for block in (1, 100, 1 << 16):
        monkeypatch.setattr(warc, "BLOCK", block)
        found = list(warc._unpacked(data))
        assert [r for _, r in found] == records and [a for a, _ in found] == sorted({a for a, _ in found})
    with pytest.raises(ValueError, match="cut off"):
        list(warc._unpacked(data[:-3]))
