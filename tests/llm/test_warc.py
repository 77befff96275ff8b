"""WARC archives: round trips, revisits, damaged and foreign archives."""

import hashlib
import struct
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from glossaflow.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest int, first string"


@pytest.fixture
def folder(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA)


def expected(rows):
    """By hand, over all rows."""
    sizes = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, body in sizes:
        same = [j for j, other in sizes if other == body and j is not None]
        first = min(same) if same and len(body) >= 100 else None
        refers = first if first is not None and i != first else None
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers, None))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_round_trip_of_odd_pages(spark, folder):
    long = "é" * 60
    rows = [
        (1, "http://a/b c\r\nX: y", None), (2, None, ""), (3, "", "short"), (4, "http://a", "short"), (9, "u", long), (5, "u", long), (5, "u", long), (7, "v", long), (None, "w", long),
        (None, "w", "lone" * 40), (8, "x", "y" * 99), (10, "x", "y" * 99), (11, "x", "z" * 100), (12, "x", "z" * 100), (13, "x", "\r\n\r\nWARC/1.1\r\n" * 9), (14, "big", "long text " * 300_000), (-3, "x", "z" * 100),
    ]
    frame = warc.round_trip(pages(spark, rows), folder())
    assert frame.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    assert got(frame) == expected(rows)


def test_empty_table(spark, folder):
    assert got(warc.round_trip(pages(spark, []), folder())) == []


def test_many_pages_in_archives_of_few_records(spark, folder):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 40} of the book</p>" * (i % 9)) for i in range(400)]
    digested, path = warc.digested(pages(spark, rows)), folder()
    marked, dictionary = warc.mark_revisits(digested), warc.train(digested)
    assert dictionary[:4] == struct.pack("<I", warc.DICTIONARY)
    warc.write_archives(marked.coalesce(1), path, dictionary=dictionary, records=50)
    files = spark.read.format("binaryFile").load(path).collect()
    # 400 records in archives of 49 and a dictionary each.
    assert len(files) == 9 and all(bytes(f["content"][:4]) == struct.pack("<I", warc.DICTIONARY_FRAME) for f in files)
    read = warc.read_archives(spark, path)
    assert read.where("problem is not null").count() == 0
    assert {r["record_id"]: (r["record_type"], r["target"]) for r in read.collect()} == {f"urn:record:{i}": (k, f"http://h/{i}") for i, _, _, k, _, _ in expected(rows)}
    held = {r["record_id"]: bytes(r["payload"]).decode() for r in read.where("record_type = 'response'").collect()}
    assert all(text == rows[int(name.split(":")[2])][2] for name, text in held.items())
    # A record's frame opens with the dictionary only.
    sound = next(r for r in read.where("record_type = 'response' and payload_bytes > 100").collect())
    content = next(bytes(f["content"]) for f in files if f["path"] == sound["archive"])
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(content[sound["offset"] : sound["offset"] + sound["frame_bytes"]])


def plain(name="urn:record:1", body=b"text", **changes):
    raw = warc.record("response", name, "2020-01-01T00:00:00Z", "http://a", body, len(body), hashlib.sha256(body).hexdigest())
    for old, new in changes.get("swaps", ()):
        assert old in raw
        raw = raw.replace(old, new)
    return raw


@pytest.mark.parametrize(
    "swaps, problem",
    [
        ([(b"WARC/1.1", b"WARC/2.0")], "no record header"),
        ([(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b"")], "no warc-date"),
        ([(b"WARC-Type: response\r\n", b"no colon\r\n")], "a header line without a name"),
        ([(b"Content-Length: 4\r\n\r\ntext", b"Content-Length: 3\r\n\r\ntext")], "block digest differs"),
        ([(b"\r\n\r\ntext\r\n\r\n", b"\r\n\r\ntext")], "shorter than Content-Length"),
        ([(b"\r\n\r\ntext\r\n\r\n", b"\r\n\r\ntext\r\n\r\nmore")], "longer than Content-Length"),
        ([(b"text\r\n", b"tEXt\r\n")], "block digest differs"),
    ],
)
def test_unsound_records_are_told(swaps, problem):
    with pytest.raises(ValueError, match=problem):
        warc.parse(plain(swaps=swaps))


def test_payload_digest_and_length_are_checked():
    body = b"text"
    raw = warc.record("response", "a", "2020", None, body, 4, "0" * 64)
    with pytest.raises(ValueError, match="payload digest differs"):
        warc.parse(raw)
    raw = warc.record("response", "a", "2020", None, body, 5, hashlib.sha256(body).hexdigest())
    with pytest.raises(ValueError, match="payload of another length"):
        warc.parse(raw)


def test_damage_costs_what_it_hits():
    """Frames of any form; a bad one is one problem, a cut-off one ends it."""
    pack = zstandard.ZstdCompressor(level=3, write_checksum=True).compress
    unsized = zstandard.ZstdCompressor(write_content_size=False).compress(plain("b"))
    noise = zstandard.ZstdCompressor(level=1).compress(plain("c", bytes(range(256)) * 2000))
    bad = bytearray(pack(plain("d", b"x" * 500)))
    bad[-1] ^= 1
    skip = struct.pack("<II", warc.SKIPPABLE + 3, 5) + b"hello"
    good = pack(plain("a"))
    whole = good + skip + unsized + noise + bytes(bad) + pack(b"two records " * 3) + pack(plain("e"))
    found = list(warc.records_of(whole))
    assert [(r.get("record_id"), r["problem"] is None) for r in found] == [("a", True), ("b", True), ("c", True), (None, False), (None, False), ("e", True)]
    cut = list(warc.records_of(whole[:-3]))
    assert cut[-1]["problem"] == "cut off" and len(cut) == len(found)
    assert [r["problem"] for r in warc.records_of(good + b"junk" + good)] == [None, "no frame"]
    lead = struct.pack("<II", warc.DICTIONARY_FRAME, 4) + b"abcd"
    assert [r["problem"] for r in warc.records_of(lead + good)] == ["no dictionary in the leading frame"]


def test_dictionary_frames_plain_and_compressed():
    trained = zstandard.train_dictionary(2000, [plain(str(i), b"some words %d" % i) for i in range(200)])
    frame = zstandard.ZstdCompressor(dict_data=trained).compress(plain("a"))
    for content in (trained.as_bytes(), zstandard.compress(trained.as_bytes())):
        lead = struct.pack("<II", warc.DICTIONARY_FRAME, len(content)) + content
        assert [r["record_id"] for r in warc.records_of(lead + frame)] == ["a"]
    # Not at the start it is passed over as any skippable frame.
    other = zstandard.compress(plain("b"))
    assert [r["record_id"] for r in warc.records_of(other + lead + other)] == ["b", "b"]


def test_references_are_checked(spark):
    rows = [("response", "a", None, 10, "d1"), ("revisit", "b", "a", 10, "d1"), ("revisit", "c", "a", 11, "d1"), ("revisit", "e", "gone", 10, "d1"), ("revisit", "f", "a", 10, "d2"), ("revisit", "g", "a", 10, None)]
    records = spark.createDataFrame([(*r, None) for r in rows], "record_type string, record_id string, refers_to string, payload_bytes long, payload_digest string, problem string")
    assert {r["record_id"] for r in warc.verified(records).where(F.col("problem").isNotNull()).collect()} == {"c", "e", "f"}
