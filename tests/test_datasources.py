"""Registered data sources: containers, parts, damage, pushed filters."""

import gzip
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from glossaflow.plans import built
from glossaflow.sources import datasources, mdict, stardict

ENTRIES = [(f"word {i} قط", f"<b>text {i}</b> " + "body é قط " * (i % 50)) for i in range(500)]


def reader(data):
    return lambda at, n: data[at : at + n]


@pytest.fixture(scope="module")
def sources(spark):
    datasources.register(spark)
    return spark


def test_digest():
    assert mdict.ripemd128(b"").hex() == "cdf26213a150dc3ecb610f18f6b38b46"
    assert mdict.ripemd128(b"message digest").hex() == "9e327b3d6e523062afc1132d7df9d1b8"


@pytest.mark.parametrize("settings", [{}, {"wide": True}, {"secret": True}, {"new": False}, {"new": False, "wide": True}, {"header": "utf-8"}, {"packed": False, "block": 100}])
def test_containers(settings):
    data = built.mdx(ENTRIES, **settings)
    box = mdict.open_container(reader(data))
    assert box.entries == 500 and len(box.keys) > 2 and len(box.records) > 2
    whole = list(mdict.entries_of(box, range(len(box.keys)), reader(data)))
    assert whole == [(i, k, v) for i, (k, v) in enumerate(ENTRIES)]
    parts = [e for n in range(len(box.keys)) for e in mdict.entries_of(box, range(n, n + 1), reader(data))]
    assert parts == whole


def test_container_by_hand():
    """Bytes put together without the builder."""
    head = '<Dictionary GeneratedByEngineVersion="1.0" Encoding="UTF-8"/>\0'.encode("utf-16-le")
    keys = struct.pack(">I", 0) + b"cat\0" + struct.pack(">I", 4) + b"dog\0"
    block = b"\0\0\0\0" + struct.pack(">I", zlib.adler32(keys)) + keys
    index = struct.pack(">I", 2) + b"\3cat\3dog" + struct.pack(">II", len(block), len(keys))
    body = b"one\0two\0"
    record = b"\2\0\0\0" + struct.pack(">I", zlib.adler32(body)) + zlib.compress(body)
    data = struct.pack(">I", len(head)) + head + struct.pack("<I", zlib.adler32(head)) + struct.pack(">4I", 1, 2, len(index), len(block)) + index + block
    data += struct.pack(">4I", 1, 2, 8, len(record)) + struct.pack(">2I", len(record), len(body)) + record
    box = mdict.open_container(reader(data))
    assert list(mdict.entries_of(box, range(1), reader(data))) == [(0, "cat", "one"), (1, "dog", "two")]
    # A cut-off tail: the last block does not inflate, or is dropped.
    with pytest.raises(ValueError):
        list(mdict.entries_of(box, range(1), reader(data[:-2])))
    assert list(mdict.entries_of(box, range(1), reader(data[:-2]), drop=True)) == []


def test_damage_costs_its_blocks_only():
    data = bytearray(built.mdx(ENTRIES, block=2000))
    box = mdict.open_container(reader(bytes(data)))
    before, place, size, whole = box.records[2]
    data[place + size - 1] ^= 1
    kept = {p for p, _, _ in mdict.entries_of(box, range(len(box.keys)), reader(bytes(data)), drop=True)}
    ends, at = [], 0
    for _, v in ENTRIES:
        ends.append((at, at + len(v.encode()) + 1))
        at = ends[-1][1]
    assert kept == {i for i, (a, b) in enumerate(ends) if b <= before or a >= before + whole}
    data[place + size - 1] ^= 1
    _, place, size, _ = box.keys[1]
    data[place + 4] ^= 1
    kept = [p for p, _, _ in mdict.entries_of(box, range(len(box.keys)), reader(bytes(data)), drop=True)]
    first, last = box.keys[1][0], box.keys[2][0]
    assert kept == [p for p in range(500) if not first - 1 <= p < last]
    lzo = bytes(built.mdx(ENTRIES[:1], packed=False)).replace(b"\0\0\0\0" + struct.pack(">I", zlib.adler32(ENTRIES[0][1].encode() + b"\0")), b"\1\0\0\0" + struct.pack(">I", 5))
    box = mdict.open_container(reader(lzo))
    with pytest.raises(ValueError, match="LZO"):
        list(mdict.entries_of(box, range(1), reader(lzo)))


def test_dictzip_slices():
    data = bytes(range(256)) * 100
    for packed in (built.dictzip(data, 1000), gzip.compress(data)):
        zipped = stardict.DictZip(reader(packed))
        for at, n in ((0, 10), (999, 2), (5000, 5000), (25_590, 100), (3, 0), (100, 3)):
            assert zipped.slice(at, n) == data[at : at + n]
    named = built.dictzip(data)
    assert gzip.decompress(named) == data


def test_mdx_source_in_parts(sources, tmp_path):
    (tmp_path / "a.b.mdx").write_bytes(built.mdx([(" ", "no key"), *ENTRIES], block=1000, secret=True))
    (tmp_path / "c.mdx").write_bytes(built.mdx([], block=1000))
    frame = sources.read.format("mdx").option("partBytes", 20_000).load(str(tmp_path))
    assert frame.rdd.getNumPartitions() > 3
    got = sorted(tuple(r) for r in frame.collect())
    assert got == [(i + 1, k, " ".join(v.replace("<b>", "").replace("</b>", "").split()), "a.b") for i, (k, v) in enumerate(ENTRIES)]
    assert sources.read.format("mdx").load(str(tmp_path / "none")).collect() == []
    (tmp_path / "d.mdx").write_bytes(b"\0\0\0\5broken")
    with pytest.raises(Exception, match="header|unpack|buffer"):
        sources.read.format("mdx").load(str(tmp_path)).collect()
    assert sources.read.format("mdx").option("mode", "DROPMALFORMED").load(str(tmp_path)).count() == 500


@pytest.mark.parametrize("wide", [False, True])
def test_stardict_source_in_parts(sources, tmp_path, wide):
    for stem, kind, pack in (("plain", "m", None), ("zip.ped", "h", built.dictzip), ("gz", "h", gzip.compress)):
        ifo, idx, data = built.stardict(ENTRIES, kind, wide=wide)
        (tmp_path / f"{stem}.ifo").write_bytes(ifo)
        (tmp_path / f"{stem}.idx").write_bytes(idx + b"tail\0\0")
        (tmp_path / f"{stem}.dict{'.dz' if pack else ''}").write_bytes(pack(data) if pack else data)
    (tmp_path / "plain.syn").write_bytes(b"other name\0" + struct.pack(">I", 7) + b"more\0" + struct.pack(">I", 7) + b"last\0" + struct.pack(">I", 499))
    (tmp_path / "alone.ifo").write_bytes(b"x")
    frame = sources.read.format("stardict").option("partBytes", 10_000).load(str(tmp_path))
    assert frame.rdd.getNumPartitions() > 6
    squeezed = lambda v, marked: " ".join((v.replace("<b>", "").replace("</b>", "") if marked else v).split())
    want = sorted((i, k, squeezed(v, stem != "plain"), stem) for stem in ("plain", "zip.ped", "gz") for i, (k, v) in enumerate(ENTRIES))
    assert sorted(tuple(r) for r in frame.collect()) == want
    more = sources.read.format("stardict").option("synonyms", "true").option("partBytes", 100_000).load(str(tmp_path / "plain.ifo"))
    found = [r for r in more.collect() if not r["term"].startswith("word")]
    assert sorted((r["pos"], r["term"], r["definition"]) for r in found) == [(0, "other name", squeezed(ENTRIES[7][1], False)), (1, "more", squeezed(ENTRIES[7][1], False)), (2, "last", squeezed(ENTRIES[499][1], False))]


def test_stems_choose_files(sources, tmp_path):
    for stem in ("aa", "ab", "cc"):
        (tmp_path / f"{stem}.html").write_text(f'<w><a name="{stem}"/><div><b>x</b>text</div></w>')
    (tmp_path / "bad.html").write_bytes(b"\x1f\x8bbroken")
    kept = datasources.read_entries(sources, "dicthtml", str(tmp_path), ["aa", "cc", "none"])
    # The damaged file is not opened, nor is the other.
    assert kept.rdd.getNumPartitions() == 2
    assert sorted((r["term"], r["definition"]) for r in kept.where(F.col("source_file") != "cc").collect()) == [("aa", "text")]
    assert kept.count() == 2
    with pytest.raises(Exception, match="gzip|Compressed|header"):
        datasources.read_entries(sources, "dicthtml", str(tmp_path)).collect()
    assert datasources.read_entries(sources, "dicthtml", f"{tmp_path}/*.html", mode="DROPMALFORMED").count() == 3


def test_docx_source(sources, tmp_path):
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    for name, body in (("a", f"<w:tbl><w:tr><w:tc>{p(' ')}</w:tc><w:tc>{p('cat')}</w:tc><w:tc>{p('one')}{p('two')}</w:tc></w:tr></w:tbl>{p('no')}"), ("b", p("first  line") + p(" "))):
        with zipfile.ZipFile(tmp_path / f"{name}.docx", "w") as archive:
            archive.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    got = sorted(tuple(r) for r in datasources.read_entries(sources, "docx", str(tmp_path)).collect())
    assert got == [(0, "cat", "one two", "a"), (0, "first line", "", "b")]


def test_small_mdx_files_share_a_task(sources, tmp_path):
    """A task for each file was more work than the file."""
    for n in range(30):
        (tmp_path / f"f{n:02}.mdx").write_bytes(built.mdx([(f"k{n}", "v")], block=1000))
    (tmp_path / "long.mdx").write_bytes(built.mdx(ENTRIES, block=1000))
    frame = sources.read.format("mdx").option("partBytes", 10_000).load(str(tmp_path))
    alone = sources.read.format("mdx").option("partBytes", 10_000).load(str(tmp_path / "long.mdx"))
    assert 1 < alone.rdd.getNumPartitions() <= frame.rdd.getNumPartitions() <= alone.rdd.getNumPartitions() + 1
    assert sorted(r["term"] for r in frame.collect()) == sorted([k for k, _ in ENTRIES] + [f"k{n}" for n in range(30)])
