"""Readers and writers on small built files."""

import gzip
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from glossaflow.operators import merge
from glossaflow.plans import conversion
from glossaflow.sinks import files as sinks
from glossaflow.sources import files as sources


def stardict(folder, stem, entries, kind, packed):
    data, idx = b"", b""
    for word, definition in entries:
        body = definition.encode()
        idx += word.encode() + b"\0" + struct.pack(">II", len(data), len(body))
        data += body
    (folder / f"{stem}.ifo").write_text(f"StarDict\nbookname=x\nsametypesequence={kind}\n")
    (folder / f"{stem}.idx").write_bytes(idx + b"tail\0\0")
    if packed:
        (folder / f"{stem}.dict.dz").write_bytes(gzip.compress(data))
    else:
        (folder / f"{stem}.dict").write_bytes(data)


def test_stardict(spark, tmp_path):
    stardict(tmp_path, "plain", [("cat", " قط  كبير "), ("dog", "كلب")], "m", False)
    stardict(tmp_path, "marked", [("ant", "<b>نملة</b><script>x</script> &amp;")], "h", True)
    got = sources.read_stardict(spark, str(tmp_path)).orderBy("source_file", "pos").collect()
    assert [tuple(r) for r in got] == [(0, "ant", "نملة &", "marked"), (0, "cat", "قط كبير", "plain"), (1, "dog", "كلب", "plain")]


def test_dicthtml(spark, tmp_path):
    body = '<w><a name="cat"/><div><b>cat</b><br/>قط</div></w><w><b>dog</b> كلب</w><w>none</w>'
    (tmp_path / "aa.html").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "bb.html").write_bytes(b"\x1f\x8bbroken")
    packed = bytearray(gzip.compress(body.encode() * 50))
    packed[20] ^= 255
    (tmp_path / "cc.html").write_bytes(bytes(packed))
    (tmp_path / "dd.html").write_bytes(gzip.compress(body.encode())[:-9])
    got = sources.read_dicthtml(spark, str(tmp_path)).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, "cat", "قط", "aa"), (1, "dog", "dog كلب", "aa")]


def test_the_first_anchor_decides():
    html = '<w><a/><a name="x  y"/><b> bold <i> it </i></b><div>d</div></w><w><a name=" x  y "/><div><b>p</b>q<b>r</b></div></w><w><a name=""/>z</w>'
    assert sources.html_entries(html.encode()) == [("boldit", "d"), (" x  y ", "q r")]


def docx(path, tables, paragraphs):
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    rows = "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in row) + "</w:tr>" for row in tables)
    table = f"<w:tbl>{rows}</w:tbl>" if tables else ""
    xml = f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{table}{"".join(map(p, paragraphs))}</w:body></w:document>'
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", xml)


def test_docx_paragraphs_count_only_without_tables(spark, tmp_path):
    docx(tmp_path / "a.docx", [("", "cat", "قط", "x"), ("dog",), (" ",)], ["ignored"])
    docx(tmp_path / "b.docx", [], ["one  two", " "])
    got = sources.read_docx(spark, str(tmp_path)).orderBy("source_file", "pos").collect()
    assert [tuple(r)[1:] for r in got] == [("cat", "قط x", "a"), ("dog", "", "a"), ("one two", "", "b")]


def test_tab_export_zip_and_lzo(spark, tmp_path):
    (tmp_path / "e.txt").write_text("cat\tقط\tx\nno tab\n")
    assert [tuple(r) for r in sources.read_tab_export(spark, str(tmp_path / "e.txt")).collect()] == [("cat", "قط\tx", "e.txt")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as archive:
        archive.writestr("in/a.txt", "hello")
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    assert [(r["member"], bytes(r["content"])) for r in sources.read_zip(spark, str(tmp_path)).collect()] == [("in/a.txt", b"hello")]
    rows = [spark.createDataFrame([(b,)], "b binary") for b in (b"hello world", b"\x89LZO....")]
    assert bytes(rows[0].select(sources.refuse_lzo(F.col("b"))).first()[0]) == b"hello world"
    with pytest.raises(Exception, match="LZO"):
        rows[1].select(sources.refuse_lzo(F.col("b"))).collect()


def test_lexicons(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿ID,English,Arabic\n1,cat,قط\n2,dog,\n")
    (tmp_path / "b.csv").write_text("x,y\nant,نملة\n")
    got = sources.read_lexicon_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    assert [tuple(r) for r in got] == [("cat", "قط"), ("dog", ""), ("ant", "نملة")]
    (tmp_path / "a.json").write_text(json.dumps({"english": ["cat"], "arabic": ["قط"]}))
    (tmp_path / "b.json").write_text(json.dumps(["dog", "كلب"]))
    assert {(r["lang"], r["word"]) for r in sources.read_lexicon_json(spark, str(tmp_path / "a.json")).collect()} == {("english", "cat"), ("arabic", "قط")}
    assert {(r["lang"], r["word"]) for r in sources.read_lexicon_json(spark, str(tmp_path / "b.json")).collect()} == {("english", "dog"), ("arabic", "كلب")}
    # A folder is all its files; those that hold nothing are left out.
    (tmp_path / "c.csv").write_text("")
    assert sorted(tuple(r) for r in sources.read_lexicon_csv(spark, [str(tmp_path)]).collect()) == sorted(tuple(r) for r in got)
    (tmp_path / "d.json").write_text(json.dumps([" Dog ", "12", "--", "abكلب", "كلب"]))
    assert {(r["lang"], r["word"]) for r in sources.read_lexicon_json(spark, str(tmp_path / "d.json")).collect()} == {("english", "dog"), ("english", "abكلب"), ("arabic", "كلب")}


def test_tables_come_back_as_written(spark, tmp_path):
    rows = spark.createDataFrame([(2, 'say "hi", now', "قط"), (1, " a\nb ", "")], "id long, English string, Arabic string")
    sinks.write_bilingual(rows, str(tmp_path / "out"), files=1)
    [part] = (tmp_path / "out").glob("part-*")
    assert part.read_bytes().decode() == '﻿id,English,Arabic\r\n1," a\nb ",\r\n2,"say ""hi"", now",قط\r\n'


def test_conversion_goes_on_after_failures(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stardict(source, "plain", [("cat", "قط")], "m", False)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.txt").write_text("nothing\n")

    def broken(spark, path):
        raise ValueError(path)

    conversion.register("broken", broken)
    catalogue = [
        conversion.Dictionary("Plain", "plain.csv", str(source), "stardict"),
        conversion.Dictionary("Gone", "gone.csv", str(tmp_path / "none"), "stardict"),
        conversion.Dictionary("Empty", "empty.csv", str(tmp_path / "empty"), "tab"),
        conversion.Dictionary("Broken", "broken.csv", str(source), "broken"),
        conversion.Dictionary("Other", "other.csv", str(source), "bgl"),
    ]
    got = conversion.convert(spark, catalogue, str(tmp_path / "out"))
    assert [(r["rows"], r["status"]) for r in got.collect()] == [(1, "OK"), (0, "MISSING"), (0, "EMPTY"), (0, "ERROR: ValueError"), (0, "UNSUPPORTED_FORMAT")]
    conversion.report(got, str(tmp_path / "report"))
    [part] = (tmp_path / "report").glob("part-*")
    assert "Total entries (OK): 1" in part.read_text()
    assert len(conversion.subset(catalogue, ["stardict"])) == 2


def test_reports_and_flags(spark, tmp_path):
    report = spark.createDataFrame([("قاموس", True)], "pdf_name string, pdf_deletable boolean")
    sinks.write_report(report, str(tmp_path / "r"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))) == {"pdf_name": "قاموس", "pdf_deletable": True}
    assert sinks.write_flag(report, str(tmp_path / "f"))
    assert not sinks.write_flag(report.withColumn("pdf_deletable", F.lit(False)), str(tmp_path / "g"))


def test_each_chunk_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "c1.csv").write_text("\ufeffid,term,definition,source_file\r\n1,cat,qitt,a\r\n2,\"a,\nb\",\"say \"\"x\"\"\",a\r\n", newline="")
    (tmp_path / "c2.csv").write_text("id,definition,term,source_file\n1,kalb,dog,b\n2,short\n")
    (tmp_path / "c3.csv").write_text("source_file,extra,more,term,definition\nc,,,ant,naml\n")
    (tmp_path / "c4.csv").write_text("term,term,definition\nno,yes,na3am,over\n")
    (tmp_path / "c5.csv").write_text("")
    rows = sources.read_chunks(spark, str(tmp_path))
    assert set(rows.columns) == {"id", "term", "definition", "source_file", "extra", "more", "file", "pos", "cells"}
    got = sorted((r["file"][-6:], r["term"], r["definition"], r["source_file"]) for r in rows.where("definition is not null and term is not null").collect())
    assert got == [("c1.csv", "a,\nb", 'say "x"', "a"), ("c1.csv", "cat", "qitt", "a"), ("c2.csv", "dog", "kalb", "b"), ("c3.csv", "ant", "naml", "c"), ("c4.csv", "yes", "na3am", None)]
    short = rows.where("definition = 'short'").first()
    assert short["term"] is None and short["source_file"] is None
    merged = merge.merge_named(rows, ["file", "pos"]).orderBy("id").collect()
    assert [tuple(r) for r in merged] == [(1, "cat", "qitt", "a"), (2, "a,\nb", 'say "x"', "a"), (3, "dog", "kalb", "b"), (4, "ant", "naml", "c"), (5, "yes", "na3am", "")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1


def test_lexicons_of_many_headers_in_one_plan(spark, tmp_path):
    for name, body in (("a", "ID,English,Arabic\n1,cat,qitt\n"), ("b", "Definition,x, TERM \nkalb,-,dog\n"), ("c", "x,y\nant,naml\n"), ("d", "x,y,z\n1,bee,nahl\n"), ("e", "only\nword\n"), ("f", "ar\nbayt\n")):
        (tmp_path / f"{name}.csv").write_text(body)
    got = lambda profile: sorted(tuple(r) for r in sources.read_lexicon_csv(spark, [str(tmp_path)], profile).collect())
    named = [("", ""), ("", "bayt"), ("bee", "nahl"), ("cat", "qitt"), ("dog", "kalb")]
    assert got("v3") == sorted([*named, ("ant", "naml")]) and got("v4") == sorted([*named, ("", "")])


def test_archives_are_packed_one_at_a_time():
    """A batch of whole archives' texts was held at once."""
    import io
    import zipfile

    import pyarrow as pa

    from glossaflow.catalog_files import _archives

    taken = []

    def batches():
        for n in range(6):
            taken.append(n)
            yield pa.RecordBatch.from_arrays([pa.array([n // 2]), pa.array([n]), pa.array([f"text {n}"])], ["block", "doc_id", "text"])

    packed = _archives(batches())
    first = next(packed)
    assert taken == [0, 1, 2] and first.column(0)[0].as_py() == "z0.zip"
    archive = zipfile.ZipFile(io.BytesIO(first.column(1)[0].as_py()))
    assert {n: archive.read(n) for n in archive.namelist()} == {"0.txt": b"text 0", "1.txt": b"text 1"}
    assert [b.column(0)[0].as_py() for b in packed] == ["z1.zip", "z2.zip"]


def test_merged_rows_travel_without_their_cells(spark):
    from glossaflow.operators import merge

    rows = spark.createDataFrame([("f", n, ["1", t, "x"]) for n, t in enumerate(("Cat", "cat", "dog"))], "file string, pos long, cells array<string>")
    keyed = merge.merge_positional(rows, ["file", "pos"])
    assert sorted(map(tuple, keyed.collect())) == [(1, "Cat", "x"), (2, "dog", "x")]
    key = rows.select(F.lit("long text " * 100).alias("e"), F.lit("b").alias("a")).select(*(k.alias(f"k{i}") for i, k in enumerate(merge.entry_keys("e", "a")))).first()
    assert [len(k) for k in key] == [64, 64]


def test_merged_texts_stay_where_they_are(spark, monkeypatch):
    """Only digests are dealt out; they were, with the texts, three times."""
    from glossaflow.operators import merge

    rows = spark.createDataFrame([(f"f{n % 3}", n, "" if n % 50 == 7 else f"T{n % 900}" if n % 2 else f"t{n % 900}", f"d{n % 900}", "s") for n in range(2500)], "file string, pos long, term string, definition string, source_file string").repartition(5)
    wanted, seen = [], set()
    for r in sorted(rows.collect(), key=lambda r: (r["file"], r["pos"])):
        if r["term"] and (key := (r["term"].lower(), r["definition"])) not in seen:
            seen.add(key)
            wanted.append((len(wanted) + 1, r["term"], r["definition"], "s"))
    merged = merge.merge_named(rows, ["file", "pos"])
    assert "Exchange hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, merged.collect())) == wanted
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 0)
    dealt = merge.merge_named(rows, ["file", "pos"])
    assert "Exchange hashpartitioning(_block" in dealt._jdf.queryExecution().executedPlan().toString() and sorted(map(tuple, dealt.collect())) == wanted
    assert merge.merge_named(rows.limit(0), ["file", "pos"]).count() == 0


def test_entries_are_written_by_many_tasks_in_order(spark, tmp_path):
    """All entries of a run have one registered name: ordered by that, they
    were one task's, and those of several files were mixed."""
    source = tmp_path / "in"
    source.mkdir()
    for stem in "cab":
        (source / f"{stem}.tab").write_text("".join(f"{stem}{n:03}\tx\n" for n in range(200)))
    (source / "note.tab").write_text("no entry\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = conversion.convert(spark, [conversion.Dictionary("Tab", "tab.csv", str(source), "tab")], str(tmp_path / "out"), files=3)
        assert [(r["rows"], r["status"]) for r in got.collect()] == [(600, "OK")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parts = [p.read_text().splitlines()[1:] for p in sorted((tmp_path / "out" / "tab.csv").glob("part-*"))]
    assert len(parts) == 3 and max(map(len, parts)) < 600
    assert sum(parts, []) == [f"{stem}{n:03},x,Tab" for stem in "abc" for n in range(200)]


def test_a_conversion_reads_its_entries_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def told(rows):
        for row in rows:
            read.add(1)
            yield row

    conversion.register("told", lambda spark, path: spark.createDataFrame(spark.sparkContext.parallelize([(f"t{n}", "d", "s", n) for n in range(40)], 4).mapPartitions(told), "term string, definition string, source_file string, pos int"))
    got = conversion.convert(spark, [conversion.Dictionary("Told", "told.csv", str(tmp_path), "told")], str(tmp_path / "out"))
    assert (got.first()["rows"], read.value) == (40, 40)
