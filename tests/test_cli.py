"""The command line on small inputs."""

from glossaflow import schemas
from glossaflow.plans import cli


def read(folder):
    return "".join(p.read_bytes().decode().replace("\ufeff", "") for p in sorted(folder.rglob("part-*")))


def test_dictionary_book_and_merge(spark, tmp_path):
    boxes = [(1, 0, i, t, x, y, 10, 10, 90, 1000) for i, (t, x, y) in enumerate([("1", 0, 0), ("cat", 20, 0), ("قط", 400, 0)])]
    spark.createDataFrame(boxes, schemas.WORD_BOX).write.parquet(str(tmp_path / "boxes"))
    cli.run(spark, ["dictionary", str(tmp_path / "boxes"), str(tmp_path / "dict"), "--profile", "v2"])
    assert "1,cat,قط\r\n" in read(tmp_path / "dict")
    assert '"total_entries":1' in read(tmp_path / "dict_report")
    spark.createDataFrame([(1, 1, "الفصل أ\nx")], schemas.PAGE_TEXT).write.parquet(str(tmp_path / "pages"))
    cli.run(spark, ["book", str(tmp_path / "pages"), str(tmp_path / "book")])
    assert "content\tالفصل أ\t\tx\r\n" in read(tmp_path / "book")
    chunks = tmp_path / "chunks"
    chunks.mkdir()
    (chunks / "chunk1.csv").write_text("term,definition,source_file\nCat,قط,a\n")
    (chunks / "chunk2.csv").write_text("term,definition,source_file\ncat,قط,b\ndog,كلب,c\n")
    cli.run(spark, ["merge", "named", str(chunks), str(tmp_path / "merged")])
    assert "1,Cat,قط,a\r\n" in read(tmp_path / "merged") and "2,dog,كلب,c\r\n" in read(tmp_path / "merged")
    # A row that lacks cells is skipped, one with empty cells is not.
    short = tmp_path / "short"
    short.mkdir()
    (short / "chunk1.csv").write_text("id,English,Arabic\n1,Cat,قط\n2,short\n3,,كلب\n4,dog,\n")
    cli.run(spark, ["merge", "positional", str(short), str(tmp_path / "positional")])
    assert sorted(read(tmp_path / "positional").split("\r\n")) == sorted(["id,English,Arabic", "1,Cat,قط", "2,,كلب", "3,dog,", ""] + ["id,English,Arabic"] * (read(tmp_path / "positional").count("id,English") - 1))


def test_dual_pass_and_source_name(spark, tmp_path):
    boxes = [(1, 0, i, t, x, y, 10, 10, 90, 1000, scan) for i, (t, x, y, scan) in enumerate([("cat", 20, 0, 1), ("قط", 400, 0, 2), ("قص", 25, 0, 2), ("1", 0, 0, 3)])]
    spark.createDataFrame(boxes, "pdf long, page int, pos int, text string, x int, y int, w int, h int, conf int, width int, scan int").write.parquet(str(tmp_path / "boxes"))
    cli.run(spark, ["dictionary", str(tmp_path / "boxes"), str(tmp_path / "dict"), "--dual-pass", "--src-name", "Book"])
    assert "1,cat,قط\r\n" in read(tmp_path / "dict")
    assert '"pdf_name":"Book"' in read(tmp_path / "dict_report")


def test_each_pdf_has_its_folder(spark, tmp_path):
    pages = [(pdf, page, f"line {pdf} {page}") for pdf in (1, 2) for page in range(3)]
    spark.createDataFrame(pages, schemas.PAGE_TEXT).repartition(3).write.parquet(str(tmp_path / "pages"))
    cli.run(spark, ["book", str(tmp_path / "pages"), str(tmp_path / "book")])
    for pdf in (1, 2):
        text = read(tmp_path / "book" / f"pdf={pdf}")
        assert [x for x in text.split("\r\n") if x.startswith("content")] == [f"content\t\t\tline {pdf} {page}" for page in range(3)]
        assert text.startswith("Type\tSection\tSubsection\tContent\r\n")


def test_small_pdfs_share_files(spark, sf_dir, tmp_path, monkeypatch):
    """The run's dictionary is whole, in order, and not in a folder for each
    PDF; rows are not dealt anew for it."""
    from glossaflow import catalog_runs

    monkeypatch.setattr(catalog_runs, "_folder", lambda spark, name: str(tmp_path / name))
    counts = catalog_runs.run_counters(spark, sf_dir).first()
    assert not list((tmp_path / "bilingual").glob("pdf=*"))
    lines = [p.read_bytes().decode().split("\r\n") for p in (tmp_path / "bilingual").glob("part-*")]
    parts = [[tuple(map(int, line.split(",")[:2])) for line in part if line[:1].isdigit()] for part in lines]
    assert all(part == sorted(part) for part in parts)
    assert 0 < sum(map(len, parts)) == len(set().union(*parts)) <= counts["valid_entries"]
