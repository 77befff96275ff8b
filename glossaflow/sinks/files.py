"""Writers of the deliverable files.

Each part file is complete in itself: it begins with the byte order mark and
the header, and its lines end as spreadsheets expect. ``files=1`` gives one
file where the result is small enough for one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"
NOTE = "[CONVERSION NOTE]"


def _lines(rows: DataFrame, columns: Sequence[str], sep: str, by: str | None = None) -> DataFrame:
    """(by, value): lines of text, with the header before each task's first
    line and, of rows in order of ``by``, before the first of each value."""
    options = {"escape": '"', "sep": sep, "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    value = F.to_csv(F.struct(*columns), options).alias("value")
    header = BOM + sep.join(columns)
    if by:
        lines = rows.select(by, value)

        def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: list = []
            for batch in batches:
                keys, values = [], []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if last != [key]:
                        last = [key]
                        keys.append(key)
                        values.append(header)
                    keys.append(key)
                    values.append(text)
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(values, pa.string())], [by, "value"])

        return lines.mapInArrow(headed, lines.schema)
    lines = rows.select(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        yield from batches

    return lines.mapInArrow(run, "value string")


def write_table(rows: DataFrame, path: str, columns: Sequence[str], *, order: Sequence[str] = (), sep: str = ",", files: int | None = None, mode: str = "overwrite", by: str | None = None, placed: bool = False) -> None:
    """Columns as CSV or TSV with byte order mark, header and CR LF; with
    ``by`` in a folder for each of its values (``by`` leads the order).
    ``placed`` rows are only put in order where they are: ranges are drawn from
    a sample, for which all that comes before is run once more."""
    if by:
        order = [by, *(c for c in order if c != by)]
    if order and placed:
        rows = rows.sortWithinPartitions(*order)
    elif order:
        rows = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
        rows = rows.sortWithinPartitions(*order)
    elif files:
        rows = rows.coalesce(files)
    writer = _lines(rows, columns, sep, by).write.mode(mode)
    (writer.partitionBy(by) if by else writer).text(path, lineSep="\r\n")


def write_entries(rows: DataFrame, path: str, source_name: str, *, order: Sequence[str] = (), **options) -> None:
    """term, definition and the registered name, whatever the rows' own was;
    ``order`` is by their own: the registered one is the same for all."""
    own = {"source_file": "_own_file"}
    rows = rows.withColumnsRenamed(own).withColumn("source_file", F.lit(source_name))
    write_table(rows, path, ["term", "definition", "source_file"], order=[own.get(c, c) for c in order], **options)


def write_note(spark, path: str, source_name: str, note: str) -> None:
    rows = spark.createDataFrame([(NOTE, note, source_name)], "term string, definition string, source_file string")
    write_table(rows, path, ["term", "definition", "source_file"], files=1)


def write_numbered(rows: DataFrame, path: str, **options) -> None:
    write_table(rows, path, ["id", "term", "definition", "source_file"], order=["id"], **options)


def write_bilingual(rows: DataFrame, path: str, **options) -> None:
    write_table(rows, path, ["id", "English", "Arabic"], order=["id"], **options)


def write_lines(rows: DataFrame, path: str, order: Sequence[str] = (), **options) -> None:
    write_table(rows, path, ["Type", "Section", "Subsection", "Content"], sep="\t", order=order, **options)


def write_report(report: DataFrame, path: str) -> None:
    """One JSON object a line; non-ASCII letters as they are. The path is the
    caller's own, never made from the data's by replacing a suffix."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("overwrite").text(path)


def write_flag(report: DataFrame, path: str, name: str = "pdf_deletable") -> bool:
    """A note of verification where the report's gate is passed."""
    passed = report.where(name)
    facts = [F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in report.columns]
    when = F.concat(F.lit("Date: "), F.current_timestamp().cast("string"))
    lines = passed.select(F.explode(F.array(F.lit("Verification: PASSED"), *facts, when)).alias("value"))
    if passed.isEmpty():
        return False
    lines.coalesce(1).write.mode("overwrite").text(path)
    return True


def write_files(files: DataFrame, folder: str) -> None:
    """Rows (name, content) as files of a folder, in any store that Arrow's
    file systems open. A file is written beside its place and moved there, so a
    task that is run again writes the same file once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from glossaflow.sources.datasources import file_system

        system, place = file_system(folder)
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                system.create_dir(place)
                draft = f"{place}/.{name.as_py()}-{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(content.as_buffer())
                system.move(draft, f"{place}/{name.as_py()}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    files.select("name", "content").mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


def write_conversion_report(lines: DataFrame, path: str) -> None:
    lines.repartitionByRange(1, "section", "name").sortWithinPartitions("section", "name").select(F.col("line").alias("value")).write.mode("overwrite").text(path)
