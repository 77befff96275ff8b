"""Conversion of a catalogue of dictionaries, each by its own reader."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.functions import text as tx
from glossaflow.operators import quality
from glossaflow.shared import materialize, scratch
from glossaflow.sinks import files as sinks
from glossaflow.sources import datasources
from glossaflow.sources import files as sources

READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mdx": lambda spark, path: datasources.read_entries(spark, "mdx", path),
    "stardict": sources.read_stardict,
    "dicthtml": sources.read_dicthtml,
    "docx": sources.read_docx,
    "tab": lambda spark, path: sources.read_tab_export(spark, path, placed=True),
}
#: Formats that are listed and noted, not read.
UNSUPPORTED = {"bgl": "export as tab-separated text first", "ld2": "export as tab-separated text first"}


@dataclass(frozen=True)
class Dictionary:
    name: str
    csv_name: str
    path: str
    format: str


def register(format: str, reader: Callable[[SparkSession, str], DataFrame]) -> None:
    READERS[format] = reader


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) matches anything in its own file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def subset(catalogue: Sequence[Dictionary], formats: Sequence[str]) -> list[Dictionary]:
    return [d for d in catalogue if d.format in formats]


def convert(spark: SparkSession, catalogue: Sequence[Dictionary], out: str, *, files: int | None = None, forms: bool = False) -> DataFrame:
    """Convert every dictionary; (name, csv_name, format, rows, status).

    A dictionary that fails is reported and does not stop the others. With
    ``forms`` both sides lose direction marks, nameless glyphs and letter shapes.
    """
    rows = []
    for item in catalogue:
        n, status = 0, "OK"
        target = f"{out}/{item.csv_name}"
        if item.format in UNSUPPORTED or item.format not in READERS:
            status = "UNSUPPORTED_FORMAT"
            sinks.write_note(spark, target, item.name, UNSUPPORTED.get(item.format, "no reader for this format"))
        elif not exists(spark, item.path):
            status = "MISSING"
        else:
            try:
                found = READERS[item.format](spark, item.path)
                if forms:
                    found = found.withColumns({c: tx.normalize_forms(F.col(c)) for c in ("term", "definition")})
                order = [c for c in ("source_file", "block", "pos") if c in found.columns]
                with scratch(spark):
                    # Parsed once: entries are counted, and the order's bounds sampled.
                    held = materialize(found, "entries")
                    if n := held.count():
                        sinks.write_entries(held, target, item.name, order=order, files=files)
                    else:
                        status = "EMPTY"
            except Exception as error:  # any reader's failure is a status here
                n, status = 0, f"ERROR: {type(error).__name__}"
        rows.append((item.name, item.csv_name, item.format, n, status))
    return spark.createDataFrame(rows, "name string, csv_name string, format string, rows bigint, status string")


def report(statuses: DataFrame, path: str) -> None:
    sinks.write_conversion_report(quality.report_lines(statuses), path)
