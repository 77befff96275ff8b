"""Resumable ingestion of page texts as a stream of files.

New files are taken a few at a time; the checkpoint remembers which were done,
so a run that is stopped goes on where it was, and the file sink writes each
page once. The open chapter and section of a document are kept as state, so
they live over batches and restarts; so are pages that came before their turn.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from glossaflow.functions import text as tx

PAGES = "pdf bigint, page int, text string"
FILES_PER_BATCH = 5
#: Documents of neighbouring numbers whose state is one: a group costs a few
#: milliseconds, whatever it holds. No shelf has more documents than this.
SHELF = 64
#: By document: its section and subsection, the next page, and pages that wait.
STATE = "documents string"
OUT = "pdf bigint, page int, line_no int, Type string, Section string, Subsection string, Content string"
#: Runs that were stopped before their end.
_STOPPED: set[str] = set()


class Paused(TimeoutError):
    """A run that was stopped before its end: what is written is a part. The
    next run goes on from there."""

    def __init__(self, query: StreamingQuery, seconds: float):
        super().__init__(f"pages are left after {seconds} seconds")
        self.query = query


def page_stream(spark: SparkSession, path: str, schema: str = PAGES, files: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _carry(first: int | None):
    """Section and Subsection of new lines of one shelf's documents, each in
    page order.

    With ``first`` pages are numbered from there on, and a page waits in the
    state until all before it have come, in whatever batch; one that comes
    again is passed over. Without it the pages of a batch are taken as they are.
    """

    def document(pdf: int, pages: dict[int, list], known: list, out: list) -> list:
        section, subsection, at, waiting = known
        held = {int(page): lines for page, lines in waiting.items()}
        held |= {page: sorted(lines) for page, lines in pages.items() if first is None or page >= at}
        for page in sorted(held):
            if first is not None and page != at:
                break
            at = page + 1
            for line_no, kind, text in held.pop(page):
                if line_no < 0:
                    continue
                if kind == "chapter":
                    section, subsection = text, ""
                elif kind == "section":
                    subsection = text
                out.append((pdf, page, line_no, kind, section, subsection, text))
        return [section, subsection, at, held]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else {}
        came: dict[int, dict[int, list]] = {}
        for batch in batches:
            for pdf, page, line_no, kind, text in zip(*(batch[c].tolist() for c in ("pdf", "page", "line_no", "Type", "text")), strict=True):
                came.setdefault(pdf, {}).setdefault(page, []).append((line_no, kind, text))
        out: list[tuple] = []
        for pdf, pages in came.items():
            known[str(pdf)] = document(pdf, pages, known.get(str(pdf), ["", "", first or 0, {}]), out)
        state.update((json.dumps(known, ensure_ascii=False),))
        yield pd.DataFrame(out, columns=["pdf", "page", "line_no", "Type", "Section", "Subsection", "Content"])

    return run


def structured_stream(pages: DataFrame, first: int | None = None, **kinds) -> DataFrame:
    """Structured lines of a stream of pages (pdf, page, text); with ``first``
    in the order of pages over all batches."""
    # A page is told by a line before its first, so that blank ones count.
    marked = F.concat(F.array(F.lit("")), F.split(F.coalesce("text", F.lit("")), "\n"))
    lines = pages.select("pdf", "page", F.posexplode(marked).alias("line_no", "text")).withColumns({"line_no": F.col("line_no") - 1, "text": tx.strip(F.col("text"))})
    lines = lines.where("line_no < 0 or text <> ''").withColumn("Type", tx.content_type(F.col("text"), **kinds))
    return lines.withColumn("shelf", F.floor(F.col("pdf") / SHELF)).groupBy("shelf").applyInPandasWithState(_carry(first), OUT, STATE, "append", "NoTimeout")


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, *, files: int = FILES_PER_BATCH, seconds: float | None = None, first: int | None = None, **kinds) -> StreamingQuery:
    """Structure what is there and not yet done, to its end.

    A run that fails raises its error. With ``seconds`` one that takes longer is
    stopped and raises :class:`Paused`, so no part passes for the whole.
    """
    query = (
        structured_stream(page_stream(spark, source, files=files), first, **kinds)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        _STOPPED.add(str(query.runId))
        query.stop()
        raise Paused(query, seconds)
    return query


def progress(spark: SparkSession, query: StreamingQuery, out: str) -> dict:
    """How far the deliverable is, and whether the stream still runs.

    Counted in what is written, not in the query's own reports: these cover its
    last hundred batches, and no earlier run.
    """
    found = spark.read.schema(OUT).parquet(out).agg(F.coalesce(F.max("page") + 1, F.lit(0)).alias("last_page"), F.count("*").alias("total_lines")).first()
    status = "in_progress" if query.isActive else "paused" if query.exception() or str(query.runId) in _STOPPED else "completed"
    return {"last_page": found["last_page"], "total_lines": found["total_lines"], "status": status}


def write_progress(spark: SparkSession, query: StreamingQuery, out: str, path: str) -> dict:
    """Progress as one JSON object in ``path``."""
    found = progress(spark, query, out)
    spark.createDataFrame([(json.dumps(found, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return found
