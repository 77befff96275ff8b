"""Quality and conversion reports as aggregates.

Ratios are 0 for empty inputs; gates compare unrounded ratios.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaflow.functions import text as tx

#: (ratio, rows) that a conversion must exceed for its source to be deletable.
GATES = {"v3": (0.7, 100), "v4": (0.5, 50), "medical": (0.5, 50)}
STATUSES = ("OK", "EMPTY", "MISSING", "ERROR", "UNSUPPORTED_FORMAT")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def entry_report(entries: DataFrame, by: Sequence[str] = (), english: str = "English", arabic: str = "Arabic", profile: str = "v3") -> DataFrame:
    """Coverage, lengths and the deletion gate of entries, for each ``by``."""
    e, a = F.coalesce(english, F.lit("")), F.coalesce(arabic, F.lit(""))
    counted = entries.groupBy(*by).agg(
        F.count("*").alias("total_entries"),
        F.count_if(e != "").alias("entries_with_english"),
        F.count_if(a != "").alias("entries_with_arabic"),
        F.count_if((e != "") & (a != "")).alias("entries_with_both"),
        F.coalesce(F.bround(F.avg(F.length(e)), 1), F.lit(0.0)).alias("avg_english_len"),
        F.coalesce(F.bround(F.avg(F.length(a)), 1), F.lit(0.0)).alias("avg_arabic_len"),
    )
    ratio, rows = GATES[profile]
    accuracy = _share(F.col("entries_with_both"), F.col("total_entries"))
    return counted.withColumns({"estimated_accuracy": F.bround(accuracy, 3), "pdf_deletable": (accuracy > ratio) & (F.col("total_entries") > rows)})


def line_report(lines: DataFrame, by: Sequence[str] = (), letters: str = tx.ARABIC) -> DataFrame:
    """Lines, chapters, sections and the share of Arabic content lines."""
    content = F.col("Type") == "content"
    counted = lines.groupBy(*by).agg(
        F.count("*").alias("total_lines"),
        F.count_if(F.col("Type") == "chapter").alias("chapters"),
        F.count_if(F.col("Type") == "section").alias("sections"),
        F.count_if(content).alias("content_lines"),
        F.count_if(content & F.col("Content").rlike(letters)).alias("arabic_lines"),
    )
    share = _share(F.col("arabic_lines"), F.col("content_lines"))
    ratio, rows = GATES["medical"]
    return counted.withColumns({"arabic_content_ratio": F.bround(share, 3), "pdf_deletable": (share > ratio) & (F.col("total_lines") > rows)})


def status_of(rows: Column, *, exists: Column, supported: Column, error: Column) -> Column:
    """OK, EMPTY, MISSING, ``ERROR: kind`` or UNSUPPORTED_FORMAT."""
    return (
        F.when(~supported, "UNSUPPORTED_FORMAT")
        .when(~exists, "MISSING")
        .when(error.isNotNull(), F.concat(F.lit("ERROR: "), error))
        .when(F.coalesce(rows, F.lit(0)) == 0, "EMPTY")
        .otherwise("OK")
    )


def status_report(statuses: DataFrame) -> DataFrame:
    """(status, dictionaries, rows) by status, errors of all kinds together."""
    kind = F.when(F.col("status").startswith("ERROR"), "ERROR").otherwise(F.col("status"))
    return statuses.groupBy(kind.alias("status")).agg(F.count("*").alias("dictionaries"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))


def format_rollup(statuses: DataFrame, by: str = "format") -> DataFrame:
    """(format, dictionaries, rows) and a row ``TOTAL``."""
    rolled = statuses.rollup(by).agg(F.count("*").alias("dictionaries"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"), F.grouping(by).alias("_all"))
    return rolled.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(by)).alias(by), "dictionaries", "rows")


def report_lines(statuses: DataFrame) -> DataFrame:
    """(section, name, line): the conversion report, to be written in order."""
    ok = F.col("status") == "OK"
    row = F.concat(tx.pad_right(F.col("name"), 50, 48), F.lpad(F.col("rows").cast("string"), 8, " "), F.lit("  "), F.col("status"))
    body = statuses.select(F.lit(1).alias("section"), "name", row.alias("line"))
    sums = statuses.agg(F.count("*").alias("n"), F.count_if(ok).alias("good"), F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("rows"))
    totals = (F.concat(F.lit("Total dictionaries: "), F.col("n").cast("string")), F.concat(F.lit("OK: "), F.col("good").cast("string")), F.concat(F.lit("Total entries (OK): "), F.format_number("rows", 0)))
    tail = sums.select(F.inline(F.array(*(F.struct(F.lit(2).alias("section"), F.lit(str(i)).alias("name"), text.alias("line")) for i, text in enumerate(totals)))))
    return body.unionByName(tail)


def engine_scores(outputs: DataFrame, by: Sequence[str], text: str = "text", confidence: str = "confidence", failed: str | None = None) -> DataFrame:
    """(by, score): mean confidence times length times the share of letters
    and spaces; a tenth of it for failed runs."""
    body = tx.strip(F.coalesce(text, F.lit("")))
    valid = F.length(F.regexp_replace(body, r"(?U)[^\p{IsAlphabetic}\s\u0600-ۿ]", ""))
    score = F.coalesce(F.col(confidence), F.lit(0.0)) * F.length(body) * valid / F.greatest(F.length(body), F.lit(1))
    if failed:
        score = F.when(F.col(failed), score * 0.1).otherwise(score)
    return outputs.select(*by, score.alias("score"))


def best_engine(scores: DataFrame, by: Sequence[str], engine: str = "engine") -> DataFrame:
    """(by, engine, score): the best of each group, ties to the smaller name."""
    top = scores.groupBy(*by).agg(F.min(F.struct((-F.col("score")).alias("s"), engine)).alias("t"))
    return top.select(*by, F.col(f"t.{engine}").alias(engine), (-F.col("t.s")).alias("score"))


def observed(rows: DataFrame, name: str, counters: Mapping[str, Column]) -> DataFrame:
    """``rows`` with running counters, read from the observation ``name``."""
    return rows.observe(name, *(F.count_if(c).alias(k) for k, c in counters.items()))
