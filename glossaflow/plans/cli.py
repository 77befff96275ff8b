"""Command line: ``spark-submit -m glossaflow.plans.cli COMMAND ...``.

``dictionary`` turns word boxes into a bilingual dictionary, ``book`` page
texts into structured lines, ``merge`` puts chunk files together. Input
relations are Parquet with the columns of ``glossaflow.schemas``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.operators import layout, lexicon, merge, quality
from glossaflow.plans import dictionary, reference_book
from glossaflow.shared import materialize, scratch
from glossaflow.sinks import files as sinks
from glossaflow.sources import files as sources


def parser() -> argparse.ArgumentParser:
    # Names and defaults of the flags.
    top = argparse.ArgumentParser(prog="glossaflow")
    commands = top.add_subparsers(dest="command", required=True)
    one = commands.add_parser("dictionary")
    one.add_argument("--profile", choices=["v2", "v3", "v4"], default="v3")
    one.add_argument("--gutter-ratio", type=float, default=0.5)
    one.add_argument("--row-tol", type=int, default=12)
    one.add_argument("--min-conf", type=int, default=30)
    one.add_argument("--arabic-english", action="store_true")
    one.add_argument("--no-entry-numbers", action="store_true")
    one.add_argument("--dual-pass", action="store_true")
    one.add_argument("--src-name")
    one.add_argument("--layouts")
    two = commands.add_parser("book")
    two.add_argument("--incremental", action="store_true")
    for command in (one, two):
        command.add_argument("input")
        command.add_argument("output")
        command.add_argument("--start", type=int, default=0)
        command.add_argument("--end", type=int)
        command.add_argument("--chunk-size", type=int, default=0)
        command.add_argument("--chunk", type=int, default=-1)
        command.add_argument("--spell-dict")
        command.add_argument("--spell-csvs", "--spell-csv", nargs="*", default=[])
    three = commands.add_parser("merge")
    three.add_argument("mode", choices=["named", "positional", "lines"])
    three.add_argument("input")
    three.add_argument("output")
    return top


def _words(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    frames = [sources.read_lexicon_json(spark, args.spell_dict)] if args.spell_dict else []
    if args.spell_csvs:
        frames.append(lexicon.lexicon_of(sources.read_lexicon_csv(spark, args.spell_csvs)))
    return lexicon.union_lexicons(frames) if frames else None


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    """Run one command. Dictionaries and books are written in a folder for
    each PDF; the result is computed once for the table and its reports."""
    with scratch(spark):
        _run(spark, parser().parse_args(argv))


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "merge":
        rows = sources.read_chunks(spark, args.input, "\t" if args.mode == "lines" else ",")
        if args.mode == "named":
            sinks.write_numbered(merge.merge_named(rows, ["file", "pos"]), args.output)
        elif args.mode == "positional":
            sinks.write_bilingual(merge.merge_positional(rows, ["file", "pos"]), args.output)
        else:
            sinks.write_lines(rows, args.output, order=["file", "pos"])
        return
    pages, words = spark.read.parquet(args.input), _words(spark, args)
    if args.command == "dictionary":
        options = dictionary.Options(
            args.profile, args.start, args.end, args.gutter_ratio, args.row_tol, args.min_conf, args.arabic_english,
            not args.no_entry_numbers, args.chunk_size, args.chunk, words is not None,
        )
        if args.dual_pass:
            # Boxes of three scans: 1 Latin, 2 Arabic, 3 both scripts.
            pages = layout.dual_pass(*(pages.where(F.col("scan") == n).drop("scan") for n in (1, 2, 3))).drop("scan")
        layouts = layout.layout_vote(spark.read.parquet(args.layouts)) if args.layouts else None
        counters = dictionary.Counters()
        found = materialize(dictionary.dictionary(pages, options, words, layouts=layouts, counters=counters), "result")
        sinks.write_report(spark.createDataFrame([tuple(counters.read().values())], ", ".join(f"{k} bigint" for k in counters.read())), f"{args.output}_counters")
        sinks.write_bilingual(found, args.output, by="pdf")
        report = quality.entry_report(found, ["pdf"], profile="v4" if args.profile == "v4" else "v3")
        if args.src_name:
            report = report.withColumn("pdf_name", F.lit(args.src_name))
    else:
        kept = layout.page_range(pages, args.start, args.end, chunk_size=args.chunk_size, chunk=args.chunk)
        texts = reference_book.page_texts(kept, incremental=args.incremental) if "text_ara" in pages.columns else kept
        found = materialize(reference_book.structured_lines(texts, incremental=args.incremental, lexicon_words=words), "result")
        sinks.write_lines(found, args.output, order=["pdf", "page", "line_no"], by="pdf")
        report = quality.line_report(found, ["pdf"])
    sinks.write_report(report, f"{args.output}_report")
    sinks.write_flag(report, f"{args.output}_verified")


if __name__ == "__main__":
    import sys

    run(SparkSession.builder.appName("glossaflow").getOrCreate(), sys.argv[1:])
