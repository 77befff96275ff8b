"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; the
last returns their token ids. A stage's output is written before the next one
reads it, so a lost executor costs a part of one stage; what a stage wrote for
itself is deleted then.

Cases: null and empty texts stay until mixing, which keeps no document without
tokens; very long texts are read whole in every stage; rows with a null id are
judged as others are, but are no near copies; rows that repeat an id are judged
each by its own text, and of rows equal in id and text one stays; of near
copies the smallest id stays; all columns of the documents, of any name, are
kept up to the last stage; an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.llm import bpe, lines, mixing, neardup, quality
from glossaflow.llm.common import read, scratch, shared_dir


#: Similarity in per cent of near copies; what is below loses shared passages.
COPIES = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one that held nothing else goes."""
    out = lines.dedup_lines(docs, copies=COPIES)
    left = out.where((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, from 0.8 on."""
    return neardup.keep_one(docs, percent=COPIES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents at the target weights."""
    return mixing.sample(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document."""
    return bpe.round_trip(docs).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Byte-pair merges and MinHash links have no SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/glossaflow/stage-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
