"""The registered queries of this subpackage: thin, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.llm import alignment, audio, bpe, lines, mining, mixing, neardup, quality, token_counts, toxicity, urls, vptree, warc
from glossaflow.llm.common import read, shared_dir


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op6_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = audio.store(audio.of_texts(read(spark, sf_dir, "documents")))
    return audio.features(stored).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature",
        F.length("tensor").cast("long").alias("tensor_bytes"), F.size("segments").alias("n_segments"),
    )


def op7_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mining.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"), f"{shared_dir(spark)}/glossaflow/warc-{uuid.uuid4().hex}")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_audio": op6_audio,
    "op7_vptree": op7_vptree,
    "op8_neardup": op8_neardup,
    "op9_urls": op9_urls,
    "op10_mixing": op10_mixing,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_warc": op13_warc,
}
