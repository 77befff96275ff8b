"""Quality by hierarchical empirical Bayes over hosts and paths.

A classifier on the form of a text gives each document evidence. Grouped sums
of that evidence give each host a posterior share of good documents, shrunk
toward the global share, and each path one shrunk toward its host's. How strong
the shrinkage is follows from the spread between groups (moments of the
beta-binomial), so sparse sites rest on their priors and large ones on their
own record. A document's posterior odds are the classifier's odds with the
training prior replaced by its path's posterior.

The groups are summed map-side first; a host with a third of all rows is one
row of each map task. Their table is broadcast where its counted number allows
it, else joined by a shuffle of ids and scores. The classifier is fitted on a
bounded sample of labelled rows (``labelled.SAMPLE_ROWS``).

Host and path come from a URL column where there is one (:func:`site_of`), else
from two columns that the caller names.

Cases: null texts count as empty, and so does a null host or path, the value
``""``; very long texts are read whole; without labels of both kinds the
classifier says 0.5 for all and everything is kept. Each row is judged by its
own text and site, so rows that repeat an id may be judged apart, equal rows
are judged alike, and each counts in its site's sums; a score equal to the
threshold is kept. An empty table gives an empty result. Extra columns of any
name are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import checked_broadcast, lean, materialize, without_rows
from glossaflow.llm.labelled import fit_dense, labelled_sample, sigmoid

THRESHOLD = 0.35
_SYMBOL = re.compile(r"[#$%&*@^~<>{}\[\]\\/+=_|]")
_MARK = re.compile(r"[!?]{2,}")
_DIGIT = re.compile(r"[0-9]")


def form(text: str) -> list[float]:
    """Features of a whole text's form, each about 0 to 1."""
    words = text.split()
    n, chars = len(words), max(len(text), 1)
    if not n:
        return [0.0] * 8 + [1.0]
    letters = sum(map(len, words))
    return [
        sum(map(str.isupper, words)) / n,
        len(_SYMBOL.findall(text)) / letters * 4,
        len(_MARK.findall(text)) / n,
        text.count("|") / n,
        len(set(words)) / n if n >= 20 else 0.7,
        len(_DIGIT.findall(text)) / letters,
        letters / n / 10,
        np.log1p(chars) / 12,
        0.0,
    ]


def site_of(url: Column) -> tuple[Column, Column]:
    """(host, first part of the path) of a URL, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*(/[^/?#]*)", 1)


def evidence(docs: DataFrame, weights: list[float] | None, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """(id, text_hash, host, path, evidence): the classifier's probability of
    quality of each row."""
    w = np.array(weights) if weights is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if w is None or not batch.num_rows:
                p = np.full(batch.num_rows, 0.5)
            else:
                x = np.array([form(t.as_py() or "") for t in batch.column(4)])
                p = np.clip(sigmoid(x @ w[:-1] + w[-1]), 1e-4, 1 - 1e-4)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(p, pa.float64())], ["id", "text_hash", "host", "path", "evidence"])

    cut = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((host_col, "host"), (path_col, "path"))), text_col)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("evidence", T.DoubleType())])
    return cut.mapInArrow(lean(run), schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", only: Column | None = None) -> tuple[list[float] | None, float]:
    """(weights, share of good labels) from a bounded labelled sample."""
    sample = labelled_sample(docs, labels, label_col, id_col=id_col, text_col=text_col, only=only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [form(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    found = sample.select("text", "label").mapInArrow(lean(run), "x array<double>, label int").toPandas()
    y = found["label"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None, 0.5
    return fit_dense(np.array(found["x"].tolist()), y, ridge=0.1).tolist(), float(y.mean())


def _strength(groups: DataFrame, prior: Column) -> float:
    """How many documents the prior counts for: beta-binomial moments."""
    n, s = F.col("n").cast("double"), F.col("s")
    row = groups.agg(
        F.sum(n), F.sum(n * n), F.count("*"), F.sum(n * (s / n - prior) ** 2), F.sum(n * prior * (1 - prior)), F.sum(prior * (1 - prior))
    ).first()
    total, squares, k, between, inside, noise = (float(x or 0) for x in row)
    if k < 2 or not inside:
        return 1e6
    spread = (between - noise) / max(total - squares / total, 1e-9)
    return float(np.clip(inside / total / max(spread, 1e-9) - 1, 1.0, 1e6))


def sites(each: DataFrame) -> DataFrame:
    """(host, path, posterior, global): each path's posterior share of good."""
    paths = materialize(each.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")), "paths")
    total = paths.agg(F.sum("n"), F.sum("s")).first()
    share = (total[1] / total[0]) if total[0] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k = _strength(hosts, F.lit(share))
    hosts = hosts.select("host", ((F.col("s") + k * share) / (F.col("n") + k)).alias("host_posterior"))
    both = paths.join(hosts, "host")
    k = _strength(both, F.col("host_posterior"))
    return both.select("host", "path", ((F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)).alias("posterior"))


def _logit(p: Column) -> Column:
    return F.log(p) - F.log1p(-p)


def _bounded(p: Column) -> Column:
    return F.greatest(F.lit(0.001), F.least(F.lit(0.999), p))


def judged(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", url_col: str | None = None, threshold: float = THRESHOLD, only: Column | None = None) -> DataFrame:
    """(id, text_hash, evidence, site, score, kept) of each row."""
    if url_col:
        host, path = site_of(F.col(url_col))
        host_col, path_col = (next(n for k in range(len(docs.columns) + 1) if (n := f"{name}{k}") not in docs.columns) for name in ("host", "path"))
        docs = docs.withColumns({host_col: host, path_col: path})
    weights, prior = fit(docs, labels, id_col, text_col, only=only)
    each = evidence(docs, weights, id_col, text_col, host_col, path_col)
    each = materialize(each, "evidence")
    known = materialize(sites(each), "sites")
    placed = each.join(checked_broadcast(known), ["host", "path"])
    odds = _logit(F.col("evidence")) - _logit(F.lit(min(max(prior, 0.001), 0.999))) + _logit(_bounded(F.col("posterior")))
    score = 1 / (1 + F.exp(-odds))
    return placed.select("id", "text_hash", "evidence", F.col("posterior").alias("site"), score.alias("score"), (score >= threshold).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", **settings) -> DataFrame:
    """(id, evidence, site, score, kept): ``site`` is the path's posterior."""
    return judged(docs, labels, id_col=id_col, **settings).select(F.col("id").alias(id_col), "evidence", "site", "score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rejected ones, all columns as they were."""
    gone = judged(docs, labels, **settings).where(~F.col("kept")).select("id", "text_hash").distinct()
    return without_rows(docs, materialize(gone, "rejected"), settings.get("id_col", "doc_id"), settings.get("text_col", "text"))
