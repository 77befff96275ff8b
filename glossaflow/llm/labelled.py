"""A bounded sample of labelled documents, and a small logistic solver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import materialize

#: Labelled rows that a model is fitted on, at most: those of smallest id hash.
SAMPLE_ROWS = 12_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str = "doc_id", text_col: str = "text", only: Column | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, text, label): up to ``rows`` labelled documents, texts distinct.

    ``only`` limits the labels used, as a condition on the id. The choice
    follows a hash of the id, so it is the same in every run; of equal texts
    the smallest id and the largest label count, as they do for equal ids.
    """
    given = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    given = given.where(only) if only is not None else given
    chosen = given.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "id")  # at most ``rows`` ids
    return materialize(joined.groupBy("text").agg(F.min("id").alias("id"), F.max("label").alias("label")).select("id", "text", "label"), "sample")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_dense(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w
