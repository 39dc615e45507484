"""The bounded sample of labelled documents that classifiers are fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import fold, utf8, written


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, y, body) of at most ``most`` labelled documents outside the held-out fold, the ones with the smallest id hashes;
    written once, since fitting reads it several times.

    A label that is neither 0 nor 1, and a NULL id, is no label; of repeated ids the largest label and the smallest text count.
    """
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold("id", parts) != held_out))
    known = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), utf8(text_col).alias("body"))
    return written(texts.join(known, "id").groupBy("id").agg(F.first("y").alias("y"), F.min("body").alias("body")), "labelled")


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by full-gradient steps; the last column of ``x`` is all ones."""
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    for i in range(1, rounds + 1):
        err = (sigmoid(x @ w.astype(x.dtype)) - y).astype(x.dtype)
        g = x.T @ err / max(1, len(y)) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
