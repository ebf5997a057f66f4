"""A bounded sample of labelled documents, and the calibration that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.base import in_fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc, text, label) of at most ``bound`` labels of the learning folds, chosen by the hash of doc_id.

    The chosen ids are few by their limit, so they are broadcast; texts stay where they are.
    """
    chosen = labels.where(in_fold(F.col("doc_id")) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = chosen.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("string").alias("doc"), "text", "label")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (len(w) - 1) + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
