"""What the trained operators share: the labelled sample, the logistic
calibration and the loss of rank (AUC)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import fold_of


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """At most ``most`` labelled rows (doc_id, y, text) outside the held-out fold,
    the first in the order of a hash of the id; texts are whole.  The ids are a
    table of at most ``most`` rows, so it is broadcast.  Of several rows of one
    doc_id the least text counts, so repeated rows do not add to the sample; an id
    without a document adds nothing."""
    ids = (labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights (the last one the intercept) of a ridge logistic regression, by
    Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    # Platt's targets keep a separable sample finite
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0))
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - t) + ridge * np.r_[w[:-1], 0]
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def auc(score, y) -> float:
    """Area under the ROC curve (for tests and reports)."""
    rank = pd.Series(score).rank().to_numpy()
    y = np.asarray(y) == 1
    pos, neg = y.sum(), (~y).sum()
    return float((rank[y].sum() - pos * (pos + 1) / 2) / max(pos * neg, 1))
