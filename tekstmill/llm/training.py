"""Bounded training samples and a small logistic regression for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: str) -> Column:
    """Rows never trained on: CRC-32 of the id as text, modulo 5, is 0 (a NULL id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", text: str = "text"):
    """(text, y) of at most ``rows`` labelled documents that are not held out, chosen by a hash of their id.

    Ids without a label of 0 or 1 are left out. Of equal texts one remains per label, so that copies don't count
    many times. ``rows`` bounds what is broadcast and what is trained on.
    """
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("y"))
    known = known.filter(~held_out("__id") & F.col("__id").isNotNull() & F.col("y").isin(0, 1)).distinct()
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "y").limit(rows)
    texts = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "__id").select("text", "y").dropDuplicates(["text", "y"])


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton's method on standardised columns, given back for the plain ones."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
        return np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(y))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], l2)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
