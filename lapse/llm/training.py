"""Bounded labelled samples and a small logistic fit, for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_CLASS = 3000       # labelled rows of each class that a classifier is fitted on
TEXT_BYTES = 32 << 10       # longer texts aren't fitted on (they are scored whole)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column | None = None,
                    rows: int = ROWS_PER_CLASS) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """([(text, label)], labelled rows of each class), from at most ``rows`` rows of each class.

    Rows are chosen by a hash of doc_id, so they depend on neither order nor
    partitions; a doc_id with several texts gives its least, one with several
    labels counts as 1 if any is.
    """
    picked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if allowed is not None:
        picked = picked.where(allowed)
    picked = picked.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in picked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = (picked.where("y = 0").orderBy(*order).limit(rows)
              .union(picked.where("y = 1").orderBy(*order).limit(rows)))
    texts = (docs.where(F.octet_length("text") <= TEXT_BYTES)
             .join(F.broadcast(chosen), "doc_id")        # at most 2 * rows ids
             .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
             .orderBy(*order).select("text", "y"))
    return [(r["text"], r["y"]) for r in texts.collect()], counts


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - keep * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def prior_shift(counts: dict[int, int], y: np.ndarray) -> float:
    """What the intercept lacks because the classes of the sample aren't in their true proportion."""
    ones, zeros = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    return float(np.log(max(1, counts.get(1, 0)) / ones) - np.log(max(1, counts.get(0, 0)) / zeros))


def sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
