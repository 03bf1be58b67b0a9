"""What the classifiers share: the bounded sample of labelled rows, weights
of its rows, and the logistic curve that turns a value into a score."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import id_remainder, stored


def fit_logistic(z: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve of one input: Newton steps with a light penalty."""
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a + b * z)))
        slope = np.array([(weight * (labels - p)).sum() - 0.01 * a, (weight * (labels - p) * z).sum() - 0.01 * (b - 1)])
        d = weight * p * (1 - p)
        h = np.array([[d.sum() + 0.01, (d * z).sum()], [(d * z).sum(), (d * z * z).sum() + 0.01]])
        step = np.linalg.solve(h, slope)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def sample_ids(
    labels: DataFrame, label_col: str, folds: int, held: int, per_label: int, label: str
) -> DataFrame:
    """``_id, label`` of at most ``per_label`` rows of each label that are not
    held out, in the order of a hash of the id, stored: a bounded table."""
    rows = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter((id_remainder("_id", folds) != held) & F.col("_id").isNotNull()).distinct()
    picked = [rows.filter(F.col("label") == y).orderBy(F.xxhash64("_id", F.lit(9)), "_id").limit(per_label) for y in (0, 1)]
    return stored(picked[0].unionByName(picked[1]), label)


def label_weights(labels: DataFrame, label_col: str, folds: int, held: int, sampled: np.ndarray) -> np.ndarray:
    """Weight of each sampled row so that both labels weigh as in all
    labelled rows that are not held out; the mean is 1."""
    every = labels.filter((id_remainder("doc_id", folds) != held) & F.col(label_col).isin(0, 1))
    share = {r[0]: r[1] for r in every.groupBy(F.col(label_col).cast("int")).count().collect()}
    weight = np.array([share.get(k, 1) for k in sampled.tolist()]) / np.bincount(sampled, minlength=2)[sampled]
    return weight * len(sampled) / weight.sum()
