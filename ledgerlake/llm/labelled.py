"""Bounded samples of labelled rows for the trained classifiers, and small numpy training helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int,
                 balanced: bool) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y) of at most ``rows`` allowed labelled documents, and the class totals.

    Rows come in the order of a hash of the id, so the sample does not depend
    on file order.  ``balanced`` takes up to half of ``rows`` from each class.
    Null labels and labels outside 0/1 do not count; of repeated labels the
    largest does.
    """
    y = (labels.where(allowed & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max(label).alias("y"))
         .join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    totals = {r.y: r["count"] for r in y.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id")
    if balanced:
        picked = y.where("y = 1").orderBy(order).limit(rows // 2).unionAll(
            y.where("y = 0").orderBy(order).limit(rows // 2))
    else:
        picked = y.orderBy(order).limit(rows)
    found = [(r.doc_id, r.y) for r in picked.collect()]      # at most ``rows`` pairs
    return docs.sparkSession.createDataFrame(found, "doc_id long, y int"), totals


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def log_loss(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum())
