"""What the two text classifiers share: bounded samples of labelled rows, and a calibrated logistic curve."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyloom.llm.work import crc_mod, stored


class Sample(NamedTuple):
    """Training rows (id, text, label, part), and how many rows each class has outside the sample too.

    ``part`` is 1 for a fourth of the rows, on which a model fitted on the others is calibrated.
    """

    rows: DataFrame
    totals: dict[int, int]


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    fold: Column,
    class_rows: dict[int, int],
    most_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Sample:
    """Up to ``class_rows[c]`` rows of each class for which ``fold`` holds, none longer than ``most_bytes``.

    Rows are chosen by a hash of the id; a repeated label counts once, the larger one. Only ids are joined and ranked.
    The chosen ids, at most the sum of ``class_rows`` numbers, are broadcast to find their texts, so no text is
    shuffled.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(*class_rows))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    fit = docs.where(fold & (F.octet_length(text_col) <= most_bytes))
    narrow = stored(fit.select(F.col(id_col).alias("id")).join(known, "id"), "labelled-ids")
    totals = {r["label"]: r["count"] for r in narrow.groupBy("label").count().collect()}
    drawn = Window.partitionBy("label").orderBy(F.xxhash64("id", F.lit(1)), "id")
    most = F.lit(0)
    for c, n in class_rows.items():
        most = F.when(F.col("label") == c, n).otherwise(most)
    ranked = narrow.withColumn("_n", F.row_number().over(drawn)).where(F.col("_n") <= most)
    chosen = stored(ranked.select(F.col("id").alias("_id"), "label").distinct(), "sample-ids")
    picked = fit.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("_id")
    )
    part = (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(4)) == 0).cast("int").alias("part")
    return Sample(stored(picked.select("id", "text", "label", part), "sample"), totals)


class Logistic:
    """Logistic regression on a few features, by Newton steps with a small penalty."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.1):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._design(x)
        self.w = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            gradient = z.T @ (weight * (p - y)) + penalty * self.w
            curve = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(self.w))
            step = np.linalg.solve(curve, gradient)
            self.w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        self.w = self.w.copy()

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.mean) / self.spread, np.ones(len(x))]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.w, -30, 30)))


def held_out(fold: int, of: int, id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves the remainder ``fold``; a null id is never held out."""
    return F.coalesce(crc_mod(F.col(id_col), of) == fold, F.lit(False))
