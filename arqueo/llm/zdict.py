"""What the two compression classifiers share: samples, compressors, calibration."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.llm.common import fold_of

DICT_FOLD, CALIBRATION_FOLD, HELD_OUT_FOLD = 0, 2, 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, per_class: int) -> DataFrame:
    """doc_id, label and text of at most ``per_class`` rows of each class, chosen by a hash of the id.

    Rows with a null id or label are left out. Of the labels only the chosen ids are joined, and
    their number is bounded, so that side is broadcast.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) == fold)
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        some = rows.where(F.col("label") == value).dropDuplicates(["doc_id"]).orderBy(*order).limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def class_counts(labels: DataFrame, label: str, fold: int) -> dict[int, int]:
    """Number of usable labels of each class in a fold."""
    rows = labels.where(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) == fold))
    counted = rows.groupBy(F.col(label).cast("int").alias("label")).count().where(F.col("label").isin(0, 1))
    return {r["label"]: r["count"] for r in counted.collect()}


@lru_cache(maxsize=8)
def trained_compressor(data: bytes, level: int) -> zs.ZstdCompressor:
    """A compressor with a dictionary that zstandard trained (or, if it starts otherwise, raw content)."""
    d = zs.ZstdCompressionDict(data)
    d.precompute_compress(level=level)
    return zs.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained zstandard dictionary; with too little text for the trainer, the text itself."""
    samples = [s for s in samples if s]
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:] or b" "


class Calibration:
    """Ridge-penalised logistic regression on standardised features, fitted by Newton steps.

    ``weights`` scale each row, so that classes which a bounded sample holds in other shares
    count as in all labels.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 0.5):
        if len(y) == 0 or len(np.unique(y)) < 2:
            p = float(np.mean(y)) if len(y) else 0.5
            n = x.shape[1]
            self.mean, self.scale = np.zeros(n), np.ones(n)
            self.beta = np.r_[np.log((p + 0.01) / (1.01 - p)), np.zeros(n)]
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        weights = weights * len(weights) / weights.sum()
        penalty = ridge * np.r_[1e-6, np.ones(x.shape[1])]
        self.beta = np.zeros(z.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            gradient = z.T @ (weights * (p - y)) + penalty * self.beta
            curve = (z * (weights * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, gradient)
            self.beta -= step
            if np.abs(step).max() < 1e-8:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        return 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))


def calibrate(rows: list, counts: dict[int, int], size: int) -> Calibration:
    """``rows`` have label and ``size`` features; ``counts`` are the classes' sizes among all labels.

    Without rows of both classes the score is the known class's share, or one half.
    """
    y = np.array([r["label"] for r in rows], float)
    x = np.array([r["features"] for r in rows], float).reshape(len(rows), size)
    sampled = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weights = np.array([counts.get(int(c), 1) / sampled[int(c)] for c in y], float)
    return Calibration(x, y, weights)
