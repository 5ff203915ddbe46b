"""Quality by compression: two zstandard dictionaries, from good and from bad labelled text.

A text is compressed window by window with either dictionary. The difference of the compressed
sizes, divided by the text's size, says which kind of text it resembles; a logistic curve fitted
on other labelled rows turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.llm import zdict
from arqueo.llm.common import fold_of, map_texts, texts

LEVEL = 3

FEATURES = 4


@dataclass(frozen=True)
class Params:
    """Bounds of what is learnt from: rows of each class, whose texts are read whole, for the dictionaries
    and for the calibration."""

    window: int = 512
    dictionary_bytes: int = 112 * 1024
    rows_per_class: int = 800
    calibration_rows: int = 1500
    threshold: float = 0.5


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    calibration: zdict.Calibration
    params: Params


def features(text: bytes, bad: bytes, good: bytes, window: int) -> list[float]:
    """Of a whole text: the normalised size difference, its extremes by window, log of windows."""
    a, b = zdict.trained_compressor(bad, LEVEL), zdict.trained_compressor(good, LEVEL)
    total, low, high, n = 0, 1.0, -1.0, 0
    for i in range(0, max(1, len(text)), window):
        part = text[i : i + window]
        d = len(a.compress(part)) - len(b.compress(part))
        total += d
        if len(part) * 2 >= window or n == 0:
            share = d / max(1, len(part))
            low, high = min(low, share), max(high, share)
        n += 1
    return [total / max(32, len(text)), low, high, float(np.log1p(n))]


def _features_of(docs: DataFrame, bad: bytes, good: bytes, window: int, keep: str) -> DataFrame:
    names = [x.split()[0] for x in keep.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [features(t, bad, good, window) for t in texts(batch.column("text"))]
        columns = [batch.column(c) for c in names] + [pa.array(got, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, [*names, "features"])

    return map_texts(docs, f"{keep}, features array<double>", run)


def _windows_of(sample: DataFrame, params: Params) -> DataFrame:
    """label and windows of each whole text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [[t[i : i + params.window] for i in range(0, len(t), params.window)] for t in texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(got, pa.list_(pa.binary()))], ["label", "windows"])

    return map_texts(sample.select("label", "text"), "label int, windows array<binary>", run)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", params: Params | None = None) -> Model:
    """Learn from two folds of the labels: one makes the dictionaries, the other the calibration."""
    params = params or Params()
    sample = zdict.labelled_sample(docs, labels, label, zdict.DICT_FOLD, params.rows_per_class)
    rows = _windows_of(sample, params).collect()
    dictionaries = []
    for value in (0, 1):
        own = sorted(r["windows"] for r in rows if r["label"] == value)
        dictionaries.append(zdict.train_dictionary([bytes(w) for t in own for w in t], params.dictionary_bytes))
    sample = zdict.labelled_sample(docs, labels, label, zdict.CALIBRATION_FOLD, params.calibration_rows)
    measured = _features_of(sample.select("label", "text"), *dictionaries, params.window, "label int")
    counts = zdict.class_counts(labels, label, zdict.CALIBRATION_FOLD)
    calibration = zdict.calibrate(measured.collect(), counts, FEATURES)
    return Model(*dictionaries, calibration, params)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and: held_out, score (probability of label 1), predicted.

    A null text scores as an empty one; empty texts get the score of no evidence. Repeated rows
    score alike. Columns of ``docs`` with these three names are replaced.
    """
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own) + ", score double"
    p = model.params

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [features(t, model.bad, model.good, p.window) for t in texts(batch.column("text"))]
        scores = model.calibration(np.array(got, float)) if got else np.zeros(0)
        columns = [batch.column(c) for c in own] + [pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, [*own, "score"])

    return map_texts(docs.select(*own), schema, run).select(
        *own,
        (fold_of(F.col("doc_id")) == zdict.HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )
