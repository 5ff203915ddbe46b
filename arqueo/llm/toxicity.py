"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

The dictionaries hold the byte segments that set one class's texts apart from the other's. A text
is compressed in short windows with the toxic, the ordinary and an empty dictionary. The windows
start with a primer that all three dictionaries hold, which cancels the fixed cost of a first
match, and a fast strategy stores literals as they are; so a window that shares nothing with the
toxic dictionary gains nothing. Thresholds on the gains are calibrated on other labelled rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.llm import zdict
from arqueo.llm.common import fold_of, map_texts, texts

#: Bytes that no text is likely to hold.
PRIMER = bytes([0, 1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24])
OVERLAP = 8

#: Bytes that a window gains, each of which is a threshold whose weight is learnt.
GAINS = (1, 2, 3, 4, 5, 6, 7, 8)
FEATURES = 6 + 2 * len(GAINS)


@dataclass(frozen=True)
class Params:
    """Bounds of what is learnt from: rows of each class, whose texts are read whole, and segments.
    ``miss_cost``: how many false alarms weigh as much as a toxic text that is missed."""

    window: int = 24
    segments: int = 160
    cover: int = 8
    rows_per_class: int = 1000
    calibration_rows: int = 1500
    miss_cost: float = 3.0
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    calibration: zdict.Calibration
    params: Params


def _word_counts(sample: DataFrame) -> DataFrame:
    """label, words and counts of each whole text, in lower case."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [Counter(t.lower().split()) for t in texts(batch.column("text"))]
        words = pa.array([list(x) for x in found], pa.list_(pa.binary()))
        counts = pa.array([list(x.values()) for x in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), words, counts], ["label", "words", "counts"])

    return map_texts(sample.select("label", "text"), "label int, words array<binary>, counts array<bigint>", run)


def _segments(words: dict[bytes, int], low: int = 5, high: int = 9) -> Counter[bytes]:
    """What each byte segment of a text's words counts: log2(1 + how often it is there), so that a text which
    repeats itself doesn't decide. A word's first segments have the space before it; texts without
    spaces are one long word."""
    out: Counter[bytes] = Counter()
    for w, k in words.items():
        w = b" " + w
        for g in {w[i : i + n] for n in range(low, high + 1) for i in range(len(w) - n + 1)}:
            out[g] += k
    return Counter({g: math.log2(1 + k) for g, k in out.items()})


def _surprise(k: int, n: int, k2: int, n2: int) -> float:
    """Log-likelihood ratio of two rates against one; near chi-square by chance."""
    p = (k + k2) / (n + n2)
    part = lambda a, b: a * math.log(a / b) if a else 0.0
    return 2 * (part(k, n * p) + part(n - k, n * (1 - p)) + part(k2, n2 * p) + part(n2 - k2, n2 * (1 - p)))


_PLACES = 1 << 22


def distinctive(
    own: list[dict[bytes, int]], other: list[dict[bytes, int]], most: int, cover: int, ratio: float = 5, least_surprise: float = 15
) -> bytes:
    """Dictionary content: segments frequent in ``own`` texts (words with counts) and rare in ``other`` ones.

    A segment counts if own texts have it ``ratio`` times as often and the number of texts that
    have it is no chance (``least_surprise``). Chosen greedily, until each own text holds
    ``cover`` of them where it can; the strongest stand last, where a dictionary's matches are
    cheapest.
    """
    least = max(2, math.ceil(0.01 * len(own)))
    # Most segments stand in one text. A table of counts by hash spares the memory of listing them.
    texts_with = np.zeros(_PLACES, np.uint16)
    for t in own:
        texts_with[list({zlib.crc32(g) % _PLACES for g in _segments(t)})] += 1
    sets, df, tf = [], Counter(), Counter()
    for t in own:
        found = {g: k for g, k in _segments(t).items() if texts_with[zlib.crc32(g) % _PLACES] >= least}
        df.update(found.keys())
        tf.update(found)
        sets.append(found.keys())
    df = Counter({g: k for g, k in df.items() if k >= least})
    df2, tf2 = Counter(), Counter()
    for t in other:
        found = {g: k for g, k in _segments(t).items() if g in df}
        df2.update(found.keys())
        tf2.update(found)
    worth = {}
    for g, k in df.items():
        rate = ((tf[g] + 0.5) / (len(own) + 1)) / ((tf2[g] + 0.5) / (len(other) + 1))
        if rate >= ratio and _surprise(k, len(own), df2[g], len(other)) >= least_surprise:
            worth[g] = math.log(rate)
    left = [[s & worth.keys(), cover] for s in sets]
    open_in: Counter[bytes] = Counter()
    for s, _ in left:
        open_in.update(s)
    chosen: list[bytes] = []
    while len(chosen) < most and open_in:
        best = max(open_in, key=lambda g: (open_in[g] * worth[g], len(g), g))
        if open_in[best] < least:
            break
        del open_in[best]
        if not any(best in c or c in best for c in chosen):
            chosen.append(best)
        for entry in left:
            if entry[1] and best in entry[0]:
                entry[1] -= 1
                if not entry[1]:
                    open_in.subtract(entry[0] & open_in.keys())
    return b"".join(reversed(chosen))


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zs.ZstdCompressor:
    d = zs.ZstdCompressionDict(content + b" " + PRIMER, dict_type=zs.DICT_TYPE_RAWCONTENT)
    p = zs.ZstdCompressionParameters(
        window_log=17, chain_log=10, hash_log=14, search_log=4, min_match=5, target_length=1,
        strategy=zs.STRATEGY_FAST, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    return zs.ZstdCompressor(dict_data=d, compression_params=p)


def features(text: bytes, ordinary: bytes, toxic: bytes, window: int) -> list[float]:
    """Of a whole text: how much its windows gain by the toxic dictionary."""
    plain, a, b = _compressor(b"").compress, _compressor(ordinary).compress, _compressor(toxic).compress
    text = b" ".join(text.lower().split())
    gains, against = [], 0
    for i in range(0, max(1, len(text)), window):
        part = PRIMER + b" " + text[max(0, i - OVERLAP) : i + window]
        with_toxic = len(b(part))
        gains.append(len(plain(part)) - with_toxic)
        against += len(a(part)) - with_toxic
    g, n = np.array(gains), len(gains)
    hits = [int((g >= least).sum()) for least in GAINS]
    return [
        float(g.max()),
        math.log1p(50 * max(0.0, g.sum() / n)),
        against / n,
        *(math.log1p(k) for k in hits),
        *(math.log1p(20 * k / n) for k in hits),
        10 * hits[0] / n,
        float(min(10, hits[2])),
        math.log1p(n),
    ]


def _features_of(docs: DataFrame, ordinary: bytes, toxic: bytes, window: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [features(t, ordinary, toxic, window) for t in texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(got, pa.list_(pa.float64()))], ["label", "features"])

    return map_texts(docs.select("label", "text"), "label int, features array<double>", run)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", params: Params | None = None) -> Model:
    """Learn from two folds of the labels: one makes the dictionaries, the other the thresholds."""
    params = params or Params()
    sample = zdict.labelled_sample(docs, labels, label, zdict.DICT_FOLD, params.rows_per_class)
    by: dict[int, list] = {0: [], 1: []}
    for r in _word_counts(sample).collect():
        by[r["label"]].append(dict(sorted((bytes(w), n) for w, n in zip(r["words"], r["counts"], strict=True))))
    by = {c: sorted(rows, key=lambda words: list(words.items())) for c, rows in by.items()}
    toxic = distinctive(by[1], by[0], params.segments, params.cover)
    ordinary = distinctive(by[0], by[1], params.segments, params.cover, ratio=8, least_surprise=4)[-max(64, len(toxic)) :]
    sample = zdict.labelled_sample(docs, labels, label, zdict.CALIBRATION_FOLD, params.calibration_rows)
    measured = _features_of(sample, ordinary, toxic, params.window)
    counts = zdict.class_counts(labels, label, zdict.CALIBRATION_FOLD)
    counts[1] = params.miss_cost * counts.get(1, 0)
    return Model(ordinary, toxic, zdict.calibrate(measured.collect(), counts, FEATURES), params)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and: held_out, score (probability of label 1), predicted.

    A null text scores as an empty one; empty texts get the score of no evidence. Repeated rows
    score alike. Columns of ``docs`` with these three names are replaced.
    """
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own) + ", score double"
    p = model.params

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [features(t, model.ordinary, model.toxic, p.window) for t in texts(batch.column("text"))]
        scores = model.calibration(np.array(got, float)) if got else np.zeros(0)
        columns = [batch.column(c) for c in own] + [pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, [*own, "score"])

    return map_texts(docs.select(*own), schema, run).select(
        *own,
        (fold_of(F.col("doc_id")) == zdict.HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
    )
