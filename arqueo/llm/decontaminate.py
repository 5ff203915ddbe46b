"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items are short and documents long, so their Jaccard similarity is small even where an item lies
whole inside a document. Therefore items are partitioned by size (number of distinct five-word
shingles, in powers of two), and for each size class a document is seen through sliding windows of
about that size: minima over blocks of a quarter window are joined, so all classes share one pass.
An item and a document are candidates if, in the item's class, one of HASHES minima of the item is
that of a window. A window that holds 4/5 of an item agrees with it in at least a third of the
hashes; if the shingles are scattered over the document, in about a seventh of them.

Workers pass on only minima and shingles that fixed-size filters of the items let through; the
filters have no false negatives, and what passes by chance is removed by the joins. Candidates
are verified by counting shared shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.llm.common import Tables, bit_array, bit_words, grouped, in_bits, materialize, parted, texts
from arqueo.llm.hashing import doc_words, mix, windows

SHINGLE = 5
HASHES = 48
SEGMENT = 4096

_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
#: ASCII characters that are neither letters nor digits part words as white space does.
_WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def shingle_lists(items: list[bytes]) -> list[np.ndarray]:
    """Each text's five-word shingle hashes in order; a shorter text is one shingle."""
    hashes, bounds = doc_words([t.translate(_WORD) for t in items], lower=True)
    full = windows(hashes, SHINGLE)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        n = int(b - a)
        if n >= SHINGLE:
            out.append(full[a : b - SHINGLE + 1])
        else:
            out.append(windows(hashes[a:b], n) ^ np.uint64(n) if n else np.zeros(0, np.uint64))
    return out


def _lowered(table: DataFrame, id_column: str) -> DataFrame:
    return table.select(F.col(id_column).alias("id"), F.lower("text").alias("text"))


def item_table(items: DataFrame) -> DataFrame:
    """item_id, size, class, minima (array, by hash) and shingles of each item with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, classes, minima, shingles = [], [], [], [], []
            for i, s in zip(batch.column("id").to_pylist(), shingle_lists(texts(batch.column("text"))), strict=True):
                if not len(s) or i is None:
                    continue
                s = np.unique(s)
                ids.append(i)
                sizes.append(len(s))
                classes.append(len(s).bit_length() - 1)
                minima.append((s[None, :] * _MULTIPLIERS[:, None]).min(1).view(np.int64))
                shingles.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(classes, pa.int32()),
                    pa.array(minima, pa.list_(pa.int64())), pa.array(shingles, pa.list_(pa.int64())),
                ],
                ["item_id", "size", "class", "minima", "shingles"],
            )

    schema = "item_id bigint, size int, class int, minima array<bigint>, shingles array<bigint>"
    return _lowered(items, "item_id").mapInArrow(run, schema)


#: Each value has two places in bit tables: of its low bits, and of the bits from here on.
_SECOND = 29


def _filters(values: DataFrame) -> list[np.ndarray]:
    """Two bit tables of the column value."""
    return [bit_array(values, F.col("value")), bit_array(values, F.shiftrightunsigned("value", _SECOND))]


def window_minima(shingles: np.ndarray, classes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each class, minima (hash by window) of windows of 2 ** (class + 1) shingles, each a
    quarter of that after the last (of four shingles for the smallest classes)."""
    v = shingles[None, :] * _MULTIPLIERS[:, None]
    level = 0
    for c in classes:
        want = max(0, c - 1)
        while level < want:
            if v.shape[1] % 2:
                v = np.concatenate([v, np.full((HASHES, 1), _MOST)], 1)
            v = np.minimum(v[:, 0::2], v[:, 1::2])
            level += 1
        out = v.copy()
        for shift in (1, 2, 3):
            if shift < v.shape[1]:
                np.minimum(out[:, :-shift], v[:, shift:], out=out[:, :-shift])
        yield c, out


def _document_hits(docs: DataFrame, classes: list[int], tables: Broadcast) -> DataFrame:
    """doc_id, found (class, hash, value) and shingles, of documents that pass the filters."""
    reach = 1 << (max(classes, default=0) + 1)

    def passing(values: np.ndarray, tables) -> np.ndarray:
        at = np.flatnonzero(in_bits(tables[0], values.view(np.int64)))
        return at[in_bits(tables[1], (values[at] >> np.uint64(_SECOND)).view(np.int64))]

    def hits(shingles: np.ndarray, minima_tables) -> np.ndarray:
        found = []
        step = max(SEGMENT, 2 * reach)
        for a in range(0, max(1, len(shingles) - reach // 2), step):
            for c, v in window_minima(shingles[a : a + step + reach], classes):
                flat = v.reshape(-1)
                at = passing(flat, minima_tables)
                if len(at):
                    row = np.empty((len(at), 3), np.uint64)
                    row[:, 0], row[:, 1], row[:, 2] = c, at // v.shape[1], flat[at]
                    found.append(row)
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima_tables, shingle_tables = tables.value
        for batch in batches:
            ids, items = batch.column("id").to_pylist(), texts(batch.column("text"))
            out: list[list] = [[], [], [], [], []]
            for a, b in grouped(items):
                for i, s in zip(ids[a:b], shingle_lists(items[a:b]), strict=True):
                    found = hits(s, minima_tables) if len(s) and i is not None else ()
                    if not len(found):
                        continue
                    own = np.unique(s[passing(s, shingle_tables)])
                    for column, x in zip(out, (i, *found.T.copy().view(np.int64), own.view(np.int64)), strict=True):
                        column.append(x)
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["doc_id", "class", "hash", "value", "shingles"]
            )

    schema = "doc_id bigint, class array<bigint>, hash array<bigint>, value array<bigint>, shingles array<bigint>"
    return _lowered(docs, "doc_id").mapInArrow(run, schema)


def contained_items(docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shared, item_size, containment of all pairs found with containment >= least.

    Words are lower-cased and parted at ASCII characters other than letters and digits.
    Containment is the share of the item's distinct five-word shingles that the document has. An
    item of fewer words is one shingle, and found in documents that are the same words. Items and
    documents without words, or with a null id, pair with nothing. Rows with one doc_id count as
    one document, repeated items pair alike. Other columns are ignored.
    """
    tables = Tables(docs.sparkSession)
    known = tables.write(item_table(items))
    classes = [r["class"] for r in known.select("class").distinct().orderBy("class").collect()]
    if not classes:
        tables.drop_all()
        none = "doc_id bigint, item_id bigint, n_shared bigint, item_size int, containment double"
        return docs.sparkSession.createDataFrame([], none)
    minima = known.select("item_id", "class", F.posexplode("minima").alias("hash", "value"))
    shingles = known.select("item_id", "size", F.explode("shingles").alias("value"))
    bits = docs.sparkSession.sparkContext.broadcast([_filters(x) for x in (minima, shingles)])
    found = tables.write(_document_hits(docs, classes, bits))
    bits.destroy()
    seen = found.select("doc_id", F.explode(F.arrays_zip("class", "hash", "value")).alias("x"))
    seen = seen.select("doc_id", "x.*").distinct()
    candidates = tables.write(seen.join(minima, ["class", "hash", "value"]).select("doc_id", "item_id").distinct())
    # Only the candidates' shingles are looked up, so that a shingle of many documents and items makes no pairs.
    own = found.select("doc_id", F.explode("shingles").alias("value")).distinct()
    shared = candidates.join(own, "doc_id").join(shingles.distinct(), ["item_id", "value"])
    shared = shared.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"), F.first("size").alias("item_size"))
    share = F.col("n_shared") / F.col("item_size")
    result = materialize(shared.withColumn("containment", share).where(F.col("n_shared") >= least * F.col("item_size") - 1e-9))
    tables.drop_all()
    return result


def clean_documents(docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose own text contains no item, whatever their id.

    Rows are told apart by a digest of doc_id and text; only those whose digest may be a dropped
    row's are exchanged.
    """
    key = "arqueo_key"
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull()))
    hits = contained_items(marked.select(F.col(key).alias("doc_id"), "text"), items, least).select("doc_id").distinct()
    likely, others = parted(marked, key, bit_words(hits, F.col("doc_id")))
    left = likely.join(hits.select(F.col("doc_id").alias(key)), key, "left_anti")
    return others.select(docs.columns).unionByName(left.select(docs.columns))
