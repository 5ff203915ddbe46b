"""Near duplicates by circulant MinHash, banding and exact verification.

Two permutations give a whole signature: the first one scatters shingles over a circle of 2 ** CIRCLE
places, the second one ranks the places, and coordinate k is the least rank of a set's places shifted by k.
A table of ranks that runs round the circle has the ranks of all shifts of a place side by side.

Bands of a signature are buckets. BANDS and ROWS are chosen so that two sets at the threshold of 0.85
share no bucket with a probability of (1 - 0.85 ** ROWS) ** BANDS, below 1e-8; sets that are more alike
with a smaller one. Sets are linked by their full shingles alone.

Only components are asked for. In each bucket all sets are compared with a pivot, and with another one
while many pairs come of it; a set is verified with the best of its buckets' pivots. What is then left is
every pair of a bucket whose components differ: pairs are dealt by bucket and size class and pass size
and parity bitmap first, whose distance never exceeds the sets' true difference. So no bucket is too large to be looked at whole, and no link within one is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arqueo.llm.common import Tables, grouped, map_texts, materialize, texts
from arqueo.llm.components import connected_components
from arqueo.llm.hashing import doc_shingles, mix
from arqueo.llm.jaccard_join import BEST_PIVOTS, BITMAP_WORDS, _asked, _close, _digest, _distance, _linked

#: Buckets a set falls into, and coordinates that sets of a bucket share.
BANDS, ROWS = 40, 6
#: The circle has 2 ** CIRCLE places. Shingles that meet in a place make sets look more alike, never less.
CIRCLE = 22
_CHUNK = 2048
#: Pivots are chosen anew until a round has no more pairs than this, or not half as many as the one before;
#: what then is left is looked at whole.
FEW_PAIRS = 50_000


@lru_cache(maxsize=2)
def _ranks(size: int) -> np.ndarray:
    """For each place, the ranks of the places behind it: views of one table, nothing is copied."""
    order = np.argsort(mix(np.arange(1 << CIRCLE, dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D)), kind="stable")
    rank = np.empty(1 << CIRCLE, np.uint32)
    rank[order] = np.arange(1 << CIRCLE, dtype=np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([rank, rank[: size - 1]]), size)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` coordinates of a set of shingle hashes (one at least)."""
    ranks = _ranks(size)
    places = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - CIRCLE)).astype(np.int64)
    least = ranks[places[:_CHUNK]].min(0)
    for a in range(_CHUNK, len(places), _CHUNK):
        np.minimum(least, ranks[places[a : a + _CHUNK]].min(0), out=least)
    return least


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    parts = signatures.reshape(-1, bands, rows).astype(np.uint64)
    keys = mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :]
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys.view(np.int64)


def _entries(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n, set_id, bands and bitmap of each document; without words, nulls."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, sets, keys, bitmaps = [], [], [], []
        items = texts(batch.column("text"))
        for a, b in grouped(items):
            for s in doc_shingles(items[a:b], words):
                n.append(len(s))
                sets.append(_digest(s, 1) if len(s) else None)
                keys.append(band_keys(signature(s, bands * rows), bands, rows)[0] if len(s) else None)
                bits = np.bincount((mix(s) >> np.uint64(55)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
                bitmaps.append(np.packbits(bits.astype(np.uint8)).view(np.int64) if len(s) else None)
        longs = pa.list_(pa.int64())
        columns = [pa.array(n, pa.int64()), pa.array(sets, pa.int64()), pa.array(keys, longs), pa.array(bitmaps, longs)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "set_id", "bands", "bitmap"])

    return map_texts(docs.select("doc_id", "text"), "doc_id bigint, n bigint, set_id bigint, bands array<bigint>, bitmap array<bigint>", run)


def _size_class(num: int, den: int) -> Column:
    """Sets that link are of one class or of neighbours."""
    return F.floor(F.log("n") / F.log(F.lit(den / num)) + 1e-9).cast("int")


class _Buckets:
    """The sets that share a bucket with another, and the components found so far."""

    def __init__(self, tables: Tables, docs: DataFrame, unique: DataFrame, words: int, num: int, den: int):
        self.tables, self.docs, self.words, self.num, self.den = tables, docs, words, num, den
        tokens = unique.select("set_id", F.explode("bands").alias("token"))
        shared = tokens.groupBy("token").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"))
        self.placed = tables.write(tokens.join(shared.where("lo <> hi").select("token"), "token"))
        self.sets = unique.select("set_id", "n", "bitmap")
        self.readers = unique.where("first is not null").select("set_id", "first")
        self.labels = None

    def link(self, pairs: DataFrame) -> None:
        """Verify pairs (u, v) and merge the components that they connect."""
        asked = self.tables.write(_asked(pairs, self.readers))
        edges = _linked(self.docs, asked, self.words, self.num, self.den)
        if self.labels is not None:
            edges = edges.unionByName(self.labels.select(F.col("node").alias("u"), F.col("component").alias("v")))
        edges = self.tables.write(edges)
        self.labels = connected_components(edges, self.tables)
        self.tables.drop(asked, edges)

    def labelled(self) -> DataFrame:
        """set_id, n, bitmap and comp."""
        if self.labels is None:
            return self.sets.withColumn("comp", F.col("set_id"))
        known = self.labels.select(F.col("node").alias("set_id"), F.col("component").alias("known"))
        return self.sets.join(known, "set_id", "left").withColumn("comp", F.coalesce("known", "set_id")).drop("known")

    def mixed(self, sets: DataFrame) -> DataFrame:
        """The sets of each bucket that has several components, which all have at first."""
        members = self.tables.write(self.placed.join(sets, "set_id"))
        if self.labels is None:
            return members
        several = members.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        return members.join(several.select("token"), "token")

    def pivot_round(self, number: int) -> DataFrame:
        """Verify each set with the best of its buckets' pivots that are of other components; returns those pairs.

        Each bucket and round has a pivot of its own, so a set meets many members of its group, its
        source among them, and a group is one component before its pairs are looked at.
        """
        members = self.mixed(self.labelled())
        turn = F.struct(F.xxhash64("token", "set_id", F.lit(number)).alias("turn"), "set_id", "n", "bitmap", "comp")
        pivots = members.groupBy("token").agg(F.min(turn).alias("p")).select("token", "p.*")
        pairs = members.alias("a").join(pivots.alias("b"), "token")
        pairs = pairs.where((F.col("a.comp") != F.col("b.comp")) & _close("a", "b", self.num, self.den))
        # A set has no more pivots than bands.
        best = F.array_sort(F.collect_set(F.struct(_distance("a", "b").alias("d"), F.col("b.set_id").alias("v"))))
        best = pairs.groupBy(F.col("a.set_id").alias("u")).agg(F.slice(best, 1, BEST_PIVOTS).alias("x"))
        ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        found = self.tables.write(best.select("u", F.inline("x")).select(*ends).distinct())
        self.link(found)
        return found

    def rest(self, seen: list[DataFrame]) -> None:
        """Verify all other pairs of a bucket whose components differ."""
        members = self.mixed(self.labelled()).withColumn("class", _size_class(self.num, self.den))
        # A set looks for partners that are of its class or of the one below.
        reach = members.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") - 1)))
        pairs = reach.alias("a").join(
            members.alias("b"),
            (F.col("a.token") == F.col("b.token"))
            & (F.col("a.class") == F.col("b.class"))
            & (F.col("a.set_id") != F.col("b.set_id"))
            & (F.col("a.comp") != F.col("b.comp"))
            & _close("a", "b", self.num, self.den),
        )
        ends = F.greatest("a.set_id", "b.set_id").alias("u"), F.least("a.set_id", "b.set_id").alias("v")
        pairs = pairs.select(*ends).distinct()
        for some in seen:
            pairs = pairs.join(some, ["u", "v"], "left_anti")
        found = self.tables.write(pairs)
        self.link(found)
        self.tables.drop(found)


def components(docs: DataFrame, words: int = 5, num: int = 17, den: int = 20, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Words are lower-cased in A-Z and parted at ASCII white space; two documents link if the
    Jaccard similarity of their distinct shingles of ``words`` words is at least num / den;
    component_id is the least doc_id that links reach, and kept are the documents with that id.
    Fewer words are one shingle; null and empty texts have none and are components of their own. A row
    with a null doc_id joins documents with the same shingles and is linked with no other, and is kept
    if its component has no id; rows with one doc_id are documents of their own. Other columns are
    ignored. ``bands`` and ``rows`` must suit the threshold: see the module.
    """
    tables = Tables(docs.sparkSession)
    entries = tables.write(_entries(docs, words, bands, rows))
    # Copies of a set are one row from here on.
    copies = entries.where("n > 0").groupBy("set_id")
    unique = tables.write(copies.agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("n", "bands", "bitmap")]))
    buckets = _Buckets(tables, docs, unique, words, num, den)
    seen, before, pairs = [], float("inf"), float("inf")
    while not seen or FEW_PAIRS < pairs <= before / 2:
        seen.append(buckets.pivot_round(len(seen)))
        before, pairs = pairs, seen[-1].count()
    buckets.rest(seen)
    known = buckets.labels.select(F.col("node").alias("set_id"), "component")
    labels = unique.select("set_id", "first").join(known, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    least = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    by_set = labels.join(least, "component").select("set_id", "component_id")
    found = entries.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(by_set, "set_id", "left")
    component = F.coalesce("component_id", "doc_id")
    result = materialize(found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")))
    tables.drop_all()
    return result
