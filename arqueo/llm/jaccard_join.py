"""N-gram Jaccard self-join by prefixes of groups, down to connected components.

Documents with one shingle set are one *set*; sets with the same prefix and size are one *group*.
A set's prefix is its rarest shingles, as many as it takes that two sets above the threshold must
share one. Rarity is read from a table of counts over all shingles, of fixed size; the order it
gives is the same everywhere, so the join is exact whatever the counts.

Only components are asked for, so pairs inside a component need no check. First the groups of each
prefix shingle are compared with one pivot, and every set is verified with the best of its pivots
only; what is then left is every pair of groups that share a prefix shingle and lie in different
components.
Pairs of groups are filtered by size and, expanded to sets, by a parity bitmap, whose distance
never exceeds the sets' true difference; then pairs meet by pivot, where their shingle sets are
intersected. No link can be lost: the last step looks at all pairs that are not yet connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arqueo.llm.common import Tables, bit_array, bit_words, grouped, in_bits, job_settings, map_texts, materialize, parted, texts
from arqueo.llm.components import connected_components
from arqueo.llm.hashing import doc_shingles, mix

COUNT_BITS = 22
_ROW = 1024
BITMAP_WORDS = 8
#: About how many pairs of one pivot a task verifies.
PART_PAIRS = 1024
#: How many of a set's pivots it is verified with.
BEST_PIVOTS = 3


def shingle_counts(docs: DataFrame, words: int, bits: int = COUNT_BITS) -> np.ndarray:
    """How many documents' shingles fall into each of 2 ** bits places, on a logarithmic scale.

    Every task sends its counts in rows of 1024 places; partial sums meet by row. The table's size
    is fixed: a worker gets 2 ** bits bytes whatever the corpus, the driver holds a few times as much.
    """
    places = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, np.uint32)
        for batch in batches:
            items = texts(batch.column("text"))
            for a, b in grouped(items, 1 << 22):
                found = [s for x, y in grouped(items[a:b]) for s in doc_shingles(items[a + x : a + y], words)]
                at, n = np.unique((np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
                total[at] += n.astype(np.uint32)
        # A byte for each place; what is beyond it follows in further rows.
        left = total.reshape(-1, _ROW)
        numbers = np.arange(len(left))
        while len(left):
            part = np.minimum(left, 255)
            yield from rows_of(zip(numbers.tolist(), part.astype(np.uint8), strict=True))
            left = left - part
            more = left.any(1)
            left, numbers = left[more], numbers[more]

    def rows_of(rows) -> Iterator[pa.RecordBatch]:
        kept = [(i, r.tobytes()) for i, r in rows if r.any()]
        columns = [pa.array([i for i, _ in kept], pa.int32()), pa.array([r for _, r in kept], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, r in zip(batch.column("row").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = total.setdefault(i, np.zeros(_ROW, np.uint32))
                own += np.minimum(np.frombuffer(r, np.uint8), np.uint32(0xFFFFFFFF) - own)
        yield from rows_of(total.items())

    schema = "row int, counts binary"
    partial = docs.select("text").mapInArrow(count, schema)
    out = np.zeros((places // _ROW, _ROW), np.uint32)
    with job_settings(docs.sparkSession):
        rows = partial.repartition("row").mapInArrow(add, schema).collect()
    for r in rows:
        out[r["row"]] = np.frombuffer(r["counts"], np.uint32)
    return np.minimum(255, 8 * np.log2(1.0 + out.reshape(-1))).astype(np.uint8)


def prefix_size(n: int, num: int, den: int) -> int:
    """Shingles of a set of n, of which sets above num / den must share one: n - ceil(n num / den) + 1."""
    return n - -(-n * num // den) + 1


def _entries(docs: DataFrame, words: int, num: int, den: int, counts, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n, set_id, group_id, prefix and bitmap of each document, and its ``extra`` bigint columns."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = counts.value
        shift = np.uint64(64 - int(len(table)).bit_length() + 1)
        items = texts(batch.column("text"))
        n, sets, groups, prefixes, bitmaps = [], [], [], [], []
        for a, b in grouped(items):
            for s in doc_shingles(items[a:b], words):
                n.append(len(s))
                if not len(s):
                    for column in (sets, groups, prefixes, bitmaps):
                        column.append(None)
                    continue
                order = np.lexsort((s, table[(s >> shift).astype(np.int64)]))
                prefix = s[order[: prefix_size(len(s), num, den)]]
                sets.append(_digest(s, 1))
                groups.append(_digest(np.sort(prefix), len(s)))
                prefixes.append(prefix.view(np.int64))
                bits = np.bincount((mix(s) >> np.uint64(55)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
                bitmaps.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
        longs = pa.list_(pa.int64())
        columns = [pa.array(n, pa.int64()), pa.array(sets, pa.int64()), pa.array(groups, pa.int64()), pa.array(prefixes, longs), pa.array(bitmaps, longs)]
        columns += [batch.column(c) for c in extra]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "set_id", "group_id", "prefix", "bitmap", *extra])

    schema = "doc_id bigint, n bigint, set_id bigint, group_id bigint, prefix array<bigint>, bitmap array<bigint>"
    return map_texts(docs.select("doc_id", "text", *extra), schema + "".join(f", {c} bigint" for c in extra), run)


def _digest(values: np.ndarray, seed: int) -> int:
    """A 64-bit digest of sorted hashes."""
    with np.errstate(over="ignore"):
        salted = mix(values ^ mix(np.array([len(values), seed], np.uint64)).sum())
        return int(mix(np.array([salted.sum()], np.uint64)).view(np.int64)[0])


def _several(df: DataFrame, key: str, of: str) -> DataFrame:
    """The values of ``key`` with more than one value of ``of``."""
    return df.groupBy(key).agg(F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo <> hi").select(key)


def _passing(entries: DataFrame, table) -> DataFrame:
    """token, group_id, n of the prefix shingles whose place is set. The table has no false
    negatives; it spares the exchange most shingles that no other document has."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column("prefix")
        values = lists.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        kept = np.flatnonzero(in_bits(table.value, values))
        at = pa.array(owner[kept])
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[kept]), batch.column("group_id").take(at), batch.column("n").take(at)], ["token", "group_id", "n"]
        )

    return map_texts(entries.select("prefix", "group_id", "n"), "token bigint, group_id bigint, n bigint", run)


def _asked(pairs: DataFrame, readers: DataFrame) -> DataFrame:
    """first, set_id, v, part, other: whose text each pivot v of ``pairs`` (u, v) needs, its own first.

    A pivot's pairs are dealt over parts of about PART_PAIRS, each of which gets the pivot's text, so
    that no task has all pairs of a hot pivot. readers: set_id, first (a doc_id of the set).
    """
    parts = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / PART_PAIRS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("u"), F.col("parts")).cast("int")
    members = pairs.join(parts, "v").select(F.col("u").alias("set_id"), "v", part.alias("part"), F.lit(1).alias("other"))
    pivots = parts.select(
        F.col("v").alias("set_id"), "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("other")
    )
    return members.unionByName(pivots).join(readers, "set_id")


def _linked(docs: DataFrame, asked: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """u, v of the asked pairs whose shingle sets reach the threshold.

    Each pair's text goes to its pivot's part, compressed, as texts are smaller than shingles; one
    exchange serves all pairs. Rows that repeat the doc_id of another text are told apart by their
    shingles.
    """
    key = F.xxhash64("doc_id")
    hashed = docs.select("doc_id", "text", key.alias("arqueo_key"))
    likely, _ = parted(hashed, "arqueo_key", bit_words(asked.select(F.col("first").alias("doc_id")), key))
    found = likely.join(asked, F.col("doc_id") == F.col("first")).select("set_id", "v", "part", "other", "text")

    def packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pack = zs.ZstdCompressor(3).compress
        bodies = [pack(t) for t in texts(batch.column("text"))]
        names = ["set_id", "v", "part", "other"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(bodies, pa.binary())], [*names, "body"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zs.ZstdDecompressor().decompress
        pivot, own = None, None
        for batch in batches:
            kept = []
            for u, v, other, body in zip(*(batch.column(c).to_pylist() for c in ("set_id", "v", "other", "body")), strict=True):
                s = doc_shingles([unpack(body)], words)[0]
                if _digest(s, 1) != u:
                    continue
                if not other:
                    pivot, own = v, s
                elif pivot == v:
                    shared = len(np.intersect1d(own, s, assume_unique=True))
                    if shared * (num + den) >= (len(own) + len(s)) * num:
                        kept.append((u, v))
            columns = [pa.array([x[i] for x in kept], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    sent = map_texts(found, "set_id bigint, v bigint, part int, other int, body binary", packed)
    return sent.repartition("v", "part").sortWithinPartitions("v", "part", "other").mapInArrow(compare, "u bigint, v bigint")


def _distance(a: str, b: str) -> Column:
    """Bits in which two parity bitmaps differ: at most the size of the sets' symmetric difference."""
    return reduce(
        lambda x, y: x + y,
        (F.bit_count(F.col(f"{a}.bitmap")[i].bitwiseXOR(F.col(f"{b}.bitmap")[i])) for i in range(BITMAP_WORDS)),
    )


def _near(a: str, b: str, num: int, den: int) -> Column:
    """Whether two sets' sizes allow a link."""
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return low * den >= high * num


def _close(a: str, b: str, num: int, den: int) -> Column:
    """Whether two sets' sizes and bitmaps allow a link. An overlap o links if (num + den) o >= num (n + m)."""
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    overlap = F.ceil(total * num / (num + den))
    return _near(a, b, num, den) & (_distance(a, b) <= total - 2 * overlap)


def _close_sets(tables: Tables, sets: DataFrame, index: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The sets that size and bitmap allow to link with some other of a shared prefix shingle or of
    their own group, and the index of those. The join stops at a set's first such partner."""
    members = index.select("token", "group_id").join(sets, "group_id")
    twins = sets.join(_several(sets, "group_id", "set_id"), "group_id").withColumn("token", F.col("group_id"))
    members = tables.write(members.unionByName(twins.select(members.columns)))
    other = (F.col("a.token") == F.col("b.token")) & (F.col("a.set_id") != F.col("b.set_id"))
    found = members.alias("a").join(members.alias("b"), other & _close("a", "b", num, den), "left_semi")
    kept = tables.write(sets.join(found.select("set_id").distinct(), "set_id"))
    tables.drop(members)
    return kept, tables.write(index.join(kept.select("group_id").distinct(), "group_id"))


class _Join:
    """The tables of one run: sets, groups by prefix shingle, and the components so far."""

    def __init__(
        self, tables: Tables, docs: DataFrame, readers: DataFrame, sets: DataFrame, index: DataFrame, words: int, num: int, den: int
    ):
        self.tables, self.docs, self.readers, self.sets, self.index = tables, docs, readers, sets, index
        self.words, self.num, self.den = words, num, den
        self.labels = None

    def labelled(self) -> DataFrame:
        """set_id, group_id, n, bitmap, comp."""
        if self.labels is None:
            return self.sets.withColumn("comp", F.col("set_id"))
        known = self.labels.select(F.col("node").alias("set_id"), F.col("component").alias("known"))
        return self.sets.join(known, "set_id", "left").withColumn("comp", F.coalesce("known", "set_id")).drop("known")

    def placed(self, sets: DataFrame) -> DataFrame:
        """The index with the least and greatest component of each group."""
        groups = sets.groupBy("group_id").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        return self.index.join(groups, "group_id")

    def close(self, a: str, b: str) -> Column:
        return _close(a, b, self.num, self.den)

    def link(self, pairs: DataFrame) -> None:
        """Verify pairs (u, v) and merge the components that they connect."""
        pairs = self.tables.write(pairs)
        asked = self.tables.write(_asked(pairs, self.readers))
        edges, before = _linked(self.docs, asked, self.words, self.num, self.den), self.labels
        if before is not None:
            edges = edges.unionByName(before.select(F.col("node").alias("u"), F.col("component").alias("v")))
        edges = self.tables.write(edges)
        rounds = Tables(edges.sparkSession)
        self.labels = self.tables.write(connected_components(edges, rounds))
        rounds.drop_all()
        self.tables.drop(pairs, asked, edges, *([before] if before is not None else []))

    def pivot_round(self) -> None:
        """Compare the groups of each prefix shingle with a pivot group; verify each set's best pairs."""
        sets = self.labelled()
        placed = self.placed(sets)
        turn = F.struct(F.xxhash64("token", "group_id").alias("turn"), F.col("group_id").alias("pivot"), "n")
        pivots = placed.groupBy("token").agg(F.min(turn).alias("p"), F.min("low").alias("lo"), F.max("high").alias("hi"))
        pivots = pivots.where("lo <> hi").select("token", "p.pivot", F.col("p.n").alias("pivot_n"))
        groups = placed.join(pivots, "token").where("group_id <> pivot")
        low, high = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
        groups = groups.where(low * self.den >= high * self.num).select("group_id", "pivot").distinct()
        inside = sets.groupBy("group_id").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        groups = groups.unionByName(inside.select("group_id", F.col("group_id").alias("pivot")))
        # One set stands for the pivot group; the last step has all of them.
        heads = sets.groupBy(F.col("group_id").alias("pivot")).agg(
            F.min(F.struct("set_id", "n", "bitmap", "comp")).alias("h")
        ).select("pivot", "h.*")
        pairs = (
            groups.join(sets, "group_id").alias("a")
            .join(heads.alias("b"), F.col("a.pivot") == F.col("b.pivot"))
            .where((F.col("a.comp") != F.col("b.comp")) & self.close("a", "b"))
        )
        # A set has no more pivots than prefix shingles.
        pivots = F.array_sort(F.collect_set(F.struct(_distance("a", "b").alias("d"), F.col("b.set_id").alias("v"))))
        best = pairs.groupBy(F.col("a.set_id").alias("u")).agg(F.slice(pivots, 1, BEST_PIVOTS).alias("x"))
        self.link(best.select("u", F.inline("x")).select("u", "v"))

    def rest(self) -> None:
        """All pairs of sets in different components whose groups share a prefix shingle, or are one."""
        sets = self.labelled()
        placed = self.placed(sets)
        mixed = placed.groupBy("token").agg(F.min("low").alias("lo"), F.max("high").alias("hi")).where("lo <> hi")
        left = placed.join(mixed.select("token"), "token").select("token", "group_id", "n")
        members = left.join(sets.select("group_id", "set_id", "bitmap", "comp"), "group_id")
        within = sets.groupBy("group_id").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        own = sets.join(within.select("group_id"), "group_id").select(
            F.col("group_id").alias("token"), "group_id", "n", "set_id", "bitmap", "comp"
        )
        members = self.tables.write(members.select(own.columns).unionByName(own))
        pairs = members.alias("a").join(
            members.alias("b"),
            (F.col("a.token") == F.col("b.token"))
            & (F.col("a.set_id") < F.col("b.set_id"))
            & (F.col("a.comp") != F.col("b.comp"))
            & self.close("a", "b"),
        )
        found = self.tables.write(pairs.select(F.col("a.set_id").alias("u"), F.col("b.set_id").alias("v")).distinct())
        self.tables.drop(members)
        # The set with more pairs is the pivot, so that fewer texts are sent.
        ends = found.select(F.explode(F.array("u", "v")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("k"))
        both = found.join(ends.select(F.col("x").alias("u"), F.col("k").alias("ku")), "u")
        both = both.join(ends.select(F.col("x").alias("v"), F.col("k").alias("kv")), "v")
        swap = F.col("ku") > F.col("kv")
        self.link(both.select(F.when(swap, F.col("v")).otherwise(F.col("u")).alias("u"), F.when(swap, F.col("u")).otherwise(F.col("v")).alias("v")))
        self.tables.drop(found)


def components(docs: DataFrame, words: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Words are lower-cased in A-Z and parted at ASCII white space; two documents link if the
    Jaccard similarity of their distinct shingles of ``words`` words is at least num / den;
    component_id is the least doc_id that links reach. Null and empty texts have no shingles and
    are components of their own. A row with a null doc_id joins documents with the same shingles and
    is linked with no other; rows with one doc_id are documents of their own. Other columns are
    ignored.
    """
    tables = Tables(docs.sparkSession)
    entries, labels = _labelled(tables, docs, words, num, den)
    least = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    by_set = labels.join(least, "component").select("set_id", "component_id")
    rows = entries.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    result = materialize(rows)
    tables.drop_all()
    return result


def _labelled(
    tables: Tables, docs: DataFrame, words: int, num: int, den: int, extra: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The entries, and of each set: set_id, first (its least doc_id) and component (a set_id)."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(shingle_counts(docs, words))
    entries = tables.write(_entries(docs, words, num, den, counts, extra))
    counts.destroy()
    full = entries.where("n > 0")
    tokens = full.select(F.explode("prefix").alias("token"))
    shared = tables.write(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token"))
    places = spark.sparkContext.broadcast(bit_array(shared, F.col("token")))
    # Copies made some tokens shared; what counts is two groups at least.
    placed = tables.write(_passing(full, places).join(shared, "token").distinct())
    places.destroy()
    tables.drop(shared)
    # The prefixes have been read; they are most of the entries.
    lean = tables.write(entries.drop("prefix"))
    tables.drop(entries)
    entries, full = lean, lean.where("n > 0")
    firsts = full.groupBy("set_id").agg(F.min("doc_id").alias("first"))
    index = tables.write(placed.join(_several(placed, "token", "group_id"), "token"))
    tables.drop(placed)
    wanted = index.select("group_id").unionByName(_several(full, "group_id", "set_id")).distinct()
    sets = full.select("set_id", "group_id", "n", "bitmap").join(wanted, "group_id").dropDuplicates(["set_id"])
    sets = tables.write(sets)
    close, close_index = _close_sets(tables, sets, index, num, den)
    tables.drop(sets, index)
    readers = tables.write(close.select("set_id").join(firsts, "set_id").where("first is not null"))
    join = _Join(tables, docs, readers, close, close_index, words, num, den)
    join.pivot_round()
    join.rest()
    tables.drop(readers, close, close_index)
    known = join.labels.select(F.col("node").alias("set_id"), "component")
    return entries, firsts.join(known, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))


def one_of_each(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The row of ``docs`` with the least doc_id of each component; rows without id stay.

    Rows with one doc_id and different texts are documents of their own. Ties go to the least set_id
    and then the least digest of the row, so only linked and equal rows are removed, always the same.
    Rows are told apart by their digest; only those whose digest may be a removed or repeated row's
    are exchanged.
    """
    digest = "arqueo_digest"
    # Nulls leave a hash as it is, so where they stand counts too.
    marked = docs.withColumn(digest, F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)))
    tables = Tables(docs.sparkSession)
    entries, labels = _labelled(tables, marked, words, num, den, (digest,))
    least = labels.where("first is not null").groupBy("component").agg(F.min(F.struct("first", "set_id")).alias("x"))
    least = least.select(F.col("x.first").alias("doc_id"), F.col("x.set_id").alias("set_id"))
    rows = entries.where("doc_id is not null").groupBy("doc_id", "set_id", digest).agg(F.count(F.lit(1)).alias("n"))
    best = rows.join(least, ["doc_id", "set_id"]).groupBy("doc_id", "set_id").agg(F.min(digest).alias("best"))
    # Of a set with the least id one row stays; rows without words are in no set and stay once.
    judged = rows.join(best, ["doc_id", "set_id"], "left").withColumn(
        "stays", F.col("set_id").isNull() | F.coalesce(F.col("best") == F.col(digest), F.lit(False))
    )
    touched = materialize(judged.where("not stays or n > 1").select(
        F.col("doc_id").alias("arqueo_id"), F.col(digest).alias("arqueo_touched"), F.col("stays").alias("arqueo_stays")
    ))
    tables.drop_all()
    likely, others = parted(marked, digest, bit_words(touched, F.col("arqueo_touched")))
    same = (F.col("doc_id") == F.col("arqueo_id")) & (F.col(digest) == F.col("arqueo_touched"))
    seen = likely.join(touched, same, "left")
    repeated = seen.where("arqueo_stays").dropDuplicates(["doc_id", digest])
    kept = [others, seen.where("arqueo_stays is null"), repeated]
    return reduce(DataFrame.unionByName, [x.select(docs.columns) for x in kept])
