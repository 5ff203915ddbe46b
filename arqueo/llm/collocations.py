"""Phrases whose words belong together, mined with suffix automata of shards.

Three passes count substrings of one word, of two, and of three and more. In each, a task builds
generalised suffix automata over shards of its texts, bounded in depth, and sends a row for each
state: its longest phrase, how short its phrases get, and the size of its end positions. Suffixes
are cut from these rows in Spark, and counts meet by phrase.

A phrase is only as frequent as its parts, so a pass needs no substring that holds a rarer part than
asked for. A bit table of the last pass's frequent phrases tells; it has no false negatives, and
counts are taken from the phrases themselves, so results are exact whatever its size.

A phrase that is contained in a longer one is contained in one that is longer by a word, and at
least as frequent; so subsumption needs a phrase's suffix link and its prefix only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arqueo.llm.common import Tables, bit_array, in_bits, materialize, texts
from arqueo.llm.hashing import IS_SPACE, LOWER, mix, windows, word_hashes

#: Bytes of text in a shard (one text at least).
SHARD_BYTES = 6 << 20
#: Places of a bit table for each frequent phrase, and the largest table (2 ** MAX_GATE_BITS places).
PLACES_EACH, MAX_GATE_BITS = 16, 28

IS_BREAK = np.zeros(256, bool)
IS_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
IS_PARTING = IS_BREAK | IS_SPACE


class SuffixAutomaton:
    """Generalised suffix automaton of a shard's pieces, of substrings of ``low`` to ``high`` words.

    Built a depth at a time: the places where equal substrings of k words end are one node of depth
    k, and the node of depth k - 1 that ends at the same places, or at more, is its suffix link. Equal
    numbers of places mean equal places, and both nodes are then one state.

    words: hashes; pieces: the number of the piece that holds each word, ascending; gate: a bit table
    of the substrings of low - 1 words that results may contain.
    """

    def __init__(self, words: np.ndarray, pieces: np.ndarray, low: int, high: int, gate: np.ndarray | None):
        self.depths: list[dict[str, np.ndarray]] = []
        n, span = len(words), max(low - 1, 1)
        allowed = np.ones(max(n - span + 1, 0), bool) if gate is None else in_bits(gate, windows(words, span).view(np.int64))
        node_at = None
        for k in range(low, high + 1):
            starts = max(n - k + 1, 0)
            fits = pieces[n - starts :] == pieces[:starts]
            for i in range(k - span + 1):
                fits &= allowed[i : i + starts]
            at = np.flatnonzero(fits)
            keys, first, node, counts = np.unique(windows(words, k)[at], return_index=True, return_inverse=True, return_counts=True)
            ends = at[first] + k - 1
            shortest = np.full(len(keys), k)
            if node_at is not None:
                below, link = self.depths[-1], node_at[ends]
                same = below["counts"][link] == counts
                shortest[same] = below["shortest"][link[same]]
                below["longest"][link[same]] = False
            self.depths.append({"keys": keys, "counts": counts, "ends": ends, "shortest": shortest, "longest": np.ones(len(keys), bool)})
            node_at = np.zeros(n, np.int64)
            node_at[at + k - 1] = node

    def states(self, low: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth, of the states whose longest phrase has so many words: its length, where it ends
        first, the fewest words of the state's phrases, the number of end places, and the hash."""
        for k, x in enumerate(self.depths, low):
            top = x["longest"]
            yield k, x["ends"][top], x["shortest"][top], x["counts"][top], x["keys"][top].view(np.int64)


class _Shard:
    """The texts of one language that a task has gathered."""

    def __init__(self, items: list[bytes]):
        # A line feed ends the last piece of each text.
        raw = LOWER[np.frombuffer(b"\n".join([*items, b""]), np.uint8)]
        self.starts, self.words = word_hashes(raw, is_space=IS_PARTING)
        self.pieces = np.cumsum(IS_BREAK[raw], dtype=np.int32)[self.starts]
        self.stops = np.flatnonzero(IS_PARTING[raw])
        self.text = raw.tobytes()

    def phrases(self, ends: np.ndarray, k: int) -> pa.Array:
        """The phrases of k words, one space between them, whose last words are at ``ends``."""
        at = np.add.outer(np.arange(1 - k, 1), ends)
        distinct, place = np.unique(self.starts[at.ravel()], return_inverse=True)
        stop = self.stops[np.searchsorted(self.stops, distinct)]
        words = pa.array([self.text[a:b] for a, b in zip(distinct.tolist(), stop.tolist(), strict=True)], pa.binary()).cast(pa.string())
        columns = [words.take(pa.array(p)) for p in place.reshape(at.shape)]
        return pc.binary_join_element_wise(*columns, " ") if k > 1 else columns[0]


def _cut(words: Column) -> Column:
    """The phrase's first words, so many, or its last where the number is negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), words)


def _counted(docs: DataFrame, low: int, high: int, gate) -> DataFrame:
    """lang, phrase, f, key of all phrases of low to high words that the gate lets pass.

    key: a hash by which bit tables know the phrase; it tells languages apart.
    """
    names = ["lang", "phrase", "shortest", "n", "key"]

    def states(lang: str, items: list[bytes]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(items)
        salt = mix(np.frombuffer(lang.encode().ljust(8, b"\0")[:8], np.uint64) ^ np.uint64(len(lang)))
        automaton = SuffixAutomaton(mix(shard.words ^ salt), shard.pieces, low, high, gate.value if gate is not None else None)
        for k, ends, shortest, counts, keys in automaton.states(low):
            for a in range(0, len(ends), 1 << 16):
                part = slice(a, a + (1 << 16))
                phrases = shard.phrases(ends[part], k)
                columns = [pa.array([lang] * len(phrases)), phrases, pa.array(shortest[part].astype(np.int32)), pa.array(counts[part].astype(np.int64)), pa.array(keys[part])]
                yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
                waiting.setdefault(lang, []).append(text)
                size += len(text) + 1
                if size >= SHARD_BYTES:
                    for x, items in waiting.items():
                        yield from states(x, items)
                    waiting, size = {}, 0
        for x, items in waiting.items():
            yield from states(x, items)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, "lang string, phrase string, shortest int, n bigint, key bigint")
    if high > low:
        size = F.size(F.split("phrase", " "))
        suffix = F.explode(F.transform(F.sequence("shortest", size), lambda k: _cut(-k)))
        rows = rows.select("lang", suffix.alias("phrase"), "n", F.lit(0).cast("bigint").alias("key"))
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.min("key").alias("key"))


def _gate(frequent: DataFrame):
    """A broadcast bit table of the frequent phrases, with PLACES_EACH places for each; of bounded size."""
    rows = max(frequent.count(), 64)
    size = min((rows * PLACES_EACH - 1).bit_length(), MAX_GATE_BITS)
    return frequent.sparkSession.sparkContext.broadcast(bit_array(frequent, F.col("key"), size))


def frequent_phrases(tables: Tables, docs: DataFrame, min_count: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, f of all phrases of up to max_words words found min_count times; lang, n."""
    words = tables.write(_counted(docs, 1, 1, None))
    sizes = tables.write(words.groupBy("lang").agg(F.sum("f").alias("n")))
    found = tables.write(words.where(F.col("f") >= min_count))
    tables.drop(words)
    parts = [found]
    for low, high in ((2, 2), (3, max_words)):
        if low > max_words:
            break
        gate = _gate(found)
        found = tables.write(_counted(docs, low, high, gate).where(F.col("f") >= min_count))
        gate.destroy()
        parts.append(found)
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    return every.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f"), sizes


def collocations(
    docs: DataFrame, min_count: int = 30, max_words: int = 4, covered: tuple[int, int] = (80, 100), scale: int = 2_000_000, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of ``docs`` (lang, text).

    A-Z become lower case; pieces end at .,;:!? and line ends, words at spaces and tabs. n counts a
    language's words, a a phrase's occurrences (min_count at least), l and r those of its first and
    last part at the cut with the lowest score floor(scale * a / (l + r)), of equal ones the first cut.
    Phrases are left out of which a longer one covers 80 of 100 occurrences (covered). Ranked by
    score, a (both descending) and phrase. Null texts are empty, null languages are "und", repeated
    rows count each time; languages without such phrases, and empty tables, give no rows. Other
    columns are ignored. Phrases in a shard are told apart by 64-bit hashes.
    """
    tables = Tables(docs.sparkSession)
    counts, sizes = frequent_phrases(tables, docs.select("lang", "text"), min_count, max_words)
    phrases = counts.where("words > 1")
    # A phrase and its suffix link, and the phrase and its prefix.
    longer = counts.where("words > 2")
    parts = F.explode(F.array(_cut(F.col("words") - 1), _cut(1 - F.col("words"))))
    above = longer.select("lang", parts.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    kept = phrases.join(above, ["lang", "phrase"], "left").where(
        F.col("above").isNull() | (F.col("above") * covered[1] < F.col("f") * covered[0])
    )
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _cut(F.col("k")).alias("head"), _cut(F.col("k") - F.col("words")).alias("tail")
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    score = F.call_function("div", F.col("a").cast("decimal(19,0)") * F.lit(scale).cast("decimal(19,0)"), (F.col("l").cast("decimal(20,0)") + F.col("r")).cast("decimal(21,0)"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score.cast(wide))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    rows = lowest.select("lang", "phrase", "a", "x.l", "x.r", F.col("x.score").cast("bigint").alias("score")).join(sizes, "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = rows.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= top)
    result = materialize(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    tables.drop_all()
    return result
