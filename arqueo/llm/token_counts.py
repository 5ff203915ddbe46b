"""Token counts as an exact histogram of encoded lengths.

Documents are aggregated by their encoded length. Suffix sums over the lengths then answer, for
any context limit: how many documents reach it, how many tokens they hold, and what is left when
every document is cut at the limit. The sums run inside blocks of lengths and over the blocks'
totals, whose number depends on the longest document only, so no task sees all lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arqueo.llm.bpe import codec
from arqueo.llm.common import map_texts

BLOCK = 256


def lengths(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """n_tokens of each row's whole text; null and empty texts have 0."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        got = [len(bpe.encode(t or "")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64())], ["n_tokens"])

    return map_texts(docs.select("text"), "n_tokens bigint", run)


def histogram(counted: DataFrame) -> DataFrame:
    """n_tokens, n_docs: one row for each length that occurs."""
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def by_limit(hist: DataFrame) -> DataFrame:
    """A row for each occurring length, taken as a context limit.

    docs_at_least and tokens_at_least: documents that reach it and all their tokens.
    truncated_tokens: the corpus's tokens with every document cut at it. share_at_most: share of
    documents no longer than it, from which quantiles follow. An empty histogram gives no rows.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    own = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), block.alias("block"))
    totals = own.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("toks"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = totals.select(
        F.col("block").alias("of"),
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("toks").over(later), F.lit(0)).alias("toks_later"),
        F.sum("docs").over(whole).alias("all_docs"),
        F.sum("toks").over(whole).alias("all_toks"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    docs = F.sum("n_docs").over(inside) + F.col("docs_later")
    toks = F.sum("tokens").over(inside) + F.col("toks_later")
    return own.join(totals, own["block"] == totals["of"]).select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        toks.alias("tokens_at_least"),
        (F.col("all_toks") - toks + docs * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("all_docs") - docs + F.col("n_docs")) / F.col("all_docs")).alias("share_at_most"),
    )


def truncated_total(limits: DataFrame, limit: int) -> DataFrame:
    """One row: the corpus's tokens with every document cut at ``limit`` (any number)."""
    at = limits.where(F.col("n_tokens") >= limit).agg(
        F.max("docs_at_least").alias("d"), F.max("tokens_at_least").alias("t")
    )
    total = limits.agg(F.max("tokens_at_least").alias("all"))
    return total.crossJoin(at).select(
        F.coalesce(F.col("all") - F.coalesce("t", F.lit(0)) + limit * F.coalesce("d", F.lit(0)), F.lit(0)).alias("tokens")
    )


def quantile(limits: DataFrame, q: float) -> DataFrame:
    """One row: the least length that at least a share ``q`` of the documents does not exceed."""
    return limits.where(F.col("share_at_most") >= q).agg(F.min("n_tokens").alias("n_tokens"))
