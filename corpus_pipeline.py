"""A corpus pipeline of five stages; each is one operator of arqueo.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Between stages the documents are
written to the session's shared folder and read again. All stages but the last return the columns
of documents; the last returns the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arqueo.llm import bpe, decontaminate, jaccard_join, quality_classifier, quality_rules
from arqueo.llm.common import Tables, table
from arqueo.llm.queries import RANKS


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """The rows of ``docs`` that meet a condition on what ``judge`` adds, whatever their columns' names."""
    own = docs.toDF(*[c if c in ("doc_id", "text") else f"own_{i}" for i, c in enumerate(docs.columns)])
    return judge(own).where(condition).select(own.columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the compression classifier takes for good ones."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return _kept(docs, lambda own: quality_classifier.score(own, model), "predicted = 1")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the weakly supervised rules keep."""
    return _kept(docs, quality_rules.judge, "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingle similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, words=5, num=4, den=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item (4/5 of its five-word shingles)."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each document."""
    keep = ["doc_id", "lang", "source"]
    coded = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep)
    return coded.select(*keep, F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: Classification, weak supervision and tokenizing are beyond SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; a stage's input goes once its output is written."""
    docs, tables, before = table(spark, sf_dir, "documents"), Tables(spark), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = tables.write(docs)
            if before is not None:
                tables.drop(before)
            before = docs
    return docs
