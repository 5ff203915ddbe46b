"""Reconciliation of totals between layers, exact and without tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.contracts import TOTAL


def totals_by(df: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """One row for each key with exact totals of all measures."""
    return df.groupBy(key).agg(*[F.sum(c).cast(TOTAL).alias(c) for c in measures])


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def compare_totals(expected: DataFrame, actual: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """key, measure, expected, actual, difference, exact_match of every measure and key of either side."""
    a = unpivot(totals_by(expected, key, measures), [key], measures, "measure", "expected")
    b = unpivot(totals_by(actual, key, measures), [key], measures, "measure", "actual")
    return a.join(b, [key, "measure"], "full").select(
        key, "measure", "expected", "actual",
        (F.col("actual") - F.col("expected")).cast(TOTAL).alias("difference"),
        F.col("expected").eqNullSafe(F.col("actual")).alias("exact_match"),
    )


def summarise(compared: DataFrame, key: str) -> DataFrame:
    """By key: checks, exact ones, failed ones and the largest difference."""
    return compared.groupBy(key).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("exact_match").alias("exact"),
        F.count_if(~F.col("exact_match")).alias("failed"),
        F.coalesce(F.max(F.abs("difference")), F.lit(0)).cast(TOTAL).alias("max_difference"),
    )


def require_exact(compared: DataFrame) -> None:
    """Raise if any total differs; at most ten are named."""
    bad = compared.where(~F.col("exact_match")).limit(10).collect()
    if bad:
        raise ValueError(f"totals differ: {[tuple(r) for r in bad]}")
