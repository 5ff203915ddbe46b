"""Column statistics that merge: a row of sketches for each part, from which any set of parts is answered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct-count sketch: 2 ** LG_K of them estimate within 2 % in 95 of 100 cases.
LG_K = 14
#: Size of a quantile sketch: ranks are within about 1 % in 99 of 100 cases.
QUANTILE_K = 400


def sketched(df: DataFrame, parts: list[str], columns: list[str]) -> DataFrame:
    """The part's columns, column_name, row_count, nulls, distinct_sketch and quantile_sketch (null for texts).

    One pass whatever the number of columns; a sketch has a bounded size, so what is stored and exchanged
    grows with parts and columns, never with rows.
    """
    kinds = dict(df.dtypes)
    metrics = []
    for i, c in enumerate(columns):
        numeric = kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds[c].startswith("decimal")
        text = F.col(c).cast("string")
        quantiles = F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_K) if numeric else F.lit(None).cast("binary")
        metrics += [
            F.count(F.lit(1)).alias(f"rows_{i}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"),
            F.hll_sketch_agg(text, F.lit(LG_K)).alias(f"distinct_{i}"), (quantiles if numeric else F.first(quantiles)).alias(f"quantile_{i}"),
        ]
    wide = df.groupBy(*parts).agg(*metrics)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"rows_{i}").alias("row_count"), F.col(f"nulls_{i}").alias("nulls"), F.col(f"distinct_{i}").alias("distinct_sketch"), F.col(f"quantile_{i}").alias("quantile_sketch"))
        for i, c in enumerate(columns)
    ])
    return wide.select(*parts, F.inline(rows))


def merged(sketches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sketches of several parts as one for each of the ``keys`` (none: all parts) and column, to be stored or asked."""
    return sketches.groupBy(*(keys or []), "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def answers(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """null_percent, distinct_values (estimated) and quantiles (an array, null for texts and where all values are null)."""
    others = [c for c in sketches.columns if c not in ("distinct_sketch", "quantile_sketch")]
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    some = F.col("quantile_sketch").isNotNull() & (F.kll_sketch_get_n_double("quantile_sketch") > 0)
    return sketches.select(
        *others,
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("row_count")), 4).alias("null_percent"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", asked)).alias("quantiles"),
    )
