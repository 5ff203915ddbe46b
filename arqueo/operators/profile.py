"""Profiling: null counts, coverage by month, column statistics, schema comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from arqueo.contracts import MONTHS
from arqueo.functions.exprs import any_null


@dataclass(frozen=True)
class Control:
    """A control as aggregates that one pass computes, and what makes its result of their one row.

    So a control can be asked of a table, or observed on rows that are on their way elsewhere.
    """

    aggregates: list[Column]
    finish: Callable[[DataFrame], DataFrame]

    def of(self, df: DataFrame) -> DataFrame:
        return self.finish(df.agg(*self.aggregates))


def observed(df: DataFrame, controls: dict[str, Control]) -> tuple[DataFrame, Callable[[], dict[str, DataFrame]]]:
    """``df`` with controls that look at its rows as they pass, and what gives their results after an action.

    Rows of stages that run again after a loss are seen again; see :func:`arqueo.operators.consolidate.load`.
    """
    seen = Observation()
    whole = [F.struct(*c.aggregates).alias(f"control_{i}") for i, c in enumerate(controls.values())]
    schemas = [df.agg(*c.aggregates).schema for c in controls.values()]

    def results() -> dict[str, DataFrame]:
        found = seen.get
        rows = [df.sparkSession.createDataFrame([tuple(found[f"control_{i}"])], schema) for i, schema in enumerate(schemas)]
        return {name: c.finish(row) for (name, c), row in zip(controls.items(), rows, strict=True)}

    return df.observe(seen, *whole), results


def tidy_control(metrics: dict[str, dict[str, Column]], label: str = "column_name") -> Control:
    """One row for each entry of ``metrics``: a label and its values."""
    names = list(next(iter(metrics.values())))
    rows = F.array(
        *[F.struct(F.lit(k).alias(label), *[F.col(f"{i}_{m}").alias(m) for m in names]) for i, k in enumerate(metrics)]
    )
    wide = [c.alias(f"{i}_{m}") for i, (_, own) in enumerate(metrics.items()) for m, c in own.items()]
    return Control(wide, lambda row: row.select(F.inline(rows)))


def _tidy(df: DataFrame, metrics: dict[str, dict[str, Column]], label: str = "column_name") -> DataFrame:
    return tidy_control(metrics, label).of(df)


def null_control(columns: list[str], digits: int = 8) -> Control:
    """column_name, row_count, null_count, null_rate (null for an empty table)."""
    counted = tidy_control({c: {"row_count": F.count(F.lit(1)), "null_count": F.count_if(F.col(c).isNull())} for c in columns})
    rate = F.bround(F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double")), digits)
    return Control(counted.aggregates, lambda row: counted.finish(row).withColumn("null_rate", rate))


def null_counts(df: DataFrame, columns: list[str] | None = None, digits: int = 8) -> DataFrame:
    """:func:`null_control` of all columns or some."""
    return null_control(columns or df.columns, digits).of(df)


def rows_with_any_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count_if(any_null(columns)).alias("rows_with_null"))


def monthly_coverage(df: DataFrame, months: list[str], labels: Iterable[str] = MONTHS) -> DataFrame:
    """month_number, month, non_null, nulls, zeros, non_zero of each monthly column in calendar order."""
    metrics = {}
    for i, (c, name) in enumerate(zip(months, labels, strict=False), 1):
        metrics[c] = {
            "month_number": F.lit(i),
            "month": F.first(F.lit(name)),
            "non_null": F.count(c),
            "nulls": F.count_if(F.col(c).isNull()),
            "zeros": F.count_if(F.col(c) == 0),
            "non_zero": F.count_if(F.col(c) != 0),
        }
        metrics[c]["month_number"] = F.first(F.lit(i))
    return _tidy(df, metrics).drop("column_name")


def last_populated_month(coverage: DataFrame) -> DataFrame:
    """The last month with an amount other than zero, and how many have one; null and 0 if none."""
    some = F.col("non_zero") > 0
    return coverage.agg(
        F.max(F.when(some, F.col("month_number"))).alias("month_number"),
        F.max_by("month", F.when(some, F.col("month_number"))).alias("month"),
        F.count_if(some).alias("populated_months"),
    )


def column_statistics(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """column_name, null_percent, distinct_values, average_bytes, of columns that are no measures.

    Exact distinct counts take a shuffle for each column; ``approximate`` counts in the one pass.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    metrics = {
        c: {
            "null_percent": F.round(F.count_if(F.col(c).isNull()).cast("double") * 100 / F.count(F.lit(1)), 4),
            "distinct_values": count(F.col(c)),
            "average_bytes": F.round(F.avg(F.octet_length(F.col(c).cast("string"))), 4),
        }
        for c in columns
    }
    return _tidy(df, metrics)


def schema_table(schemas: dict[str, list[str]], spark: SparkSession) -> DataFrame:
    rows = [(s, i, c) for s, columns in schemas.items() for i, c in enumerate(columns, 1)]
    return spark.createDataFrame(rows, "source string, position int, column_name string")


def schema_comparison(columns: DataFrame, base: str) -> DataFrame:
    """Each source against ``base``: same_count, same_names, same_order, missing, additional.

    ``columns`` has source, position, column_name.
    """
    ref = columns.where(F.col("source") == base)
    pairs = columns.select("source").distinct().crossJoin(F.broadcast(ref.select(F.col("column_name"), F.col("position").alias("base_position"))))
    both = pairs.join(columns, ["source", "column_name"], "full")
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("column_name")))), ",")
    return both.groupBy("source").agg(
        (F.count("position") == F.count("base_position")).alias("same_count"),
        (F.count_if(F.col("position").isNull() | F.col("base_position").isNull()) == 0).alias("same_names"),
        (F.count_if(~F.col("position").eqNullSafe(F.col("base_position"))) == 0).alias("same_order"),
        listed(F.col("position").isNull()).alias("missing"),
        listed(F.col("base_position").isNull()).alias("additional"),
    )


def classify_columns(columns: DataFrame, stem: str = "devengado") -> DataFrame:
    """column_name, class (monthly, annual, other) and month_number of columns that hold ``stem``."""
    name = F.lower("column_name")
    month = F.array_position(F.array(*[F.lit(f"monto_{stem}_{m}") for m in MONTHS]), name).cast("int")
    kind = F.when(month > 0, "monthly").when(name == f"monto_{stem}_anual", "annual").otherwise("other")
    return columns.where(name.contains(stem)).select(
        "column_name", kind.alias("class"), F.when(month > 0, month).alias("month_number")
    )


def measure_catalog(df: DataFrame, prefix: str = "monto_", counted: bool = False) -> DataFrame:
    """position, column_name, data_type of the columns whose name starts with ``prefix``; if counted, also
    the non_null and non_zero values of each, from one pass."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1) if f.name.lower().startswith(prefix)]
    listed = df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")
    if not counted or not rows:
        return listed
    found = _tidy(df, {c: {"non_null": F.count(F.col(c)), "non_zero": F.count_if(F.col(c) != 0)} for _, c, _ in rows})
    return listed.join(found, "column_name").select("position", "column_name", "data_type", "non_null", "non_zero")


def compare_names(left: DataFrame, right: DataFrame, column: str = "column_name") -> DataFrame:
    """Names that only one side has: side ('left' or 'right') and the name."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("side", F.lit("left")).unionByName(
        b.join(a, column, "left_anti").withColumn("side", F.lit("right"))
    )


def name_review(documented: DataFrame, present: DataFrame, column: str = "column_name") -> DataFrame:
    """column_name, status of every name on either side: documented, undocumented or dictionary_only."""
    a = documented.select(F.col(column)).distinct().withColumn("_d", F.lit(True))
    b = present.select(F.col(column)).distinct().withColumn("_p", F.lit(True))
    status = F.when(F.col("_d").isNull(), "undocumented").when(F.col("_p").isNull(), "dictionary_only").otherwise("documented")
    return a.join(b, column, "full").select(column, status.alias("status"))


def dictionary_review(documented: DataFrame, present: DataFrame, found_hash: str, expected_hash: str, column: str = "column_name") -> DataFrame:
    """One row: documented, undocumented and dictionary_only names, hash_matches and exact_schema_match."""
    counted = name_review(documented, present, column).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("documented", "undocumented", "dictionary_only")]
    )
    exact = (F.col("undocumented") == 0) & (F.col("dictionary_only") == 0)
    return counted.select("*", F.lit(found_hash == expected_hash).alias("hash_matches"), exact.alias("exact_schema_match"))


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows in a total order."""
    return df.orderBy(*order).limit(k)


def first_per_group(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each group in a total order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


