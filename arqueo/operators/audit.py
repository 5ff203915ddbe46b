"""Exact audit of amounts as written: totals in cents, extra digits, rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arqueo.contracts import TOTAL
from arqueo.functions.exprs import WIDEST, extra_digits_of, is_empty, number_text, rounding_of


def unpivoted(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """column_name, value and the kept columns: a row for each amount text.

    So that a text is parsed by one expression however many columns there are; one expression for
    each column makes more code than the JVM compiles.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs))


def _spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the input is smaller than a split for each: a small file may be one
    split, and a row's texts are as much work as many rows. Larger inputs have splits enough and stay."""
    spark = df.sparkSession
    cores, split = spark.sparkContext.defaultParallelism, 128 << 20
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split else df


def _judged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`unpivoted` with amount, extra_digits, rounded and invalid; a number's text is found once."""
    found = rows.withColumn("number", number_text("value")).withColumn("amount", F.col("number").try_cast(WIDEST))
    return found.select(
        *rows.columns, "amount", extra_digits_of(F.col("number")).alias("extra_digits"), rounding_of(F.col("number")).alias("rounded"),
        (F.col("amount").isNull() & ~is_empty("value")).alias("invalid"),
    )


def audit(df: DataFrame, columns: list[str], expected: int | None = None) -> DataFrame:
    """column_name, total, extra_digits, rounded, invalid of each column of amount texts.

    Invalid are texts that are no numbers, or have more than 34 digits before the point; they are not
    in the total, and have no extra digits but for numbers. With ``expected``, another number of
    columns is an error.
    """
    _require(columns, expected)
    return audit_texts(unpivoted(_spread(df.select(*columns)), columns), columns)


def _require(columns: list[str], expected: int | None) -> None:
    if expected is not None and len(columns) != expected:
        raise ValueError(f"{expected} amount columns are needed, found {len(columns)}")


def audit_texts(rows: DataFrame, columns: list[str], expected: int | None = None) -> DataFrame:
    """:func:`audit` of rows that are a column_name and a value each, as :func:`unpivoted` gives them."""
    _require(columns, expected)
    names = rows.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    summed = _judged(rows).groupBy("column_name").agg(
        F.sum("amount").cast(TOTAL).alias("total"), F.count_if("extra_digits").alias("extra_digits"),
        F.count_if("rounded").alias("rounded"), F.count_if("invalid").alias("invalid"),
    )
    filled = names.join(summed, "column_name", "left").na.fill(0, ["extra_digits", "rounded", "invalid"])
    total = F.coalesce(F.col("total"), F.lit(0).cast(TOTAL)).cast("string")
    return filled.select("column_name", total.alias("total"), "extra_digits", "rounded", "invalid")


def rounding_samples(df: DataFrame, columns: list[str], row_number: str, n: int = 5) -> DataFrame:
    """column_name, row_number, value, place: the first n values of each column that need rounding, from one scan."""
    rows = _judged(unpivoted(df, columns, (row_number,))).where("rounded")
    place = F.row_number().over(Window.partitionBy("column_name").orderBy(row_number, "value"))
    found = rows.withColumn("place", place.cast("bigint")).where(F.col("place") <= n)
    return found.select("column_name", F.col(row_number).alias("row_number"), "value", "place")
