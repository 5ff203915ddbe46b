"""Marts: execution indicators as DataFrames.

Facts have year, month, a few descriptive columns and the amounts budget, committed and accrued.
Ratios are ratios of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arqueo.contracts import TOTAL
from arqueo.functions.exprs import safe_ratio

AMOUNTS = ("budget", "committed", "accrued")


def total(c: str) -> Column:
    return F.sum(c).cast(TOTAL)


def amounts_by(df: DataFrame, keys: list[str], amounts=AMOUNTS) -> DataFrame:
    return df.groupBy(*keys).agg(*[total(a).alias(a) for a in amounts])


def with_execution(df: DataFrame) -> DataFrame:
    """execution_ratio (accrued / budget) and balance (budget - accrued)."""
    return df.withColumn("execution_ratio", safe_ratio("accrued", "budget")).withColumn(
        "balance", (F.col("budget") - F.col("accrued")).cast(TOTAL)
    )


def execution_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return with_execution(amounts_by(df, keys, ("budget", "accrued")))


def funnel(df: DataFrame, key: str) -> DataFrame:
    """key, stage, amount and its share of the budget."""
    wide = amounts_by(df, [key]).withColumn("whole", F.col("budget"))
    long = wide.unpivot([key, "whole"], list(AMOUNTS), "stage", "amount")
    return long.select(key, "stage", "amount", safe_ratio("amount", "whole").alias("share_of_budget"))


def top_entities(df: DataFrame, keys: list[str], by: str, k: int) -> DataFrame:
    """The k entities with the most budget or balance; ties in order of the keys."""
    return execution_by(df, keys).orderBy(F.desc(by), *keys).limit(k)


def share_of_total(df: DataFrame, key: str, amount: str = "budget") -> DataFrame:
    """key, amount and its share of all. The total is one row, so no window over all rows is needed."""
    by = amounts_by(df, [key], (amount,))
    whole = df.agg(total(amount).alias("whole"))
    return by.crossJoin(whole).select(key, amount, safe_ratio(amount, "whole").alias("share"))


def drill_down(df: DataFrame, levels: list[str]) -> DataFrame:
    """Amounts of every level of a hierarchy, by rollup; level counts the columns that are summed over."""
    rolled = df.rollup(*levels).agg(
        F.grouping_id().cast("bigint").alias("level"), total("budget").alias("budget"), total("accrued").alias("accrued")
    )
    return with_execution(rolled)


def sliced(df: DataFrame, **filters) -> DataFrame:
    """Rows in the chosen slices; None leaves a column open, a list takes any of its values."""
    for column, value in filters.items():
        if value is not None:
            df = df.where(F.col(column).isin(value) if isinstance(value, list) else F.col(column) == value)
    return df


def monthly_wide(df: DataFrame, keys: list[str], amount: str = "accrued") -> DataFrame:
    """Twelve monthly columns m1..m12 and annual; months without rows are 0."""
    months = [F.coalesce(F.sum(F.when(F.col("month") == m, F.col(amount))), F.lit(0)).cast(TOTAL).alias(f"m{m}") for m in range(1, 13)]
    return df.groupBy(*keys).agg(*months, total(amount).alias("annual"))


def monthly_long(wide: DataFrame, keys: list[str]) -> DataFrame:
    """The monthly columns as rows: keys, month, amount."""
    pairs = ", ".join(f"{m}, m{m}" for m in range(1, 13))
    return wide.selectExpr(*keys, f"stack(12, {pairs}) as (month, amount)")


def cumulative(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Running total within the keys (with the year among them) by month."""
    so_far = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("cumulative", F.sum("amount").over(so_far).cast(TOTAL))


def year_to_date(monthly: DataFrame, last_month: int, keys: list[str]) -> DataFrame:
    """Amounts of every year up to the same month, and the ratio to the year before."""
    by = monthly.where(F.col("month") <= last_month).groupBy(*keys, "year").agg(total("amount").alias("ytd"))
    return year_over_year(by, keys, "ytd")


def year_over_year(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """previous and change ratio against the year before; null where there is none."""
    order = Window.partitionBy(*keys).orderBy("year")
    previous = F.when(F.lag("year").over(order) == F.col("year") - 1, F.lag(amount).over(order))
    ratio = F.round(F.try_divide((F.col(amount) - F.col("previous")).cast("double"), F.col("previous").cast("double")), 6)
    return df.withColumn("previous", previous).withColumn("change", ratio)


def ranks(df: DataFrame, within: str, entity: str, amount: str) -> DataFrame:
    """rank of each entity within a year, and how it moved since the year before."""
    place = F.rank().over(Window.partitionBy(within).orderBy(F.desc(amount))).cast("bigint")
    ranked = df.withColumn("rank", place)
    order = Window.partitionBy(entity).orderBy(within)
    return ranked.withColumn("moved", F.lag("rank").over(order) - F.col("rank"))


def year_end_share(monthly: DataFrame, keys: list[str], first_month: int = 11) -> DataFrame:
    """Share of a year's amount that falls into its last months."""
    late = F.sum(F.when(F.col("month") >= first_month, F.col("amount")).otherwise(0))
    by = monthly.groupBy(*keys).agg(late.cast(TOTAL).alias("late"), total("amount").alias("annual"))
    return by.withColumn("share", safe_ratio("late", "annual"))


def or_message(df: DataFrame, message: str) -> DataFrame:
    """``df`` with a column ``message``, null in its rows; a selection without rows gives one row that says so."""
    rows = df.withColumn("message", F.lit(None).cast("string"))
    found = df.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    nothing = found.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields], F.lit(message).alias("message"))
    return rows.unionByName(nothing)
