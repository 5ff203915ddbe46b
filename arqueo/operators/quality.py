"""Contextual quality controls; each is one aggregation over the table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arqueo.contracts import AMOUNT, BLANK_RULES, BlankRule
from arqueo.functions.exprs import is_bad_amount, is_blank, number_text
from arqueo.operators.profile import Control, null_control, tidy_control


def blank_status(unexpected: Column, structural: Column) -> Column:
    return F.when(unexpected > 0, "warning").when(structural > 0, "informational").otherwise("passed")


def reconciliation_status(mismatched: Column, not_evaluated: Column) -> Column:
    return F.when(mismatched > 0, "failed").when(not_evaluated > 0, "warning").otherwise("passed")


def blank_control(available: list[str], columns: list[str], rules: tuple[BlankRule, ...] = BLANK_RULES) -> Control:
    """column_name, blanks, structural, unexpected, status of each text column.

    A blank is structural where a rule for its column holds; where the rule's context column is not
    ``available``, no blank is.
    """
    present = {c.lower(): c for c in available}
    metrics = {}
    for c in columns:
        excused = F.lit(False)
        for rule in rules:
            if c.lower() in rule.columns and rule.context in present:
                excused = excused | (F.trim(F.col(present[rule.context]).cast("string")).eqNullSafe(rule.value))
        blank = is_blank(c)
        metrics[c] = {"blanks": F.count_if(blank), "structural": F.count_if(blank & excused)}
    counted = tidy_control(metrics)
    left = F.col("blanks") - F.col("structural")
    status = blank_status(F.col("unexpected"), F.col("structural"))
    return Control(counted.aggregates, lambda row: counted.finish(row).withColumn("unexpected", left).withColumn("status", status))


def blank_counts(df: DataFrame, columns: list[str], rules: tuple[BlankRule, ...] = BLANK_RULES) -> DataFrame:
    return blank_control(df.columns, columns, rules).of(df)


def year_check(column: str, year: int) -> Control:
    """Nulls, unreadable and other years of a column, the years seen (sorted as text), and the status."""
    value = F.col(column).cast("string").try_cast("int")
    aggregates = [
        F.count_if(F.col(column).isNull()).alias("nulls"),
        F.count_if(F.col(column).isNotNull() & value.isNull()).alias("parse_errors"),
        F.count_if(value != year).alias("mismatches"),
        F.array_join(F.array_sort(F.collect_set(value.cast("string"))), ",").alias("years"),
    ]
    bad = F.col("nulls") + F.col("parse_errors") + F.col("mismatches")
    return Control(aggregates, lambda row: row.withColumn("status", F.when(bad == 0, "passed").otherwise("failed")))


def year_control(df: DataFrame, column: str, year: int) -> DataFrame:
    return year_check(column, year).of(df)


def parse_control(columns: list[str]) -> Control:
    """column_name, parse_errors: texts that are no amounts."""
    return tidy_control({c: {"parse_errors": F.count_if(is_bad_amount(c))} for c in columns})


def amount_parse_errors(df: DataFrame, columns: list[str]) -> DataFrame:
    return parse_control(columns).of(df)


def negative_control(columns: list[str], amount: Callable[[str], Column] = F.col) -> Control:
    """column_name, negatives, status. Negative amounts are reported and never changed. ``amount``: how a
    column is read, for texts."""
    counted = tidy_control({c: {"negatives": F.count_if(amount(c) < 0)} for c in columns})
    status = F.when(F.col("negatives") > 0, "warning").otherwise("passed")
    return Control(counted.aggregates, lambda row: counted.finish(row).withColumn("status", status))


def negative_amounts(df: DataFrame, columns: list[str]) -> DataFrame:
    return negative_control(columns).of(df)


def annual_control(months: list[str], annual: str, tolerance: str = "0.01", amount: Callable[[str], Column] = F.col) -> Control:
    """Rows whose months add up to the annual amount: matches, mismatches, not_evaluated, largest difference.

    A row is evaluated if all of its amounts are there.
    """
    if len(months) != 12:
        raise ValueError(f"12 monthly columns are needed, found {len(months)}")
    apart = F.abs(reduce(lambda x, y: x + y, (amount(m) for m in months)) - amount(annual))
    limit = F.lit(tolerance).cast("decimal(38,6)")
    aggregates = [
        F.count_if(apart <= limit).alias("matches"),
        F.count_if(apart > limit).alias("mismatches"),
        F.count_if(apart.isNull()).alias("not_evaluated"),
        F.coalesce(F.max(apart), F.lit(0)).cast("decimal(38,2)").alias("max_difference"),
    ]
    status = reconciliation_status(F.col("mismatches"), F.col("not_evaluated"))
    return Control(aggregates, lambda row: row.withColumn("status", status))


def annual_reconciliation(df: DataFrame, months: list[str], annual: str, tolerance: str = "0.01") -> DataFrame:
    return annual_control(months, annual, tolerance).of(df)


def text_amount(c: str) -> Column:
    """The amount of a text as it is written; null if it is blank or no number."""
    return number_text(c).try_cast(AMOUNT)


def controls_of(columns: list[str], measures: list[str], year: tuple[str, int] | None = None, months: list[str] | None = None, annual: str | None = None, tolerance: str = "0.01") -> dict[str, Control]:
    """All controls of a table of texts as one set, for one pass: nulls, blanks and, where there are such
    columns, amounts, negatives, year and reconciliation."""
    out = {"nulls": null_control(columns), "blanks": blank_control(columns, [c for c in columns if c not in measures])}
    if measures:
        out |= {"amounts": parse_control(measures), "negatives": negative_control(measures, text_amount)}
    if year:
        out["year"] = year_check(*year)
    if months and annual:
        out["reconciliation"] = annual_control(months, annual, tolerance, text_amount)
    return out


def quality_summary(
    year: DataFrame, reconciliation: DataFrame, nulls: DataFrame, blanks: DataFrame, errors: DataFrame, negatives: DataFrame
) -> DataFrame:
    """One row: critical_failed, critical_passed, warnings, informational, from the controls' results.

    Every input has one row, or a few for its columns, so the cross joins are of single rows.
    """
    one = year.select(F.col("status").alias("y"))
    one = one.crossJoin(reconciliation.select(F.col("status").alias("r")))
    one = one.crossJoin(nulls.agg(F.sum("null_count").alias("n")))
    one = one.crossJoin(blanks.agg(F.sum("unexpected").alias("u"), F.sum("structural").alias("s")))
    one = one.crossJoin(errors.agg(F.sum("parse_errors").alias("e")))
    one = one.crossJoin(negatives.agg(F.sum("negatives").alias("g")))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    failed = flag(F.col("y") == "failed") + flag(F.col("r") == "failed")
    blank = blank_status(F.col("u"), F.col("s"))
    return one.select(
        failed.alias("critical_failed"),
        (2 - failed).alias("critical_passed"),
        (
            flag(F.col("r") == "warning") + flag(F.col("n") > 0) + flag(blank == "warning")
            + flag(F.col("e") > 0) + flag(F.col("g") > 0)
        ).alias("warnings"),
        flag(F.col("s") > 0).alias("informational"),
    )
