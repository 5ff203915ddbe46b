"""Consolidation to a declared grain, with exact totals."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from arqueo.contracts import AMOUNT, TOTAL, require_columns
from arqueo.functions.exprs import clean_text, is_bad_amount, parse_amount
from arqueo.operators.audit import unpivoted
from arqueo.operators.profile import Control, _tidy, observed
from arqueo.sources.storage import remove_shared, write_shared_at


@dataclass(frozen=True)
class Grain:
    """A key, the measures to add up; all other columns are attributes that the key determines."""

    key: tuple[str, ...]
    measures: tuple[str, ...]

    def attributes(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c not in self.key and c not in self.measures]


def normalise(df: DataFrame, grain: Grain) -> DataFrame:
    """Texts cleaned, text measures parsed; numbers keep their exact value. Bad amounts become null."""
    require_columns(df.columns, (*grain.key, *grain.measures))
    kinds = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in grain.measures:
            amount = parse_amount(c) if kinds[c] == "string" else F.coalesce(F.col(c).cast(AMOUNT), F.lit(0).cast(AMOUNT))
            out.append(amount.alias(c))
        else:
            out.append(clean_text(c).alias(c) if kinds[c] == "string" else F.col(c))
    return df.select(*out)


def bad_amounts(df: DataFrame, grain: Grain) -> DataFrame:
    """column_name, invalid: texts of measures that are no amounts, of the columns that have some."""
    rows = unpivoted(df, list(grain.measures)).where(is_bad_amount("value"))
    return rows.groupBy("column_name").agg(F.count(F.lit(1)).alias("invalid"))


def unique_rows(normalised: DataFrame, row_number: str | None = None) -> DataFrame:
    """Without exact repeats; nulls equal nulls. With ``row_number`` each row has the first of its repeats' numbers."""
    if row_number is None:
        return normalised.dropDuplicates()
    others = [c for c in normalised.columns if c != row_number]
    return normalised.groupBy(*others).agg(F.min(row_number).alias(row_number))


def inconsistent_attributes(unique: DataFrame, grain: Grain) -> DataFrame:
    """attribute, keys: how many keys have more than one value of an attribute; null is a value."""
    attributes = grain.attributes(unique.columns)
    grouped = unique.groupBy(*grain.key).agg(*[_torn(c).alias(c) for c in attributes])
    return _tidy(grouped, {c: {"inconsistent_keys": F.count_if(F.col(c))} for c in attributes}, "attribute")


def _torn(attribute: str) -> Column:
    return F.min(F.struct(attribute)) != F.max(F.struct(attribute))


def _merged(grain: Grain, columns: list[str], row_number: str | None) -> list[Column]:
    """What a key's rows become: attributes, exact sums, rows_merged, and the first row number if there is one."""
    attributes = grain.attributes([c for c in columns if c != row_number])
    return [
        *[F.min_by(c, F.struct(F.col(c).isNull(), F.col(c))).alias(c) for c in attributes],
        *[F.sum(c).cast(TOTAL).alias(c) for c in grain.measures],
        F.count(F.lit(1)).alias("rows_merged"),
        *([F.min(row_number).alias(row_number)] if row_number else []),
    ]


def consolidate(unique: DataFrame, grain: Grain, row_number: str | None = None) -> DataFrame:
    """A row for each key: attributes, exact sums of the measures, and rows_merged; the first of
    the rows' numbers too if a column has them."""
    return unique.groupBy(*grain.key).agg(*_merged(grain, unique.columns, row_number))


def totals(df: DataFrame, measures: tuple[str, ...] | list[str]) -> DataFrame:
    """measure, total as exact decimals."""
    return _tidy(df, {c: {"total": F.coalesce(F.sum(F.col(c).cast(AMOUNT)), F.lit(0)).cast(TOTAL)} for c in measures}, "measure")


def totals_check(before: DataFrame, after: DataFrame, measures, tolerance: str = "0.01") -> DataFrame:
    """measure, before, after, difference, preserved. ``before`` counts exact repeats as well: a
    repeat that carries money is an error of the source, which this check shows."""
    a = totals(before, measures).withColumnRenamed("total", "before")
    b = totals(after, measures).withColumnRenamed("total", "after")
    apart = (F.col("after") - F.col("before")).cast(TOTAL)
    return a.join(b, "measure").select(
        "measure", "before", "after", apart.alias("difference"), (F.abs(apart) <= F.lit(tolerance).cast("decimal(38,6)")).alias("preserved")
    )


def reduction_report(normalised: DataFrame, grain: Grain) -> DataFrame:
    """One row: rows_before, unique_rows, rows_after and what was removed and merged in between.

    One aggregation by all columns gives all of it.
    """
    counted = normalised.groupBy(*normalised.columns).agg(F.count(F.lit(1)).alias("n"))
    by_key = counted.groupBy(*grain.key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("u"))
    summed = by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("u"), F.lit(0)).alias("unique_rows"),
        F.count(F.lit(1)).alias("rows_after"),
    )
    return summed.select(
        "*",
        (F.col("rows_before") - F.col("unique_rows")).alias("exact_removed"),
        (F.col("unique_rows") - F.col("rows_after")).alias("rows_consolidated"),
        (F.col("rows_before") - F.col("rows_after")).alias("total_removed"),
    )


@dataclass(frozen=True)
class Load:
    """A consolidated table, what was counted while it was written, and results of controls of its source."""

    rows: DataFrame
    path: str
    rows_before: int
    unique_rows: int
    rows_after: int
    controls: dict[str, DataFrame]

    def report(self) -> DataFrame:
        """As :func:`reduction_report` has it."""
        a, u, z = self.rows_before, self.unique_rows, self.rows_after
        names = "rows_before bigint, unique_rows bigint, rows_after bigint, exact_removed bigint, rows_consolidated bigint, total_removed bigint"
        return self.rows.sparkSession.createDataFrame([(a, u, z, a - u, u - z, a - z)], names)

    def remove(self) -> None:
        """Delete the table, once nothing reads it any more."""
        remove_shared(self.rows.sparkSession, self.path)


_COPIES = "arqueo_copies"


def load(df: DataFrame, grain: Grain, tolerance: str = "0.01", row_number: str | None = None, controls: dict[str, Control] | None = None) -> Load:
    """The whole consolidation, written to the shared folder from one scan; raises ValueError if amounts
    are unreadable, attributes disagree or totals move.

    Controls, bad amounts and totals are observed on the rows on their way, disagreement and the new
    totals on the groups that are written. What is written is counted exactly. Rows of a stage that
    runs again after the loss of an executor are observed again; the number of rows then differs
    from that of the groups, and all that was observed is counted by jobs of its own. So is what
    the observations object to, before it is an error.
    ``row_number`` names a column of ``df`` that is neither attribute nor measure; the result
    has the first number of each key.
    """
    results: Callable[[], dict[str, DataFrame]] = dict
    source = df
    if controls:
        source, results = observed(df, controls)
    rows = normalise(source, grain)
    attributes = grain.attributes([c for c in rows.columns if c != row_number])
    seen, made = Observation(), Observation()
    sums = [F.sum(c).cast(TOTAL).alias(f"sum_{i}") for i, c in enumerate(grain.measures)]
    bad = [F.count_if(F.col(c).isNull()).alias(f"bad_{i}") for i, c in enumerate(grain.measures)]
    watched = rows.observe(seen, F.count(F.lit(1)).alias("n"), *bad, *sums)
    others = [c for c in rows.columns if c != row_number]
    first = [F.min(row_number).alias(row_number)] if row_number else []
    unique = watched.groupBy(*others).agg(F.count(F.lit(1)).alias(_COPIES), *first)
    torn = [f"arqueo_torn_{i}" for i in range(len(attributes))]
    marks = [_torn(c).alias(t) for c, t in zip(attributes, torn, strict=True)]
    grouped = unique.groupBy(*grain.key).agg(*_merged(grain, [*others, *([row_number] if row_number else [])], row_number), F.sum(_COPIES).alias(_COPIES), *marks)
    counts = [F.count(F.lit(1)).alias("n"), F.sum("rows_merged").alias("unique"), F.sum(_COPIES).alias("rows")]
    out = grouped.observe(made, *counts, *[F.count_if(F.col(t)).alias(t) for t in torn], *sums).drop(_COPIES, *torn)
    table, path = write_shared_at(out)
    before, after, zero = seen.get, made.get, Decimal(0)
    again = before["n"] != (after["rows"] or 0)
    moved = [c for i, c in enumerate(grain.measures) if abs((before[f"sum_{i}"] or zero) - (after[f"sum_{i}"] or zero)) > Decimal(tolerance)]
    if again or moved or any(before[f"bad_{i}"] for i in range(len(grain.measures))) or any(after[t] for t in torn):
        plain = normalise(df, grain)
        problem = _problem(df, plain.drop(row_number) if row_number else plain, table, grain, tolerance)
        if problem:
            remove_shared(df.sparkSession, path)
            raise ValueError(problem)
    found = {name: c.of(df) for name, c in (controls or {}).items()} if again else results()
    return Load(table, path, after["rows"] or 0, after["unique"] or 0, after["n"], found)


def _problem(df: DataFrame, rows: DataFrame, out: DataFrame, grain: Grain, tolerance: str) -> str | None:
    """What is wrong with a consolidation, counted by jobs of their own."""
    texts = [c for c, t in df.dtypes if c in grain.measures and t == "string"]
    bad = [r["column_name"] for r in bad_amounts(df, Grain(grain.key, tuple(texts))).collect()] if texts else []
    if bad:
        return f"texts that are no amounts in: {', '.join(sorted(bad))}"
    if grain.attributes(rows.columns):
        torn = [r["attribute"] for r in inconsistent_attributes(unique_rows(rows), grain).where("inconsistent_keys > 0").collect()]
        if torn:
            return f"attributes differ within one key: {', '.join(torn)}"
    moved = [r["measure"] for r in totals_check(rows, out, grain.measures, tolerance).where("not preserved").collect()]
    return f"totals changed: {', '.join(moved)}" if moved else None


def run(df: DataFrame, grain: Grain, tolerance: str = "0.01") -> DataFrame:
    """The rows of :func:`load`."""
    return load(df, grain, tolerance).rows


__all__ = [
    "Grain", "Load", "bad_amounts", "consolidate", "inconsistent_attributes", "load", "normalise",
    "reduction_report", "run", "totals", "totals_check", "unique_rows",
]
