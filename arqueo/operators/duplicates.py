"""Exact duplicates and candidate keys: what a grouping of the rows says about their grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arqueo.contracts import require_columns
from arqueo.functions.exprs import row_digest


def _group_metrics(none: int) -> list[Column]:
    many = F.col("n") > 1
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("unique_count"),
        F.count_if(many).alias("group_count"),
        F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.max(F.when(many, F.col("n"))), F.lit(none).cast("bigint")).alias("max_occurrences"),
    ]


def _with_rate(summed: DataFrame) -> DataFrame:
    rate = F.bround(F.coalesce(F.try_divide(F.col("extra_rows").cast("double"), F.col("row_count").cast("double")), F.lit(0.0)), 10)
    return summed.withColumn("duplicate_rate", rate)


def group_summary(counts: DataFrame, none: int) -> DataFrame:
    """From group sizes ``n``: rows, unique, groups, extra rows, rows in groups, largest, rate.

    ``none`` is the largest size where no group has more than one row.
    """
    return _with_rate(counts.agg(*_group_metrics(none)))


def duplicate_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that are equal in all ``columns``, on raw values; nulls equal nulls."""
    counts = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("extra_rows") > 0, "warning").otherwise("passed")
    return group_summary(counts.select("n"), 1).withColumn("status", status)


def largest_groups(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """The k largest groups of equal rows, ties in order of the values."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    return counts.orderBy(F.desc("occurrences"), *[F.asc_nulls_last(c) for c in columns]).limit(k)


def key_uniqueness(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """For each candidate key, what ``group_summary`` says; keys may nest, cross or have nothing in common.

    Rows are tagged by key and counted in their tasks first, so that all keys take one scan and one
    exchange, in which a hot key value is a row for each task. No digest of rows is needed.
    """
    for columns in keys.values():
        require_columns(df.columns, columns)
    tagged = tag_groups(df, {k: tuple(c) for k, c in keys.items()}, F.count(F.lit(1)).alias("arqueo_n"))
    summed = tagged.select("key_name", F.col("arqueo_n").alias("n")).groupBy("key_name").agg(*_group_metrics(0))
    names = df.sparkSession.createDataFrame([(k,) for k in keys], "key_name string")
    return _with_rate(names.join(summed, "key_name", "left").na.fill(0))


def tag_groups(df: DataFrame, groups: dict[str, tuple[str, ...]], *metrics: Column) -> DataFrame:
    """key_name, the metrics and all columns of the groupings (null where they are none of the key's) of
    each group of each named grouping, by one exchange of grouping sets. Nulls equal nulls.
    """
    columns = list(dict.fromkeys(c for own in groups.values() for c in own))
    sets = {name: frozenset(own) for name, own in groups.items()}
    distinct = sorted({tuple(c for c in columns if c in own) for own in sets.values()})
    # The bits of grouping_id, the first column's the highest, tell which columns are left out.
    bits = {own: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own) for own in distinct}
    mark = "arqueo_grouping"
    found = df.groupingSets([[F.col(f"`{c}`") for c in own] for own in distinct], *[F.col(f"`{c}`") for c in columns]).agg(F.grouping_id().alias(mark), *metrics)
    named: dict[int, list[str]] = {}
    for name, own in sets.items():
        named.setdefault(bits[tuple(c for c in columns if c in own)], []).append(name)
    names = F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(b).cast("bigint"), F.array(*map(F.lit, n))) for b, n in named.items()]))[F.col(mark).cast("bigint")])
    return found.withColumn("key_name", names).drop(mark)


def collision_samples(df: DataFrame, key: list[str], order: list[str], groups: int = 20, rows: int = 2) -> DataFrame:
    """The first ``rows`` rows of the ``groups`` largest groups that share a key; 0 gives none.

    Only the chosen keys' rows are sorted.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    chosen = counts.orderBy(F.desc("occurrences"), *[F.asc_nulls_last(c) for c in key]).limit(groups)
    a, b = df.alias("a"), F.broadcast(chosen).alias("b")
    same = reduce(lambda x, y: x & y, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key))
    found = a.join(b, same).select("a.*", "b.occurrences")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.asc_nulls_last(c) for c in order]))
    return found.withColumn("place", place.cast("bigint")).where(F.col("place") <= rows)


def sample_key(keys: dict[str, list[str]], wanted: str | None = None, default: str = "business") -> str:
    """The name of the candidate key whose collisions are sampled: the wanted one, else the default
    one if it is there, else the first."""
    name = wanted or (default if default in keys else next(iter(keys), None))
    if name not in keys:
        raise ValueError(f"unknown key {name!r}; known: {', '.join(keys)}")
    return name


def duplicate_rows(numbered: DataFrame, columns: list[str], row_number: str, groups: int = 20, rows: int = 2) -> DataFrame:
    """The first ``rows`` rows, by number, of the ``groups`` largest groups of equal rows, with their digest."""
    found = collision_samples(numbered, columns, [row_number], groups, rows)
    return found.select(row_number, row_digest(columns).alias("_row_hash"), *columns, "occurrences")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values with more than one row, and how many: what a unique constraint would reject."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
