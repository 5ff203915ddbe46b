"""The star schema: dimensions with dense ordered surrogate keys, the fact, and its validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arqueo.contracts import Dimension
from arqueo.operators.duplicates import tag_groups
from arqueo.sources.storage import shared_path, write_shared


def _labelled(rows: DataFrame, dim: Dimension) -> DataFrame:
    for label, (source, default) in dim.labels.items():
        rows = rows.withColumn(label, F.coalesce(source, F.lit(default)))
    return rows


def candidates(df: DataFrame, dim: Dimension) -> DataFrame:
    """The distinct rows of a dimension, with default labels."""
    return _labelled(df.select(*dim.key, *dim.attributes).distinct(), dim)


def all_candidates(df: DataFrame, dims: tuple[Dimension, ...]) -> dict[str, DataFrame]:
    """The distinct rows of several dimensions. The small ones come from one scan and one exchange of ``df``,
    written once; a large one from its own columns, as nearly each row of ``df`` may be one of its rows, and
    would be exchanged and written with the columns of all the others."""
    found = {d.name: candidates(df, d) for d in dims if not d.small}
    if small := [d for d in dims if d.small]:
        path = shared_path(df.sparkSession)
        tagged = tag_groups(df, {d.name: (*d.key, *d.attributes) for d in small})
        tagged.write.partitionBy("key_name").parquet(path)
        stored = df.sparkSession.read.schema(tagged.schema).parquet(path)
        found |= {d.name: _labelled(stored.where(F.col("key_name") == d.name).select(*d.key, *d.attributes), d) for d in small}
    return {d.name: found[d.name] for d in dims}


def _order(columns) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def number_small(rows: DataFrame, key: tuple[str, ...], name: str) -> DataFrame:
    """Numbers from 1 in key order by one sort; for dimensions of a few thousand rows that do not
    grow with the data."""
    place = F.row_number().over(Window.orderBy(*_order(key)))
    return rows.select(place.cast("int").alias(name), "*")


def number_large(rows: DataFrame, key: tuple[str, ...], name: str) -> DataFrame:
    """The same numbers for a dimension of any size, without putting its rows into one task.

    The rows are sorted by ranges and written, so that partitions can't change; each partition's
    rows are numbered alone, and get the number of rows of the partitions before. What is returned only
    adds these numbers while it reads, so it need not be written again.
    """
    # The place in the partition: the lower 33 bits of the id.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    fixed = write_shared(rows.orderBy(*_order(key)).select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))
    parts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row for each partition.
    offsets = write_shared(parts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    number = F.col("_place") + F.col("_before") + 1
    numbered = fixed.join(F.broadcast(offsets), "_part").withColumn(name, number.cast("int"))
    return numbered.select(name, *rows.columns)


def _numbered(rows: DataFrame, dim: Dimension) -> DataFrame:
    return (number_small if dim.small else number_large)(rows, dim.key, dim.surrogate)


def build_dimension(df: DataFrame, dim: Dimension) -> DataFrame:
    return _numbered(candidates(df, dim), dim)


def build_dimensions(df: DataFrame, dims: tuple[Dimension, ...]) -> dict[str, DataFrame]:
    """:func:`build_dimension` of each, with ``df`` read once for all small ones; every dimension is written
    once, as facts and checks read it."""
    rows = all_candidates(df, dims)
    return {d.name: write_shared(_numbered(rows[d.name], d)) if d.small else _numbered(rows[d.name], d) for d in dims}


def _look_up(rows: DataFrame, table: DataFrame, dim: Dimension, how: str) -> DataFrame:
    """Join a dimension's surrogate key. Equality, so a null in a key finds nothing.

    No broadcast is forced: Spark broadcasts a side whose measured size is below its threshold,
    and adaptive execution splits hot keys otherwise.
    """
    keyed = table.select(dim.surrogate, *dim.key)
    return rows.join(keyed, list(dim.key), how)


def _small_first(dims: tuple[Dimension, ...]) -> list[Dimension]:
    """So that the rows that large dimensions' joins exchange hold the small ones' keys and no texts; small
    ones whose own key is exchanged anyway come last."""
    exchanged = {c for d in dims if not d.small for c in d.key}
    return sorted(dims, key=lambda d: 2 * (exchanged >= set(d.key)) if d.small else 1)


def load_fact(df: DataFrame, tables: dict[str, DataFrame], dims: tuple[Dimension, ...], measures: list[str]) -> DataFrame:
    """A fact row for each row of ``df``: the surrogate keys and the measures."""
    ordered = _small_first(dims)
    large = [i for i, d in enumerate(ordered) if not d.small]
    first = ordered[: large[0]] if large else []
    out = df
    for dim in first:
        out = _look_up(out, tables[dim.name], dim, "inner")
    if first:
        packed, unpacked = _packed({d.surrogate: tables[d.name] for d in first})
        out = out.select("*", *packed).drop(*[d.surrogate for d in first])
    for dim in ordered[len(first) :]:
        out = _look_up(out, tables[dim.name], dim, "inner")
    if first:
        out = out.withColumns(unpacked)
    return out.select(*[d.surrogate for d in dims], *measures)


def _packed(tables: dict[str, DataFrame]) -> tuple[list[Column], dict[str, Column]]:
    """Numbers of dimensions, by their column's name, as bits of as few bigints as hold them, and what reads
    them back: a few bits each where an exchanged row has eight bytes for every column."""
    packed, unpacked, shift, parts = [], {}, 0, []
    for name, table in tables.items():
        bits = max(1, int(table.agg(F.max(name)).first()[0] or 0).bit_length())
        if shift + bits > 63:
            packed, shift, parts = [*packed, parts], 0, []
        parts.append(F.call_function("shiftleft", F.col(name).cast("bigint"), F.lit(shift)))
        at = F.shiftright(F.col(f"_packed{len(packed)}"), shift).bitwiseAND(F.lit((1 << bits) - 1))
        unpacked[name] = at.cast(table.schema[name].dataType)
        shift += bits
    return [reduce(Column.bitwiseOR, p).alias(f"_packed{i}") for i, p in enumerate([*packed, parts])], unpacked


def coverage(df: DataFrame, tables: dict[str, DataFrame], dims: tuple[Dimension, ...], year: str) -> DataFrame:
    """By year: rows, and rows without a match in each dimension, and in all together."""
    out = df
    for dim in _small_first(dims):
        out = _look_up(out, tables[dim.name], dim, "left")
    missing = {d.name: F.col(d.surrogate).isNull() for d in dims}
    return out.groupBy(year).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(c).alias(f"missing_{n}") for n, c in missing.items()],
        F.count_if(reduce(lambda a, b: a | b, missing.values())).alias("rows_missing_any"),
    )


def count_check(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, expected, actual, matches: full join, null-safe comparison. Both have key and n."""
    a = expected.select(key, F.col("n").alias("expected"))
    b = actual.select(key, F.col("n").alias("actual"))
    return a.join(b, key, "full").withColumn("matches", F.col("expected").eqNullSafe(F.col("actual")))


def foreign_keys(child: DataFrame, parents: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """constraint, orphans, valid of each named (parent, child column, parent column).

    As in SQL, a null reference breaks no constraint.
    """
    parts = []
    for name, (parent, column, target) in parents.items():
        refs = child.where(F.col(column).isNotNull()).select(F.col(column).alias("k"))
        lost = refs.join(parent.select(F.col(target).alias("k")), "k", "left_anti")
        parts.append(lost.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("constraint_name"), "orphans"))
    return reduce(DataFrame.unionByName, parts).withColumn("valid", F.col("orphans") == 0)


def _references(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """repeated: rows of ``parent`` whose ``column`` is null or that of another row counted before; orphans:
    rows of ``child`` whose ``column`` no row of ``parent`` has. One row, by one exchange of both sides,
    counted in their tasks first."""
    sides = child.select(column, F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(parent.select(column, F.lit(0).alias("c"), F.lit(1).alias("p")))
    by = sides.groupBy(column).agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
    known = F.col(column).isNotNull()
    orphans = F.sum(F.when(known & (F.col("p") == 0), F.col("c")))
    repeated = F.sum("p") - F.count_if(known & (F.col("p") > 0))
    return by.agg(F.coalesce(repeated, F.lit(0)).alias("repeated"), F.coalesce(orphans, F.lit(0)).alias("orphans"))


def constraint_catalog(tables: dict[str, DataFrame], dims: tuple[Dimension, ...], fact: DataFrame, fact_name: str = "fact") -> DataFrame:
    """table_name, column_count, row_count, constraint_name, kind, columns, violations, valid: what a database's
    catalog says of a star schema's tables joined with their constraints, each checked on the data.

    Of each dimension: primary key, unique natural key, and keys that are not null; of the fact: a foreign
    key for each dimension, from the exchange that checks the primary key. Violations of keys are rows too
    many, of others rows. The fact's keys are written for the checks, which read nothing else of it.
    """
    spark = fact.sparkSession
    keys = write_shared(fact.select(*[d.surrogate for d in dims]))
    checked, described = [], []

    def listed_as(counted: DataFrame, *found: tuple[str, str, str, Column]) -> DataFrame:
        names = ("table_name", "kind", "columns", "violations")
        return counted.select(F.inline(F.array(*[F.struct(*[(x if isinstance(x, Column) else F.lit(x)).alias(n) for n, x in zip(names, row, strict=True)]) for row in found])))

    for d in dims:
        table = tables[d.name]
        counted = table.agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*d.key)).alias("u"),
            F.count_if(reduce(lambda x, y: x | y, (F.col(c).isNull() for c in (d.surrogate, *d.key)))).alias("m"),
        )
        unique, filled = (d.name, "unique", ",".join(d.key), F.col("n") - F.col("u")), (d.name, "not_null", ",".join((d.surrogate, *d.key)), F.col("m"))
        primary, foreign = (d.name, "primary", d.surrogate, F.col("repeated")), (fact_name, "foreign", d.surrogate, F.col("orphans"))
        checked += [listed_as(counted, unique, filled), listed_as(_references(keys, table, d.surrogate), primary, foreign)]
        described.append(table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(d.name).alias("table_name"), "row_count"))
    described.append(keys.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(fact_name).alias("table_name"), "row_count"))
    widths = [(d.name, len(tables[d.name].columns)) for d in dims] + [(fact_name, len(fact.columns))]
    listed = spark.createDataFrame(widths, "table_name string, column_count int").join(reduce(DataFrame.unionByName, described), "table_name")
    every = listed.join(reduce(DataFrame.unionByName, checked), "table_name")
    name = F.concat_ws("_", "table_name", F.when(F.col("kind") == "foreign", F.col("columns")), "kind")
    return every.select("table_name", "column_count", "row_count", name.alias("constraint_name"), "kind", "columns", "violations", (F.col("violations") == 0).alias("valid"))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, nulls: what NOT NULL constraints would reject."""
    from arqueo.operators.profile import _tidy

    return _tidy(df, {c: {"nulls": F.count_if(F.col(c).isNull())} for c in columns})


def structure(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, position, column_name, data_type, nullable of all tables' columns."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (t, i, f.name, f.dataType.simpleString(), f.nullable)
        for t, df in tables.items()
        for i, f in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string, nullable boolean")


def _refuse(rows: list, what: str) -> None:
    if rows:
        raise ValueError(f"{what}: {'; '.join(rows)}")


def require_counts(actual: DataFrame, expected: DataFrame, key: str) -> None:
    """Refuse a load whose rows by ``key`` (both have key and n) are not those expected."""
    wrong = count_check(actual, expected, key).where("not matches").orderBy(key).limit(20).collect()
    _refuse([f"{r[key]}: {r['actual']} instead of {r['expected']}" for r in wrong], "row counts differ")


def require_dimension_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> None:
    """Refuse dimensions that are missing or whose number of rows is not the one expected."""
    wrong = [f"{n} is missing" for n in sorted(set(expected) - set(tables))]
    for name in sorted(set(expected) & set(tables)):
        n = tables[name].count()
        if n != expected[name]:
            wrong.append(f"{name}: {n} instead of {expected[name]}")
    _refuse(wrong, "dimensions differ")


def require_coverage(covered: DataFrame, expected: DataFrame, year: str) -> None:
    """Refuse a load if a year's rows differ from the staged ones (year, n), or a row lacks a dimension.

    ``covered`` is what :func:`coverage` gives.
    """
    require_counts(covered.select(year, F.col("row_count").alias("n")), expected, year)
    wrong = covered.where("rows_missing_any > 0").orderBy(year).limit(20).collect()
    _refuse([f"{r[year]}: {r['rows_missing_any']} rows" for r in wrong], "rows without a dimension")


def require_foreign_keys(checked: DataFrame, constraints: int) -> None:
    """Refuse a model that lacks one of its constraints, or in which one has orphans."""
    rows = checked.collect()  # a row for each constraint
    wrong = [f"{len(rows)} constraints instead of {constraints}"] * (len(rows) != constraints)
    wrong += [f"{r['constraint_name']}: {r['orphans']} orphans" for r in rows if not r["valid"]]
    _refuse(wrong, "foreign keys")


def require_empty(tables: dict[str, DataFrame]) -> None:
    """Refuse a load into tables that have rows, naming them."""
    filled = sorted(n for n, df in tables.items() if not df.isEmpty())
    if filled:
        raise ValueError(f"tables are not empty: {', '.join(filled)}")
