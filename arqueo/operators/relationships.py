"""Whether descriptions depend on codes: key conflicts, refinement of keys, history over years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.functions.exprs import key_struct
from arqueo.operators.duplicates import tag_groups


def relationships(df: DataFrame, checks: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """Of each named (key, attributes): natural_keys, variants (distinct key and attributes), conflicting_keys,
    additional_variants and max_variants.

    The distinct combinations of all checks come from one exchange of the rows, the keys from one of these
    combinations; the rows are read once, however many checks there are.
    """
    columns = list(dict.fromkeys(c for k, a in checks.values() for c in (*k, *a)))
    combinations = tag_groups(df, {n: (*k, *a) for n, (k, a) in checks.items()})
    keep = [
        F.when(F.col("key_name").isin(*names), F.col(f"`{c}`")).alias(c) if (names := [n for n, (k, _) in checks.items() if c in k]) else F.lit(None).alias(c)
        for c in columns
    ]
    by_key = combinations.select("key_name", *keep).groupBy("key_name", *[f"`{c}`" for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    summed = by_key.groupBy(F.col("key_name").alias("relationship")).agg(
        F.count(F.lit(1)).alias("natural_keys"), F.sum("n").alias("variants"), F.count_if(F.col("n") > 1).alias("conflicting_keys"), F.max("n").alias("max_variants")
    )
    names = df.sparkSession.createDataFrame([(n,) for n in checks], "relationship string")
    return names.join(summed, "relationship", "left").na.fill(0).select(
        "relationship", "natural_keys", "variants", "conflicting_keys", (F.col("variants") - F.col("natural_keys")).alias("additional_variants"), "max_variants"
    )


def relationship(df: DataFrame, name: str, key: list[str], attributes: list[str]) -> DataFrame:
    """:func:`relationships` of one."""
    return relationships(df, {name: (key, attributes)})


def attribute_history(df: DataFrame, entity: list[str], year: str, attributes: list[str]) -> DataFrame:
    """One row on how entities' attributes change over years: entities, present in several years,
    with several versions, and the most versions. A version with nulls is a version."""
    by = df.select(*entity, year, *attributes).distinct().groupBy(*entity).agg(
        F.count_distinct(year).alias("years"), F.count_distinct(key_struct(attributes)).alias("versions")
    )
    return by.agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("years") > 1).alias("in_several_years"),
        F.count_if(F.col("versions") > 1).alias("changed"),
        F.coalesce(F.max("versions"), F.lit(0)).alias("max_versions"),
    )


def changes(df: DataFrame, entity: list[str], year: str, attributes: list[str]) -> DataFrame:
    """The versions of each entity that has several: entity, attributes, first and last year, rows."""
    versions = df.groupBy(*entity, *attributes).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count(F.lit(1)).alias("row_count")
    )
    several = versions.groupBy(*entity).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return versions.join(several, entity, "left_semi")
