"""Catalog tables: layers as databases, statistics, sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def create_layer(spark: SparkSession, name: str, comment: str) -> None:
    """A database for a layer (staging, analytics), if it is not there yet."""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} COMMENT '{text}'")


def save_layer_table(df: DataFrame, table: str, partition_by: str | None = None, bucket_by: tuple[int, str] | None = None) -> None:
    """Truncate and reload a catalog table. Partitioned by year, filters on it prune files; bucketed
    by a key, joins on it need no exchange."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(table)


def analyze(spark: SparkSession, table: str) -> None:
    """Statistics of all columns, for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {_quoted(table)} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_sizes(spark: SparkSession, tables: list[str]) -> DataFrame:
    """table_name, bytes and rows by the catalog's statistics (after :func:`analyze`)."""
    parts = []
    for t in tables:
        detail = spark.sql(f"DESCRIBE EXTENDED {_quoted(t)}").where("col_name = 'Statistics'")
        number = lambda pattern: F.regexp_extract("data_type", pattern, 1).try_cast("bigint")
        parts.append(detail.select(F.lit(t).alias("table_name"), number(r"(\d+) bytes").alias("bytes"), number(r"(\d+) rows").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)
