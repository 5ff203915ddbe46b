"""The star-like test tables as budget facts: what stands for years, measures and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arqueo.contracts import AMOUNT, Dimension

MEASURES = ["budget", "committed", "accrued"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _amounts() -> list[Column]:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    committed = price * (1 - discount)
    return [
        price.cast(AMOUNT).alias("budget"),
        committed.cast(AMOUNT).alias("committed"),
        (committed * (1 + tax)).cast(AMOUNT).alias("accrued"),
    ]


def staging(spark: SparkSession, sf_dir: str, parts: bool = True, places: bool = True) -> DataFrame:
    """One wide row for each line, as the staging layer has it.

    Only the joins that a query needs are made; a date in the order gives year and month. Orders meet their
    customers, and lines their parts, before lines meet orders, so lines are exchanged while they are narrow.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    columns = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"), "year", "month", F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority"),
    ]
    if places:
        nation = table(spark, sf_dir, "nation")
        region = table(spark, sf_dir, "region")
        customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        columns += [F.col("n_name").alias("nation"), F.col("r_name").alias("region")]
    if parts:
        lines = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        columns += [F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size")]
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    out = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return out.select(*columns, *_amounts())


#: The same rows in SQL, for the oracles.
STAGING_SQL = """
    staging AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS returnflag, l_linestatus AS linestatus,
            CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, c_custkey AS custkey,
            c_name AS customer, c_mktsegment AS segment, o_orderpriority AS priority, n_name AS nation, r_name AS region,
            p_brand AS brand, p_type AS type, p_size AS size,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(24,2)) AS budget,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,2)) AS committed,
            CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(24,2)) AS accrued
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
    )
"""

#: The stand-ins of the eight dimensions.
DIMENSIONS = (
    Dimension("time", ("year",)),
    Dimension("institution", ("year", "custkey"), ("customer", "segment", "nation"), small=False),
    Dimension("target", ("year", "l_partkey", "l_suppkey"), small=False),
    Dimension("function", ("brand", "type")),
    Dimension("financing", ("returnflag", "linestatus")),
    Dimension("classifier", ("year", "type", "size")),
    Dimension("location", ("region", "nation")),
    Dimension("priority", ("priority",)),
)
