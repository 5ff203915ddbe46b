"""Reading and writing tables and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arqueo.sources.records import record_texts

CORRUPT = "_corrupt_record"


def _charset(encoding: str) -> str:
    """A codec's name as the JVM has it; byte order marks are dropped for any of them."""
    return {"utf-8-sig": "UTF-8", "utf8": "UTF-8", "latin-1": "ISO-8859-1"}.get(encoding.lower(), encoding)


def header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Column names of a CSV file; a byte order mark is no part of the first."""
    first = spark.read.options(header=True, encoding=_charset(encoding), escape='"').csv(path)
    return [c.lstrip("\ufeff") for c in first.columns]


def read_text_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, keep_malformed: bool = True,
    encoding: str = "UTF-8", multi_line: bool = False,
) -> DataFrame:
    """All columns as text, by the header's names, so that leading zeros and column order don't matter.

    Records with too few or too many fields have their text in ``_corrupt_record``. Large files are
    split over tasks. Where quoted fields may hold line breaks (``multi_line``), the path is one file,
    whose records are found as in :func:`numbered_records`.
    """
    if multi_line:
        df = numbered_records(spark, path, encoding).where("not _blank").drop(ROW_NUMBER, "_blank")
        return df.select(*columns) if columns else df if keep_malformed else df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    names = header(spark, path, encoding)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, CORRUPT]])
    df = (
        spark.read.schema(schema)
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, escape='"', encoding=_charset(encoding))
        .csv(path)
    )
    if columns:
        return df.select(*columns)
    return df if keep_malformed else df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


ROW_NUMBER = "_row_number"


def numbered_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The records of one CSV file with ``_row_number``, ``_blank`` and ``_corrupt_record``.

    The header is record 1, so records are numbered from 2, blank lines included, as Python's csv
    module counts them; quoted fields may hold line breaks. The file is split over tasks.
    """
    text = F.decode("value", _charset(encoding)).alias("value")
    records = record_texts(spark, path).where("number > 1").select(F.col("number").alias(ROW_NUMBER), text)
    names = header(spark, path, encoding)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, CORRUPT])
    blank = F.col("value") == ""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true", "lineSep": "\n"}
    fields = F.when(~blank, F.from_csv("value", schema, options))
    parsed = records.select(ROW_NUMBER, blank.alias("_blank"), fields.alias("r"))
    return parsed.select(ROW_NUMBER, "_blank", *[F.col("r")[c].alias(c) for c in [*names, CORRUPT]])


def record_counts(records: DataFrame) -> DataFrame:
    """One row: record_count, blank_records and malformed_records of :func:`numbered_records`."""
    return records.agg(
        F.count_if(~F.col("_blank")).alias("record_count"),
        F.count_if("_blank").alias("blank_records"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed_records"),
    )


def sample(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The first rows, for structural profiles."""
    if rows <= 0:
        raise ValueError("the sample needs at least one row")
    return df.limit(rows)


def inferred_types(df: DataFrame) -> dict[str, str]:
    """What each text column holds: bigint, double, timestamp or string, the first that all values fit."""
    kinds = ("bigint", "double", "timestamp")
    misfits = df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull()).alias(f"{i}_{k}") for i, c in enumerate(df.columns) for k in kinds
    ]).first()
    return {c: next((k for k in kinds if misfits[f"{i}_{k}"] == 0), "string") for i, c in enumerate(df.columns)}


def read_sources(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Several yearly files as one table, matched by column name."""
    out = None
    for p in paths:
        df = read_text_csv(spark, p, keep_malformed=False, encoding=encoding)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Parquet, which is how layers are kept; by year, filters on the year read only its files."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, order: list | None = None, without: list[str] | None = None) -> None:
    """CSV with header in the columns' order; null is an empty field. Columns may serve the order alone."""
    (df.orderBy(*order) if order else df).drop(*(without or [])).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A metrics table as JSON lines."""
    df.write.mode("append").json(path)


def markdown_cell(c: Column) -> Column:
    """Text that a Markdown table cell can hold."""
    return F.regexp_replace(F.regexp_replace(c, r"\|", r"\\|"), r"\r\n|\r|\n", " ")


def markdown_rows(df: DataFrame) -> DataFrame:
    """line: each row as a Markdown table row."""
    cells = [F.coalesce(markdown_cell(F.col(c).cast("string")), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def dictionary_problems(df: DataFrame, expected: list[str]) -> list[str]:
    """What is wrong with a data dictionary: its header, no rows, or names that repeat."""
    found = [] if [c for c in df.columns if c != CORRUPT] == expected else ["header"]
    if found:
        return found
    if df.isEmpty():
        return ["empty"]
    name = F.trim(expected[0])
    twice = df.groupBy(name.alias("name")).count().where("count > 1 and name is not null")
    return [f"repeated {r['name']}" for r in twice.orderBy("name").limit(20).collect()]


def dictionary_variables(df: DataFrame, column: str) -> DataFrame:
    """variable: the distinct trimmed names of a data dictionary's column, without nulls and blanks."""
    name = F.nullif(F.trim(column), F.lit(""))
    return df.select(name.alias("variable")).where("variable is not null").distinct()


def markdown_report(title: str, sections: dict[str, DataFrame]) -> DataFrame:
    """position, line: a Markdown report with a table for each section, for tables of a few rows.

    An empty section says so.
    """
    out = None
    for i, (name, df) in enumerate(sections.items()):
        rows = markdown_rows(df).select(F.monotonically_increasing_id().alias("n"), "line")
        head = [f"# {title}", ""] * (i == 0) + [f"## {name}", ""]
        head += ["No rows.", ""] if df.isEmpty() else ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        top = df.sparkSession.createDataFrame([(n - len(head), line) for n, line in enumerate(head)], "n bigint, line string")
        part = top.unionByName(rows).select(F.lit(i).alias("section"), "n", "line")
        out = part if out is None else out.unionByName(part)
    place = F.row_number().over(Window.orderBy("section", "n"))
    return out.select(place.alias("position"), "line")
