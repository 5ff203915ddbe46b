"""Records of CSV files whose quoted fields may hold line breaks, found in splits of the file.

A split may begin inside a quoted field. What a line does to that depends on one bit, so each task reads
its splits under both assumptions; a scan over the splits, a row each, then tells which one holds and
how many records and lines come before. No task reads more than its splits, whatever is quoted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A record of more lines is an error: its quote is never closed.
MAX_RECORD_LINES = 100_000

_QUOTED = rb'"(?:[^"]|"")*+"[^,]*+'
_FIELD = rb'(?:' + _QUOTED + rb'|[^",][^,]*+|)'
#: Lines that end outside quotes, when they begin outside, and when they begin inside.
_FROM_OUTSIDE = re.compile(_FIELD + rb"(?:," + _FIELD + rb")*+", re.S)
_FROM_INSIDE = re.compile(rb'(?:[^"]|"")*+"[^,]*+(?:,' + _FIELD + rb")*+", re.S)


def _inside_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line with quotes."""
    return not (_FROM_INSIDE if inside else _FROM_OUTSIDE).fullmatch(line)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches, cut where a split (column block) ends."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        at = 0
        for block, same in groupby(blocks.tolist()):
            n = sum(1 for _ in same)
            yield block, batch.slice(at, n)
            at += n


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: its lines, and for both ways to begin how it ends and how many records begin in it."""
    for block, parts in groupby(_runs(batches), lambda x: x[0]):
        lines, inside, begun = 0, [False, True], [0, 0]
        for _, batch in parts:
            values = batch.column("value")
            at = 0
            for i in pc.indices_nonzero(pc.match_substring(values, b'"')).to_pylist():
                line = values[i].as_py()
                for k in (0, 1):
                    begun[k] += 0 if inside[k] else i - at + 1
                    inside[k] = _inside_after(line, inside[k])
                at = i + 1
            for k in (0, 1):
                begun[k] += 0 if inside[k] else len(values) - at
            lines += len(values)
        yield pa.RecordBatch.from_pylist([{"block": block, "lines": lines, "open_0": inside[0], "begun_0": begun[0], "open_1": inside[1], "begun_1": begun[1]}])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split, in order: whether it begins inside a quoted field, and the records and lines before."""
    inside, records, lines = False, 0, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            out.append({"block": row["block"], "inside": inside, "records": records, "lines": lines})
            k = int(inside)
            inside, records, lines = row[f"open_{k}"], records + row[f"begun_{k}"], lines + row["lines"]
        if out:
            yield pa.RecordBatch.from_pylist(out)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """number, line, whole and value of each line: the record it is of, and whether it is all of it."""
    for _, parts in groupby(_runs(batches), lambda x: x[0]):
        inside = number = line = None
        open_lines = 0
        for _, batch in parts:
            if inside is None:
                inside, number, line = (batch.column(c)[0].as_py() for c in ("inside", "records", "lines"))
            values = batch.column("value")
            quoted = pc.match_substring(values, b'"').to_pylist()
            numbers, whole = [], []
            for i, q in enumerate(quoted):
                before = inside
                if not before:
                    number += 1
                if q:
                    inside = _inside_after(values[i].as_py(), inside)
                numbers.append(number)
                whole.append(not before and not inside)
                open_lines = open_lines + 1 if inside else 0
                if open_lines > MAX_RECORD_LINES:
                    raise ValueError(f"record {number} has a quote that is not closed within {MAX_RECORD_LINES} lines")
            places = pa.array(range(line, line + len(values)), pa.int64())
            line += len(values)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), places, pa.array(whole), values], ["number", "line", "whole", "value"])


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """number (from 1) and value (binary) of the records of one CSV file, as Python's csv module parts them.

    Lines end with LF or CRLF; line breaks inside quotes stay. Blank lines are records. A quote that is
    never closed is an error. An empty file has no records.
    """
    block = F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"), block)
    effects = lines.mapInArrow(_effects, "block bigint, lines bigint, open_0 boolean, begun_0 bigint, open_1 boolean, begun_1 bigint")
    # One row for each split of the file.
    starts = effects.repartition(1).sortWithinPartitions("block").mapInArrow(_starts, "block bigint, inside boolean, records bigint, lines bigint")
    parts = lines.join(F.broadcast(starts), "block").mapInArrow(_numbered, "number bigint, line bigint, whole boolean, value binary")
    whole = parts.where("whole").select("number", "value")
    torn = parts.where("not whole").groupBy("number").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("x"))
    # The lines' bytes are joined as text in a charset that keeps every byte.
    latin = F.array_join(F.transform("x", lambda y: F.decode(y["value"], "ISO-8859-1")), "\n")
    joined = whole.unionByName(torn.select("number", F.encode(latin, "ISO-8859-1").alias("value")))
    size = F.octet_length("value") - F.when(F.substring("value", -1, 1) == F.lit(b"\r"), 1).otherwise(0)
    return joined.select("number", F.substring("value", F.lit(1), size).alias("value"))
