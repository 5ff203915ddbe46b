"""Helpers that several operators share: tables, shared folders, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder that the session names in spark.checkpoint.dir.

    Only where the session names none and runs on one machine (tests, local runs) a local temporary
    folder is used; on a cluster each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/arqueo-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="arqueo-")


#: Settings of the jobs that operators run themselves: small Arrow batches between the JVM and Python, so
#: that long texts need little memory; a job's shuffle files are deleted when it ends.
JOB_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def job_settings(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside run with JOB_SETTINGS."""
    before = {key: spark.conf.get(key) for key in JOB_SETTINGS}
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage.

    Unlike a local checkpoint the copy outlives the executors that wrote it.
    """
    return materialize_at(df)[0]


def materialize_at(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = shared_dir(spark)
    with job_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Tables:
    """Tables that an operator writes for its later jobs, deleted after their last reader."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def write(self, df: DataFrame) -> DataFrame:
        table, path = materialize_at(df)
        self._paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_dir(self._spark, self._paths.pop(id(table))[1])

    def drop_all(self) -> None:
        self.drop(*(table for table, _ in self._paths.values()))


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder written by :func:`materialize_at` through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def grouped(items: list[bytes], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of ``items`` that hold about ``limit`` bytes each (one item at least)."""
    start = size = 0
    for i, x in enumerate(items):
        size += len(x) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(items):
        yield start, len(items)


def map_texts(
    df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the decimal id, modulo 3; fold 1 is held out from learning."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


#: Size of a bit table of keys.
FILTER_BITS = 23


def bit_words(keys: DataFrame, key: Column, size: int = FILTER_BITS) -> DataFrame:
    """word, bits: a bit table of 2 ** size places in which the place of each key (bigint) is set. It has
    at most 2 ** (size - 6) rows, however many keys there are."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))
    return keys.groupBy(_word(key, size)).agg(F.bit_or(bit).alias("bits"))


def bit_array(keys: DataFrame, key: Column, size: int = FILTER_BITS) -> np.ndarray:
    """The bit table of :func:`bit_words` as an array, for :func:`in_bits`."""
    with job_settings(keys.sparkSession):
        words = bit_words(keys, key, size).toArrow()
    out = np.zeros(1 << (size - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def in_bits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (int64) have their place set."""
    place = keys & (64 * len(table) - 1)
    return (table[place >> 6] >> (place & 63)) & 1 > 0


def _word(key: Column, size: int = FILTER_BITS) -> Column:
    return F.shiftright(key.bitwiseAND(F.lit((1 << size) - 1)), 6).cast("int").alias("word")


def parted(rows: DataFrame, key: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in the bit table ``words``, and those whose key is not.

    The table (fixed size) is broadcast. It has no false negatives, so only rows of the first kind
    need to be exchanged for a join with the keys. Key: a hash that is not null.
    """
    names = rows.columns
    word, bits = "arqueo_word", "arqueo_bits"
    table = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    seen = rows.join(table, _word(F.col(key)) == F.col(word), "left")
    bit = F.coalesce(F.call_function("getbit", F.col(bits), F.col(key).bitwiseAND(F.lit(63)).cast("int")), F.lit(0))
    return seen.where(bit == 1).select(*names), seen.where(bit == 0).select(*names)
