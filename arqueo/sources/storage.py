"""Tables that several jobs of one operator read."""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def write_shared(df: DataFrame) -> DataFrame:
    """Write to the folder that the session names in spark.checkpoint.dir, and read back."""
    return write_shared_at(df)[0]


def write_shared_at(df: DataFrame) -> tuple[DataFrame, str]:
    """The table that :func:`write_shared` gives, and the folder it is in."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def shared_path(spark: SparkSession) -> str:
    """A fresh folder's path in the folder that the session names in spark.checkpoint.dir.

    Only where the session names none and runs on one machine, as in tests, a local temporary folder is
    used; on a cluster each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"


def remove_shared(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`write_shared_at` once nothing reads it any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def sweep_shared(spark: SparkSession, older_than: float, base: str | None = None) -> int:
    """Delete the tables in the shared folder that were written more than ``older_than`` seconds ago, such as
    those that results of ended sessions have read; how many went. Nothing else in the folder is touched.
    ``base``: another folder than the session's."""
    base = base or spark.conf.get("spark.checkpoint.dir", None) or _local_folder()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return 0
    limit = (time.time() - older_than) * 1000
    old = [x for x in fs.listStatus(place) if x.getPath().getName().startswith(("table-", "arqueo-")) and x.getModificationTime() < limit]
    for x in old:
        fs.delete(x.getPath(), True)
    return len(old)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="arqueo-")
