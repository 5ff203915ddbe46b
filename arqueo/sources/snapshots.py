"""Tables that are published together, as versions of which readers see one or the next, never none.

A version is a folder that nobody changes once it is named. Its name stands in a pointer file, and pointers
are numbered: the greatest is the current version. A pointer is created only if its number is free, which
HDFS and object stores do atomically, so of two publishers one takes the next number; a local disk doesn't,
so there the publishers of one process take turns. What a reader has opened stays as it is until the
version is expired.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_TURN = threading.Lock()


class Snapshots:
    """The versions below ``path``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        return [x.getPath().getName() for x in self._fs.listStatus(self._at(folder))] if self._fs.exists(self._at(folder)) else []

    def _folder(self, number: int) -> str | None:
        """The folder that a pointer names; None while it is being written, or if it is gone."""
        try:
            stream = self._fs.open(self._at(f"pointers/{number:010d}"))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return name if name.endswith("\n") and self._fs.exists(self._at(f"versions/{name.strip()}")) else None

    def versions(self) -> list[int]:
        """The numbers of the versions that can be read, ascending."""
        numbers = sorted(int(x) for x in self._names("pointers") if x.isdigit())
        return [n for n in numbers if self._folder(n)]

    def current(self) -> int | None:
        """The greatest number that can be read; None before the first version."""
        for n in sorted((int(x) for x in self._names("pointers") if x.isdigit()), reverse=True):
            if self._folder(n):
                return n
        return None

    def read(self, name: str = "table", version: int | None = None) -> DataFrame:
        """A table of the current version, or of a given one."""
        number = self.current() if version is None else version
        folder = None if number is None else self._folder(number)
        if folder is None:
            raise ValueError(f"no version {number} at {self.path}" if number is not None else f"nothing is published at {self.path}")
        return self.spark.read.parquet(f"{self.path}/versions/{folder.strip()}/{name}")

    def publish(self, tables: DataFrame | dict[str, DataFrame], check: Callable[[dict[str, DataFrame]], None] | None = None) -> int:
        """Write tables as one version, check what was written, and make it the current one; its number.

        ``check`` gets the written tables and raises if they are not fit; the version is then removed, and
        readers never see it. Several publishers at once get a number each.
        """
        wanted = {"table": tables} if isinstance(tables, DataFrame) else tables
        folder = uuid.uuid4().hex
        place = self._at(f"versions/{folder}")
        try:
            for name, df in wanted.items():
                df.write.parquet(f"{self.path}/versions/{folder}/{name}")
            if check:
                check({name: self.spark.read.parquet(f"{self.path}/versions/{folder}/{name}") for name in wanted})
        except Exception:
            self._fs.delete(place, True)
            raise
        with _TURN:
            number = max((int(x) for x in self._names("pointers") if x.isdigit()), default=0)
            while True:
                number += 1
                try:
                    out = self._fs.create(self._at(f"pointers/{number:010d}"), False)
                except Py4JJavaError as e:
                    if "AlreadyExists" not in e.java_exception.getClass().getName():
                        raise
                    continue
                out.write(f"{folder}\n".encode())
                out.close()
                return number

    def expire(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions, once nobody reads them any more; how many went."""
        if keep < 1:
            raise ValueError("at least one version has to stay")
        old = self.versions()[:-keep]
        for n in old:
            folder = self._folder(n)
            self._fs.delete(self._at(f"pointers/{n:010d}"), False)
            self._fs.delete(self._at(f"versions/{folder.strip()}"), True)
        return len(old)
