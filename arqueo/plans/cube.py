"""A stored cube: totals of chosen levels, computed once, from which slices are answered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.operators.duplicates import tag_groups
from arqueo.plans.marts import AMOUNTS, amounts_by, sliced, total
from arqueo.sources.storage import remove_shared, shared_path


class Cube:
    """Levels (names with their columns) of summed amounts, in folders of their own.

    A slice is read from the smallest level that has its columns; the facts are read once, by
    :meth:`build`, whatever is asked later.
    """

    def __init__(self, stored: DataFrame, path: str, levels: dict[str, tuple[str, ...]], amounts: tuple[str, ...]):
        self.path, self.levels, self.amounts, self._stored = path, levels, amounts, stored
        counted = stored.groupBy("key_name").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each level
        self.sizes = {name: 0 for name in levels} | {r["key_name"]: r["n"] for r in counted}

    @classmethod
    def build(cls, facts: DataFrame, levels: dict[str, tuple[str, ...]], amounts: tuple[str, ...] = AMOUNTS, path: str | None = None) -> Cube:
        """Sum all levels by one exchange of grouping sets and write them, to ``path`` or the shared folder."""
        path = path or shared_path(facts.sparkSession)
        summed = tag_groups(facts, levels, *[total(a).alias(a) for a in amounts])
        summed.write.partitionBy("key_name").parquet(path)
        return cls(facts.sparkSession.read.schema(summed.schema).parquet(path), path, levels, amounts)

    def level_for(self, columns: set[str]) -> str:
        """The level with the fewest rows that has all the columns; of equal ones the first by name."""
        fitting = [name for name, own in self.levels.items() if columns <= set(own)]
        if not fitting:
            raise ValueError(f"no level has the columns {', '.join(sorted(columns))}")
        return min(fitting, key=lambda name: (self.sizes[name], name))

    def slice(self, by: list[str], **filters) -> DataFrame:
        """Amounts by the columns, of the rows that pass the filters (see :func:`sliced`)."""
        used = {c for c, v in filters.items() if v is not None}
        level = self.level_for(set(by) | used)
        rows = self._stored.where(F.col("key_name") == level).select(*self.levels[level], *self.amounts)
        return amounts_by(sliced(rows, **filters), by, self.amounts)

    def remove(self) -> None:
        """Delete the stored levels, once nothing reads them any more."""
        remove_shared(self._stored.sparkSession, self.path)
