"""Consolidation of a stream: each batch is merged into a published snapshot, exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arqueo.contracts import TOTAL
from arqueo.operators.consolidate import Grain, bad_amounts, normalise
from arqueo.sources.snapshots import Snapshots


def _digest(columns: list[str]):
    """Tells rows apart; nulls leave a hash as it is, so where they stand counts too."""
    marks = F.concat_ws("", *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.sha2(F.to_json(F.struct(marks.alias("m"), *columns)), 256)


def merge(store: Snapshots, batch: DataFrame, batch_id: int, grain: Grain) -> None:
    """Add a batch to the tables ``keys`` (a row for each key), ``seen`` (digests of all rows so far) and
    ``progress`` of a snapshot, which are published as one version.

    Rows equal to earlier ones are left out, in whatever batch these came; so are whole batches that are
    merged already, which a stream sends again after a failure. Attributes are the least values that are
    not null, as :func:`consolidate` has them. A batch with amounts that can't be read raises, and leaves the snapshot.
    """
    number = store.current()
    if number is not None and store.read("progress", number).first()["batch_id"] >= batch_id:
        return
    texts = tuple(c for c, t in batch.dtypes if c in grain.measures and t == "string")
    bad = sorted(r["column_name"] for r in bad_amounts(batch, Grain(grain.key, texts)).collect()) if texts else []
    if bad:
        raise ValueError(f"texts that are no amounts in: {', '.join(bad)}")
    rows = normalise(batch, grain)
    attributes = grain.attributes(rows.columns)
    rows = rows.withColumn("arqueo_digest", _digest(rows.columns)).dropDuplicates(["arqueo_digest"])
    if number is not None:
        rows = rows.join(store.read("seen", number), "arqueo_digest", "left_anti")
    parts = rows.select(*grain.key, *attributes, *[F.col(c).cast(TOTAL).alias(c) for c in grain.measures], F.lit(1).cast("bigint").alias("rows_merged"))
    seen = rows.select("arqueo_digest")
    if number is not None:
        parts, seen = store.read("keys", number).unionByName(parts), store.read("seen", number).unionByName(seen)
    keys = parts.groupBy(*grain.key).agg(
        *[F.min_by(c, F.struct(F.col(c).isNull(), F.col(c))).alias(c) for c in attributes],
        *[F.sum(c).cast(TOTAL).alias(c) for c in (*grain.measures,)],
        F.sum("rows_merged").alias("rows_merged"),
    )
    progress = batch.sparkSession.createDataFrame([(batch_id,)], "batch_id bigint")
    store.publish({"keys": keys, "seen": seen, "progress": progress})


def upsert_available(stream: DataFrame, store: Snapshots, grain: Grain, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Merge all that is new in a stream since the last run, and stop. The last two versions stay."""

    def each(batch: DataFrame, batch_id: int) -> None:
        merge(store, prepare(batch) if prepare else batch, batch_id, grain)
        store.expire(2)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
