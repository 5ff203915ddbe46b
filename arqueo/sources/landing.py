"""Landing checks: payloads, statuses, manifests, verification."""

from __future__ import annotations

import datetime
import hashlib
import http.client
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arqueo.sources.config import SourceSpec
from arqueo.sources.storage import remove_shared, write_shared_at

# Fixed values.
RETRY_STATUSES = (429, 500, 502, 503, 504)
VALID_STATUSES = ("success", "unchanged", "updated", "refreshed", "skipped_existing")
HEAD_BYTES = 512


def head_problem(head: Column, size: Column, expected_size: Column, file_format: Column) -> Column:
    """Why a payload is refused, by its first bytes and sizes, or null: empty, incomplete, html or no_delimiter.

    A null expected size is unknown.
    """
    text = F.lower(F.regexp_replace(F.decode(F.substring(head, 1, HEAD_BYTES), "ISO-8859-1"), r"^\s+", ""))
    return (
        F.when(size.isNull() | (size == 0), "empty")
        .when(expected_size != size, "incomplete")
        .when(text.startswith("<!doctype html") | text.startswith("<html"), "html")
        .when((F.lower(file_format) == "csv") & ~text.contains(","), "no_delimiter")
    )


def payload_problem(content: Column, expected_size: Column, file_format: Column) -> Column:
    """:func:`head_problem` of a payload (binary) that is there as a whole."""
    return head_problem(content, F.octet_length(content), expected_size, file_format)


def content_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256 of small files; the content of each is in one row."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", content_digest(F.col("content")).alias("sha256"))


def is_skipped(existed: Column, mutable: Column, force: Column) -> Column:
    """Files that exist are not fetched again, unless they may change or it is asked for."""
    return existed & ~mutable & ~force


def download_status(existed: Column, previous_hash: Column, new_hash: Column, force: Column) -> Column:
    """success for a first landing; then unchanged, refreshed (same bytes, forced) or updated."""
    return (
        F.when(~existed | previous_hash.isNull(), "success")
        .when(previous_hash != new_hash, "updated")
        .when(force, "refreshed")
        .otherwise("unchanged")
    )


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """The last event of each source by its recorded time; ties go to the greater hash."""
    order = [F.desc_nulls_last("recorded_at"), F.desc_nulls_last("sha256_hash")]
    place = F.row_number().over(Window.partitionBy("source_id").orderBy(*order))
    return manifests.withColumn("_place", place).where("_place = 1").drop("_place")


def verify(manifests: DataFrame, files: DataFrame, check_hash: bool = True) -> DataFrame:
    """source_id, file_exists, size_matches, hash_matches, reason, valid of each latest manifest.

    ``files`` has source_id, length, sha256. Without ``check_hash``, hash_matches is null, which
    is not false.
    """
    both = latest_manifests(manifests).join(files, "source_id", "left")
    exists = F.col("length").isNotNull()
    size = F.when(exists, F.col("length") == F.col("file_size_bytes"))
    same = F.when(exists, F.col("sha256") == F.col("sha256_hash")) if check_hash else F.lit(None).cast("boolean")
    reason = (
        F.when(~F.col("status").isin(*VALID_STATUSES), "status")
        .when(~exists, "missing_file")
        .when(~size, "size")
        .when(~F.coalesce(same, F.lit(True)), "hash")
    )
    checked = both.select(
        "source_id", exists.alias("file_exists"), size.alias("size_matches"), same.alias("hash_matches"), reason.alias("reason")
    )
    return checked.withColumn("valid", F.col("reason").isNull())


@dataclass(frozen=True)
class Fetched:
    """What a task knows of a payload that it has streamed to a file."""

    size: int
    expected: int | None
    content_type: str | None
    sha256: str
    head: bytes


def fetch(url: str, sink: Callable[[], BinaryIO], tries: int = 3, pause: float = 1.0, opener: Callable = urllib.request.urlopen) -> Fetched:
    """Stream a payload into a file that ``sink`` opens, anew for each try; hash and length are taken on the way.

    A body that ends early is no error here: its length differs from the expected one.
    """
    for attempt in range(1, tries + 1):
        try:
            with opener(url, timeout=300) as response, sink() as out:
                length, kind = response.headers.get("Content-Length"), response.headers.get("Content-Type")
                digest, size, head = hashlib.sha256(), 0, b""
                while block := response.read(1 << 20):
                    out.write(block)
                    digest.update(block)
                    size += len(block)
                    head = head or block[:HEAD_BYTES]
            return Fetched(size, int(length) if length else None, kind, digest.hexdigest(), head)
        except http.client.IncompleteRead as e:
            raise OSError(f"incomplete: {e}") from e
        except urllib.error.HTTPError as e:
            if e.code not in RETRY_STATUSES or attempt == tries:
                raise
        except OSError:
            if attempt == tries:
                raise
        time.sleep(pause * 2 ** (attempt - 1))
    raise AssertionError


MANIFEST_SCHEMA = (
    "source_id string, status string, reason string, file_path string, file_size_bytes bigint, sha256_hash string, "
    "previous_hash string, expected_size_bytes bigint, content_type string, recorded_at string"
)


def _digest(stream: BinaryIO) -> tuple[int, str]:
    """Length and SHA-256 of what is left of a stream, read in blocks."""
    size, h = 0, hashlib.sha256()
    while block := stream.read(1 << 20):
        size += len(block)
        h.update(block)
    return size, h.hexdigest()


def file_digest(path: Path) -> str:
    """SHA-256 of a file of any size, read in blocks."""
    with path.open("rb") as f:
        return _digest(f)[1]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute local path, in a task as on the driver."""
    return fs.FileSystem.from_uri(uri)


def _landed(path: str | None) -> tuple[int, str] | None:
    """Length and hash of a file, or None if there is none."""
    if not path:
        return None
    store, place = _place(path)
    if store.get_file_info(place).type != fs.FileType.File:
        return None
    with store.open_input_stream(place) as f:
        return _digest(f)


_FETCHED = (
    "source_id string, file_format string, target string, staged string, skipped boolean, existed boolean, previous string, previous_size bigint, "
    "error string, size bigint, expected bigint, content_type string, hash string, head binary"
)


def _fetch_rows(force: bool, tries: int, pause: float, opener: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.strip().split(" ")[0] for c in _FETCHED.split(",")]
        kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        schema = pa.schema([(c.strip().split(" ")[0], kinds[c.strip().split(" ")[1]]) for c in _FETCHED.split(",")])
        for batch in batches:
            for s in batch.to_pylist():
                before = _landed(s["target"])
                # Every attempt of a task has a file of its own; the driver's rename chooses one.
                row = dict.fromkeys(names) | {
                    "source_id": s["source_id"], "file_format": s["file_format"], "target": s["target"], "staged": f"{s['folder']}/{uuid.uuid4().hex}",
                    "skipped": before is not None and not s["mutable"] and not force, "existed": before is not None,
                    "previous": before and before[1], "previous_size": before and before[0],
                }
                if not row["skipped"]:
                    store, place = _place(row["staged"])
                    try:
                        got = fetch(s["url"], lambda: store.open_output_stream(place), tries, pause, opener)
                        row |= {"size": got.size, "expected": got.expected, "content_type": got.content_type, "hash": got.sha256, "head": got.head}
                    except OSError as e:
                        row["error"] = str(e)
                yield pa.RecordBatch.from_pylist([row], schema)

    return run


def land(
    spark: SparkSession, sources: list[SourceSpec], folder: str | Path, force: bool = False, tries: int = 3, pause: float = 1.0,
    opener: Callable = urllib.request.urlopen,
) -> DataFrame:
    """Land sources into ``folder`` (a path or URI that all executors share): one task for each source
    skips or streams it beside its place, with hash and length on the way; no byte passes the driver.

    A row of MANIFEST_SCHEMA for each source. The driver moves payloads that pass to their places, by
    name only. A payload that is refused, or a fetch that fails, leaves the file that was there, and
    has status ``failed`` with the reason. A task that runs again fetches again, into another file.
    """
    base = str(folder).rstrip("/")
    base = base if "://" in base else str(Path(base).absolute())
    store, place = _place(base)
    staging = f"{base}/.landing-{uuid.uuid4().hex}"
    store.create_dir(f"{place}/{staging.rsplit('/', 1)[1]}", recursive=True)
    schema = "source_id string, url string, file_format string, mutable boolean, target string, folder string"
    wanted = [(s.source_id, s.download_url, s.file_format, s.mutable, f"{base}/{s.source_id}.{s.file_format}", staging) for s in sources]
    tasks = spark.createDataFrame(spark.sparkContext.parallelize(wanted, max(len(wanted), 1)), schema)
    try:
        # Written, so that what follows doesn't fetch again.
        fetched, path = write_shared_at(tasks.mapInArrow(_fetch_rows(force, tries, pause, opener), _FETCHED))
        refused = head_problem(F.col("head"), F.coalesce("size", F.lit(0)), F.col("expected"), F.col("file_format"))
        changed = download_status(F.col("existed"), F.col("previous"), F.col("hash"), F.lit(force))
        reason = F.when(~F.col("skipped"), F.coalesce("error", refused))
        status = F.when(F.col("skipped"), "skipped_existing").when(reason.isNotNull(), "failed").otherwise(changed)
        judged = fetched.select("*", reason.alias("reason"), status.alias("status")).drop("head")
        rows, now = [], datetime.datetime.now(datetime.UTC).isoformat()
        for r in judged.collect():  # names and sizes, a row for each source of the configuration
            passed = r["status"] in ("success", "updated", "refreshed")
            if passed:
                store.move(_place(r["staged"])[1], _place(r["target"])[1])
            size, digest = (None, None) if r["status"] == "failed" else (r["previous_size"], r["previous"]) if r["skipped"] else (r["size"], r["hash"])
            rows.append((r["source_id"], r["status"], r["reason"], r["target"], size, digest, r["previous"], r["expected"], r["content_type"], now))
        remove_shared(spark, path)
    finally:
        store.delete_dir(f"{place}/{staging.rsplit('/', 1)[1]}")
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Add events to the manifest table, which is JSON lines and only grows."""
    manifest.coalesce(1).write.mode("append").json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def landed_files(spark: SparkSession, manifests: DataFrame) -> DataFrame:
    """source_id, length, sha256 of the files that the latest manifests name, read in blocks by a task for each."""
    kinds = pa.schema([("source_id", pa.string()), ("length", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = _landed(r["file_path"])
                if found:
                    yield pa.RecordBatch.from_pylist([{"source_id": r["source_id"], "length": found[0], "sha256": found[1]}], kinds)

    latest = latest_manifests(manifests).select("source_id", "file_path")
    return latest.repartition("source_id").mapInArrow(run, "source_id string, length bigint, sha256 string")
