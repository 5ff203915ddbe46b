"""Token ids in a compact file format: frequency ranks, byte-aligned, with separate control bytes.

Ids are replaced by their rank of frequency in the corpus, so that common ids need one byte. A
rank takes one to four bytes, little-endian; two bits for each rank, four to a control byte, say
how many. A file's rows are blocks of documents in ascending doc_id order: doc_ids and counts of
ids as little-endian integers, the control bytes (each document starts a new one), the data bytes.
The folder ``ranks`` beside them has the id of each rank. Reading decodes a whole block at once by
table lookup.

Files are Parquet with binary columns, written and read by Spark, so that any store serves and
lost tasks are run again.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arqueo.llm.common import job_settings, remove_dir, shared_dir, texts

#: Bytes used by a rank with length code c: the first c + 1 of four.
_USED = np.arange(4)[None, :] <= np.arange(4)[:, None]
#: The four length codes of each control byte.
_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])[None, :]) & 3

BLOCK_IDS = 1 << 18
#: Entries of the store of a worker's encoder; the older generation holds as many.
CACHED_WORDS = 450_000


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of one document's ranks (uint32)."""
    codes = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = codes
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[_USED[codes]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of a block's documents, one after another, by table lookup."""
    codes = _CODES[np.frombuffer(control, np.uint8)].reshape(-1)
    slots = -(-counts // 4) * 4
    ends = np.cumsum(slots)
    if len(counts):
        place = np.arange(len(codes)) - np.repeat(ends - slots, slots)
        codes = codes[place < np.repeat(counts, slots)]
    out = np.zeros((len(codes), 4), np.uint8)
    out[_USED[codes]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Recent(dict):
    """A dictionary that makes missing values and keeps about the last ``room`` used.

    When it is full it becomes the old generation; what is asked for again comes back from there.
    """

    def __init__(self, make: Callable[[bytes], bytes], room: int):
        super().__init__()
        self._make, self._room, self._old = make, room, {}

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= self._room:
            self._old = None
            self._old = dict(self)
            self.clear()
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never reach across white space.

    Each run between ASCII white space is encoded by the library and kept for a while; the tokens
    of a text are those of its runs, one after another. Runs of Latin letters with ASCII marks
    behind them, which normalising leaves as they are but for case, are made of their two pieces
    in lower case, of which letters go to the library's merge model; all other runs take its whole way, so that strings of special
    tokens in a text become these, as the library has it.
    """

    _PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._model = self._library.model
        self.size = self._library.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._shown = _byte_characters()
        self._words = _Recent(self._encode_word, CACHED_WORDS)

    def _encode_piece(self, piece: bytes) -> bytes:
        text = piece.decode() if piece.isascii() else "".join([self._shown[b] for b in piece])
        return array(self._code, [t.id for t in self._model.tokenize(text)]).tobytes()

    def _encode_word(self, word: bytes) -> bytes:
        words = self._words
        if word.isalpha():  # of ASCII letters
            return self._encode_piece(word) if word.islower() else words[word.lower()]
        plain = self._PLAIN.fullmatch(word)
        if plain:
            letters, marks = plain.groups()
            letters = letters.lower() if letters.isascii() else letters.decode().lower().encode()
            if marks:
                return words[letters] + words[marks]
            return self._encode_piece(word) if letters == word else words[letters]
        return array(self._code, self._library.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, items: list[bytes]) -> list[bytes]:
        """Packed ids of each text, in self.dtype."""
        words = self._words
        return [b"".join([words[w] for w in t.split()]) for t in items]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@dataclass(frozen=True)
class TokenFiles:
    """Where the files are."""

    path: str

    @property
    def blocks(self) -> str:
        return f"{self.path}/blocks"

    @property
    def ranks(self) -> str:
        return f"{self.path}/ranks"


_BLOCK_SCHEMA = (
    "shard int, block int, n_ids bigint, doc_ids binary, counts binary, control binary, data binary, null_ids binary"
)


def _encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id and packed ids; their low bytes stand before their high bytes, which packs better."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                packed = [_planes(x + end, enc.dtype.itemsize) for x in enc.encode(texts(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary")


def _planes(packed: bytes, size: int) -> bytes:
    return np.frombuffer(packed, np.uint8).reshape(-1, size).T.tobytes()


def _unplanes(packed: bytes, dtype: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def _frequencies(encoded: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """How often each id occurs; at most one row for each id comes from a task, and to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column("ids").to_pylist():
                total += np.bincount(_unplanes(x, dtype), minlength=size) if len(x) > size else 0
                if len(x) <= size:
                    np.add.at(total, _unplanes(x, dtype), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in counted.collect():
        out[r["id"]] = r["n"]
    return out


def write(docs: DataFrame, tokenizer_path: str, end_id: int) -> TokenFiles:
    """Encode every whole text, append ``end_id``, and write all ids in ascending doc_id order.

    Null and empty texts have the end id alone. Rows with one doc_id are ordered by their coded
    ids; null doc_ids come first. Other columns are ignored; an empty table gives files without
    blocks. The ids are encoded once and kept in the shared folder while they are counted.
    """
    with job_settings(docs.sparkSession):
        return _write(docs, tokenizer_path, end_id)


def _write(docs: DataFrame, tokenizer_path: str, end_id: int) -> TokenFiles:
    spark = docs.sparkSession
    enc = encoder(tokenizer_path)
    dtype = enc.dtype
    size = max(enc.size, end_id + 1)
    packed_path = shared_dir(spark)
    _encoded(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(packed_path)
    packed = spark.read.schema("doc_id bigint, ids binary").parquet(packed_path)
    frequency = _frequencies(packed, size, dtype)
    id_of_rank = np.lexsort((np.arange(size), -frequency)).astype(np.int32)
    rank_of_id = np.empty(size, np.uint32)
    rank_of_id[id_of_rank] = np.arange(size, dtype=np.uint32)

    # The ranges are found from the ids alone, so that the texts are coded once.
    bounds = _range_bounds(packed.select("doc_id"), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, control, data = [], [], []
            doc_ids = batch.column("doc_id")
            shards = np.searchsorted(bounds, doc_ids.fill_null(0).to_numpy(), "right") * doc_ids.is_valid().to_numpy(False)
            for x in batch.column("ids").to_pylist():
                ranks = rank_of_id[_unplanes(x, dtype)]
                c, d = encode_ranks(ranks)
                counts.append(len(ranks))
                control.append(c)
                data.append(d)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts, pa.int32()), pa.array(control, pa.binary()), pa.array(data, pa.binary()), pa.array(shards.astype(np.int32))],
                ["doc_id", "n", "control", "data", "shard"],
            )

    coded = packed.mapInArrow(code, "doc_id bigint, n int, control binary, data binary, shard int")
    ordered = coded.repartitionById(len(bounds) + 1, F.col("shard"))
    ordered = ordered.sortWithinPartitions("doc_id", "n", "control", "data")
    files = TokenFiles(shared_dir(spark))
    ordered.mapInArrow(_blocks, _BLOCK_SCHEMA).write.option("compression", "none").parquet(files.blocks)
    ranks = [(i, int(x)) for i, x in enumerate(id_of_rank)]
    spark.createDataFrame(ranks, "rank int, id int").coalesce(1).write.parquet(files.ranks)
    remove_dir(spark, packed_path)
    return files


def _range_bounds(ids: DataFrame, n: int) -> list[int]:
    """At most n - 1 ascending bounds that part the ids about evenly."""
    if n <= 1:
        return []
    found = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (8 * n))
    return sorted({int(x) for x in found})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gather consecutive documents into blocks of about BLOCK_IDS ids."""
    shard, block, rows, held = TaskContext.get().partitionId(), 0, [], 0

    def out() -> pa.RecordBatch:
        doc_ids = np.array([r[0] or 0 for r in rows], "<i8").tobytes()
        nulls = np.array([r[0] is None for r in rows], np.uint8).tobytes()
        counts = np.array([r[1] for r in rows], "<u4").tobytes()
        row = {
            "shard": [shard], "block": [block], "n_ids": [held], "doc_ids": [doc_ids], "counts": [counts],
            "control": [b"".join(r[2] for r in rows)], "data": [b"".join(r[3] for r in rows)], "null_ids": [nulls],
        }
        types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], list(row))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "n", "control", "data")]
        for row in zip(*columns, strict=True):
            rows.append(row)
            held += row[1]
            if held >= BLOCK_IDS:
                yield out()
                block, rows, held = block + 1, [], 0
    if rows:
        yield out()


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the files.

    start counts the ids of all documents before it. Shard and block totals give the offsets; only
    the one row of each shard meets in a single task.
    """
    blocks = spark.read.parquet(files.blocks)
    ranks = spark.read.parquet(files.ranks).collect()  # one row for each id of the vocabulary
    id_of_rank = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of_rank[r["rank"]] = r["id"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                ids = id_of_rank[decode_ranks(r["control"], r["data"], counts)]
                ends = np.cumsum(counts)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - counts, ends, strict=True)]
                n = len(counts)
                doc_ids = pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=np.frombuffer(r["null_ids"], np.uint8) > 0)
                columns = [
                    pa.array(np.full(n, r["shard"]), pa.int32()), pa.array(np.full(n, r["block"]), pa.int32()),
                    doc_ids, pa.array(ends - counts), pa.array(counts), pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    decoded = blocks.mapInArrow(
        decode, "shard int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sizes = blocks.select("shard", "block", "n_ids")
    before = Window.unboundedPreceding, -1
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(*before)), F.lit(0)).alias("shard_start")
    )
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(*before)
    starts = sizes.join(shards, "shard").select(
        "shard", "block", (F.col("shard_start") + F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0))).alias("block_start")
    )
    return decoded.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
