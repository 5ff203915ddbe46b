"""Byte-level BPE encoding and decoding by a monoid tree reduction.

A text is cut in halves until the parts are small; the parts are encoded alone, and neighbours
are joined from the leaves up. A join re-encodes a window around the border. The window grows
until it has, on either side, a place where a non-space character is followed by a space or a
line feed: no match of the split pattern reaches across such a place, whatever surrounds it, so
the tokens beyond it are those of the whole text. Decoding concatenates the token bytes up the
same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from arqueo.llm.common import map_texts

LEAF_CHARS = 8192
FIRST_WINDOW = 32
_BORDER = re.compile(r"\S(?=[ \n])")


class ByteBpe:
    """Encoder and decoder of one rank file; ``pattern`` splits text before the merges."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self._flat = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {i: b for b, i in ranks.items()}
        self._leaf = max(2, leaf_chars)

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, a: int, b: int) -> list[int]:
        if b - a <= self._leaf:
            return self._flat.encode_ordinary(text[a:b])
        mid = (a + b) // 2
        return self._join(text, a, mid, b, self._encode(text, a, mid), self._encode(text, mid, b))

    def _join(self, text: str, a: int, mid: int, b: int, left: list[int], right: list[int]) -> list[int]:
        low = self._settled_before(text, a, mid)
        high = self._settled_after(text, mid, b)
        n_left = self._tokens_back(left, len(text[low:mid].encode()))
        n_right = self._tokens_on(right, len(text[mid:high].encode()))
        middle = self._flat.encode_ordinary(text[low:high])
        return [*left[: len(left) - n_left], *middle, *right[n_right:]]

    @staticmethod
    def _settled_before(text: str, a: int, mid: int) -> int:
        """The last certain border in text[a:mid], or a."""
        width = FIRST_WINDOW
        while True:
            low = max(a, mid - width)
            found = None
            for found in _BORDER.finditer(text, low, mid):
                pass
            if found:
                return found.end()
            if low == a:
                return a
            width *= 2

    @staticmethod
    def _settled_after(text: str, mid: int, b: int) -> int:
        """The first certain border in text[mid:b], or b."""
        width = FIRST_WINDOW
        while True:
            high = min(b, mid + width)
            found = _BORDER.search(text, mid, high)
            if found:
                return found.end()
            if high == b:
                return b
            width *= 2

    def _tokens_back(self, tokens: list[int], n_bytes: int) -> int:
        n = 0
        while n_bytes > 0:
            n += 1
            n_bytes -= len(self._bytes[tokens[-n]])
        assert n_bytes == 0, "a token crosses a certain border"
        return n

    def _tokens_on(self, tokens: list[int], n_bytes: int) -> int:
        n = 0
        while n_bytes > 0:
            n_bytes -= len(self._bytes[tokens[n]])
            n += 1
        assert n_bytes == 0, "a token crosses a certain border"
        return n

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The bytes of ``ids``: leaves are looked up, then neighbours are concatenated."""
        table = self._bytes
        parts = [b"".join([table[i] for i in ids[k : k + 4096]]) for k in range(0, len(ids), 4096)]
        while len(parts) > 1:
            parts = [b"".join(parts[k : k + 2]) for k in range(0, len(parts), 2)]
        return parts[0] if parts else b""


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> ByteBpe:
    """One codec for each Python worker."""
    return ByteBpe(ranks_path, pattern)


@lru_cache(maxsize=1)
def _decimal(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and ``ids`` (array<int>), the tokens of the whole ``text``.

    A null or empty text has no ids. Rows are independent: ties and repeated rows are encoded
    alike, other columns are left out, and one of ``keep`` named ids is replaced. A text is
    processed whole whatever its length.
    """
    keep = [c for c in keep if c != "ids"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "ids array<int>"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        for a, part in _slices(batch):
            ids = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
            columns = [part.column(c) for c in keep] + [pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids"])

    return map_texts(docs.select(*dict.fromkeys([*keep, "text"])), schema, run)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[int, pa.RecordBatch]]:
    for a in range(0, batch.num_rows, rows):
        yield a, batch.slice(a, rows)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode each text, decode its ids, and digest both: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are taken where the ids are made, so the ids themselves are not moved.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe, decimal = codec(ranks_path, pattern), _decimal(1 << 16)
        name = lambda i: decimal[i] if i < len(decimal) else str(i)
        for _, part in _slices(batch):
            counts, coded, plain = [], [], []
            for t in part.column("text").to_pylist():
                ids = bpe.encode(t or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                plain.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded), pa.array(plain)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), schema, run)
