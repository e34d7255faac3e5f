"""Byte-level BPE encoding and decoding (operator 9).

A text is cut into pre-tokens by the vocabulary's published pattern; each
pre-token starts as a doubly linked list of byte symbols, and a priority queue
of merge ranks joins neighbours, lowest rank first and leftmost on ties.
Queue entries whose symbols have changed meanwhile are stale and skipped, so a
pre-token of n bytes costs O(n log n) however long it is.  Decoding
concatenates vocabulary strings and reads the bytes as UTF-8.

The vocabulary file is a parameter (a ``tokenizers`` JSON file readable at the
same path on every executor); it is loaded once per Python worker.

Defined results: a null or empty text has no ids and decodes to ``""``; every
input row gives one output row, repeated rows and null ids included; columns
other than the id and the text are ignored.  Special tokens written inside a
text become their own id, as the library does by default.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import worker_state

# Fixed value: the published split pattern of byte-level BPE vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same split for texts of Latin characters alone, where the standard module's classes agree
# with the pattern's; other texts take the full pattern.
LATIN_PATTERN = r"""'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+"""
NOT_LATIN = "[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u024f]"
ID_BITS = 20
# Encoded pre-tokens kept per Python worker, in each of two generations: their number and bytes.
CACHE_ENTRIES = 250_000
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 200
CACHE_TOKEN_BYTES = 256
# Bytes of text per output batch.
BATCH_BYTES = 2 << 20


def byte_symbols() -> list[str]:
    """The printable character standing for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def category_class(first: str) -> str:
    """A character class, without brackets, of the code points in the categories of ``first``.

    The regex module counts some unassigned code points as letters, so the
    classes are spelt out from ``unicodedata``.
    """
    out = []
    for inside, run in itertools.groupby(range(0x110000),
                                         lambda c: unicodedata.category(chr(c))[0] == first):
        if inside:
            run = list(run)
            out.append(f"\\U{run[0]:08x}-\\U{run[-1]:08x}")
    return "".join(out)


class ByteBpe:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, model = spec["model"]["vocab"], spec["model"]
        symbols = byte_symbols()
        self.byte_ids = [vocab[s] for s in symbols]
        to_byte = {s: b for b, s in enumerate(symbols)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.strings: dict[int, bytes] = {
            i: bytes(to_byte[c] for c in s) for s, i in vocab.items()
            if i not in self.added.values()}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        # (left id, right id) -> rank and merged id, packed so that packed values sort by rank.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << ID_BITS | vocab[right]] = \
                rank << ID_BITS | vocab[left + right]
        self.special = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.added, key=len, reverse=True))) \
            if self.added else None
        self.split_latin, self.unusual = re.compile(LATIN_PATTERN), re.compile(NOT_LATIN)
        # Two generations: what is used again moves to the newer one, the rest is let go.
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept_bytes = 0

    @functools.cached_property
    def split(self) -> regex.Pattern:
        letters, numbers = category_class("L"), category_class("N")
        return regex.compile(
            SPLIT_PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
            .replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]"))

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        byte_ids, merge = self.byte_ids, self.merges.get
        ids = [byte_ids[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        shift = n.bit_length()
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            hit = merge(ids[i] << ID_BITS | ids[i + 1])
            if hit is not None:
                queue.append(hit << shift | i)
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            i, packed = top & (1 << shift) - 1, top >> shift
            j = after[i]
            if j >= n or ids[i] < 0 or merge(ids[i] << ID_BITS | ids[j]) != packed:
                continue  # stale: one of the two symbols was merged meanwhile
            ids[i], ids[j] = packed & (1 << ID_BITS) - 1, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                hit = merge(ids[i] << ID_BITS | ids[k])
                if hit is not None:
                    heapq.heappush(queue, hit << shift | i)
            h = before[i]
            if h >= 0:
                hit = merge(ids[h] << ID_BITS | ids[i])
                if hit is not None:
                    heapq.heappush(queue, hit << shift | h)
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> bytes:
        got = self.older.pop(piece, None)
        if got is None:
            data = piece.encode()
            got = np.array(self.merge(data), np.int32).tobytes()
            if len(data) > CACHE_TOKEN_BYTES:
                return got
        if len(self.newer) >= CACHE_ENTRIES or self.kept_bytes >= CACHE_BYTES:
            self.older, self.newer, self.kept_bytes = self.newer, {}, 0
        self.newer[piece] = got
        self.kept_bytes += ENTRY_BYTES + len(piece) + len(got)
        return got

    def _plain(self, text: str) -> bytes:
        split = self.split if self.unusual.search(text) else self.split_latin
        seen, miss = self.newer.get, self._piece
        return b"".join([seen(p) or miss(p) for p in split.findall(text)])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._plain(text), np.int32)
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append(self._plain(text[at:m.start()]))
            out.append(np.int32(self.added[m.group()]).tobytes())
            at = m.end()
        out.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def load(path: str) -> ByteBpe:
    return worker_state("byte bpe", path, lambda: ByteBpe(path))


def _id_field(df: DataFrame, id_col: str) -> T.StructField:
    return T.StructField(id_col, df.schema[id_col].dataType)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list]]:
    """Ids and values of slices of a batch, of at most ``BATCH_BYTES`` or one row."""
    ids, values = batch.column(0), batch.column(1)
    start = used = 0
    for i, n in enumerate(pc.binary_length(values).to_pylist() if pa.types.is_string(values.type)
                          else pc.multiply(pc.list_value_length(values), 4).to_pylist()):
        if i > start and used + (n or 0) > BATCH_BYTES:
            yield ids.slice(start, i - start), values.slice(start, i - start).to_pylist()
            start, used = i, 0
        used += n or 0
    if start < len(values):
        yield ids.slice(start), values.slice(start).to_pylist()


def _list_array(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id, ids array<int>`` for every row of ``docs``."""
    schema = T.StructType([_id_field(docs, id_col), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for ids, texts in _slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [ids, _list_array([bpe.encode(t) for t in texts])], [id_col, "ids"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``id, ids, decoded string`` for every row of ``encoded``; null ids decode to ``""``."""
    schema = T.StructType([_id_field(encoded, id_col),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for ids, part in _slices(batch):
                rows = [np.array(r or [], np.int32) for r in part]
                yield pa.RecordBatch.from_arrays(
                    [ids, _list_array(rows),
                     pa.array([bpe.decode(r or []) for r in part], pa.string())],
                    [id_col, "ids", "decoded"])

    return encoded.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``id, ids, decoded``: :func:`encode` and :func:`decode` in one pass of the Python workers."""
    schema = T.StructType([_id_field(docs, id_col),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for ids, texts in _slices(batch):
                rows = [bpe.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ids, _list_array(rows),
                     pa.array([bpe.decode(r.tolist()) for r in rows], pa.string())],
                    [id_col, "ids", "decoded"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of the rows of :func:`decode`."""
    return coded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
