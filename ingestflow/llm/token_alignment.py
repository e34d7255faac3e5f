"""Cross-tokenizer alignment by external spill counting (operator 11).

Every text, with one space before it, is encoded by two vocabularies A and B.
Byte offsets where a token of each ends cut both token lists into groups; an
A token and a B token of one group are linked.  A pair of ids counts the
documents that hold it linked, over the whole corpus.

* **Spill.**  A task gathers (pair, document) records until ``RUN_LINKS`` links
  are held, sorts them, and spills them as one run: per radix (A's id modulo
  ``radixes``) the sorted distinct pairs with their document counts (``heads``)
  and the documents with their multiplicities (``bodies``), both zstd-packed.
  The runs are rows of a written table; Spark's shuffle deals them by radix.
* **Count.**  The heads of a radix are joined by a k-way heap merge.  A radix
  of more than ``TARGET_BYTES`` is dealt over several tasks by a salt on the
  runs and merged again ``FAN_IN`` at a time, so a frequent id or a group of
  copies never makes one task's input large: a run brings a pair once, however
  many of its documents hold it.
* **Maxima.**  Pairs are ordered by A's id first, so the last merge sees all
  pairs of an A id in a row and marks those with its highest count.
* **Back.**  The runs, salted in the same way, meet the counts of their radix;
  each run streams back one dense array of sums for its documents, and the
  arrays of a run are added up.

Where no token of either vocabulary can cross them, texts are cut at blanks
between plain characters; the distinct pieces of many texts are then encoded in
a row, and short pieces' groups are kept per worker (``Aligner``).  Otherwise
texts are encoded whole.

Both files are parameters, readable at the same path on every executor: A a
``tokenizers`` JSON file of byte-level BPE, B a ``sentencepiece`` model.

Defined results: every input row is a document of its own, with a row in the
result, repeated rows and null ids included; a text that is null, empty, or
not given back byte for byte by both encoders has no tokens, zeros and ``''``;
special strings inside texts are plain text; other columns are ignored.  One
document's distinct pairs are held in one task, like its text.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.bpe import byte_symbols
from ingestflow.llm.common import Workspace, worker_state

RADIXES = 64
# Links and documents of one run, and its place bits.
RUN_LINKS = 3_000_000
PLACE_BITS = 20
# Packed bytes of runs that one task merges, and merged results that one task merges again.
TARGET_BYTES = 16 << 20
FAN_IN = 32
# Bytes of text handled at once, bytes of kept pieces per generation, longest kept piece.
SLICE_CHARS = 1 << 22
CACHE_BYTES = 24 << 20
CACHE_CHARS = 64
# Links of one group beyond which its distinct ids are paired, not its tokens.
WIDE_GROUP = 1 << 16
COUNTS_CHUNK = 1 << 20

# A blank next to anything but a letter, digit or printable ASCII character, or at an end.
NOT_PLAIN_BLANK = re.compile(r"[^\w!-~] | [^\w!-~]|^ | $")
PLAIN_BLANK = re.compile(r"(?<=[\w!-~])(?= +[\w!-~])")


class Aligner:
    """Groups and links of texts under two vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        a = Tokenizer.from_file(path_a)
        a.encode_special_tokens = True
        a.no_truncation()
        a.no_padding()
        b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.encode_a = lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
        self.encode_b = lambda texts: b.encode(texts, num_threads=1)
        to_byte = {s: k for k, s in enumerate(byte_symbols())}
        self.bytes_a = [b""] * a.get_vocab_size(with_added_tokens=True)
        for piece, k in a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[k] = bytes(to_byte[c] for c in piece) if all(c in to_byte for c in piece) \
                else piece.encode()
        self.bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k)
                        else b.id_to_piece(k).replace("▁", " ").encode()
                        for k in range(b.vocab_size())]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in of]) for of in (self.bytes_a, self.bytes_b))
        names = [str(k) for k in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.plain, self.comma, self.bar, self.semicolon = (
            np.array([n + sign for n in names], object) for sign in ("", ",", "|", ";"))
        self.shift = max(1, (len(self.bytes_b) - 1).bit_length())
        self.bits = self.shift + max(1, (len(self.bytes_a) - 1).bit_length())
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("pre_tokenizer") or {}
        # A starts a token at a blank after a plain character, and so does B if no piece has a
        # blank inside; B must put the blank before every text by itself.
        self.cuts = spec.get("normalizer") is None and steps.get("type") == "ByteLevel" \
            and steps.get("use_regex", True) and not steps.get("add_prefix_space") \
            and not any(b" " in x.lstrip(b" ") for x in self.bytes_b) \
            and b"".join(self.bytes_b[k] for k in b.encode("a  b")) == b" a  b"
        # Piece -> (groups as text, codes of its links, its four sums in one integer), or None
        # for a piece that is not given back; two generations, the older is let go.
        self.newer: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.kept_bytes = 0

    def _new(self, pieces: list[str]) -> dict[str, tuple | None]:
        """The groups of pieces, or None for those that are not given back."""
        # Pieces that end in a plain character are encoded in a row, as in a text (B is quicker
        # on many short ones).
        row, single = [], []
        for p in pieces:
            c = p[-1]
            (row if self.cuts and ("!" <= c <= "~" or c.isalnum()) else single).append(p)
        out: dict[str, tuple | None] = {}
        if row:
            whole = " " + " ".join(row)
            [a], of_b = self.encode_a([whole]), self.encode_b(row)
            a, b = np.array(a, np.int64), np.fromiter(itertools.chain.from_iterable(of_b), np.int64)
            n_b = np.fromiter(map(len, of_b), np.int64)
            ends = np.cumsum([len(p.encode()) + 1 for p in row])
            n_a = self._counts(a, self.sizes_a, ends)
            if n_a is None or not n_b.all() or (np.cumsum(self.sizes_b[b])[np.cumsum(n_b) - 1] != ends).any() \
                    or not self._is(whole, a, b):
                single += row
            else:
                out.update(zip(row, self._groups(a, b, n_a, n_b), strict=True))
        kept: list[tuple[str, list[int], list[int]]] = []
        if single:
            encoded = zip(self.encode_a([" " + p for p in single]), self.encode_b(single), strict=True)
            for p, (a, b) in zip(single, encoded, strict=True):
                if a and b and self._is(" " + p, a, b):
                    kept.append((p, a, b))
                else:
                    out[p] = None
        if kept:
            names, of_a, of_b = zip(*kept, strict=True)
            a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (of_a, of_b))
            n_a, n_b = (np.fromiter(map(len, x), np.int64) for x in (of_a, of_b))
            out.update(zip(names, self._groups(a, b, n_a, n_b), strict=True))
        return out

    @staticmethod
    def _counts(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Tokens of each piece of a row; None if a token crosses from one to the next."""
        upto = np.cumsum(sizes[ids])
        at = np.searchsorted(upto, ends)
        if at[-1] >= len(ids) or (upto[at] != ends).any():
            return None
        return np.diff(at + 1, prepend=0)

    def _is(self, text: str, a, b) -> bool:
        """Whether the tokens of both encoders join to the text."""
        a, b = (x.tolist() if isinstance(x, np.ndarray) else x for x in (a, b))
        whole = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))

    def _groups(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[tuple]:
        """The groups of pieces whose tokens are ``a`` and ``b``, for all of them at once."""
        # The bytes of a piece are as many on both sides, so offsets run on from piece to piece.
        end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        cuts = end_a[end_b[np.searchsorted(end_b, end_a)] == end_a]
        of_a, of_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        held_a, held_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        upto_a, upto_b = np.cumsum(held_a), np.cumsum(held_b)
        links = held_a * held_b
        last = np.searchsorted(cuts, end_a[np.cumsum(n_a) - 1]) + 1  # groups up to each piece's end
        groups = np.diff(last, prepend=0)
        n_links = np.add.reduceat(links, last - groups)
        # Links of all but wide groups: each A token with every B token of its group.
        is_wide = links > WIDE_GROUP
        times = np.where(is_wide, 0, held_b)[of_a]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        codes = np.repeat(a, times) << self.shift | b[np.repeat((upto_b - held_b)[of_a], times) + nth]
        link_ends = np.cumsum(np.add.reduceat(np.where(is_wide, 0, links), last - groups)).tolist()
        wide: dict[int, list] = {}
        for g in np.flatnonzero(is_wide).tolist():
            wide.setdefault(int(np.searchsorted(last, g, "right")), []).append(
                (a[upto_a[g] - held_a[g]:upto_a[g]], b[upto_b[g] - held_b[g]:upto_b[g]]))
        # A group's text is its A ids, then its B ids; each id brings the sign after it.
        parts = np.empty(len(a) + len(b), object)
        ends_a = np.arange(len(a)) == upto_a[of_a] - 1
        ends_b = np.arange(len(b)) == upto_b[of_b] - 1
        ends_piece = np.zeros(len(b), bool)
        ends_piece[np.cumsum(n_b) - 1] = True
        parts[np.arange(len(a)) + (upto_b - held_b)[of_a]] = np.where(ends_a, self.bar[a], self.comma[a])
        parts[np.arange(len(b)) + upto_a[of_b]] = np.where(
            ends_piece, self.plain[b], np.where(ends_b, self.semicolon[b], self.comma[b]))
        texts, text_ends = parts.tolist(), np.cumsum(n_a + n_b).tolist()
        sums = [w | x << 40 | y << 80 | z << 120 for w, x, y, z in zip(
            n_a.tolist(), n_b.tolist(), groups.tolist(), n_links.tolist(), strict=True)]
        out, i, j = [], 0, 0
        for k, (x, y, total) in enumerate(zip(text_ends, link_ends, sums, strict=True)):
            out.append(("".join(texts[i:x]), codes[j:y].tobytes(), total, wide.get(k)))
            i, j = x, y
        return out

    def pieces(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if not NOT_PLAIN_BLANK.search(text):
            return text.split(" ")
        # every further piece starts with the blank that the encoders are given anyway
        first, *rest = PLAIN_BLANK.split(text)
        return [first, *(p[1:] for p in rest)]

    def known(self, wanted: set[str]) -> dict[str, tuple | None]:
        out = {p: self.newer[p] for p in wanted & self.newer.keys()}
        again = {p: self.older[p] for p in (wanted - out.keys()) & self.older.keys()}
        new = list(wanted - out.keys() - again.keys())
        if new:
            again.update(self._new(new))
        out.update(again)
        for p, got in again.items():
            if len(p) <= CACHE_CHARS:
                self.newer[p] = got
                self.kept_bytes += 350 + len(p) + (len(got[0]) + len(got[1]) if got else 0)
        if self.kept_bytes > CACHE_BYTES:
            self.older, self.newer, self.kept_bytes = self.newer, {}, 0
        return out

    def align(self, texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, list, int]]:
        """Of each text: groups as text, codes of its links, its wide groups, its sums."""
        cut = [self.pieces(t) if t else [] for t in texts]
        known = self.known(set().union(*cut))
        lost = {p for p, got in known.items() if got is None}
        shown = {p: got[0] for p, got in known.items() if got}
        codes = {p: got[1] for p, got in known.items() if got}
        sums = {p: got[2] for p, got in known.items() if got}
        broad = {p: got[3] for p, got in known.items() if got and got[3]}
        for pieces in cut:
            if lost and not lost.isdisjoint(pieces):
                pieces = []
            yield (";".join(map(shown.__getitem__, pieces)),
                   np.frombuffer(b"".join(map(codes.__getitem__, pieces)), np.int64),
                   [g for p in pieces if p in broad for g in broad[p]] if broad else [],
                   sum(map(sums.__getitem__, pieces)))


def load(path_a: str, path_b: str) -> Aligner:
    return worker_state("aligner", (path_a, path_b), lambda: Aligner(path_a, path_b))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as zstd over byte planes."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in planes))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    planes = data.reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def pack_heads(codes: np.ndarray, counts: np.ndarray) -> bytes:
    return pack(np.diff(codes, prepend=0), counts)


def unpack_heads(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(blob, 2)
    return np.cumsum(steps), counts


class Spill:
    """The records of one run being gathered."""

    def __init__(self, aligner: Aligner, radixes: int):
        self.shift, self.bits, self.radixes = aligner.shift, aligner.bits, radixes
        self.keys: list[np.ndarray] = []
        self.wide: list[tuple[np.ndarray, np.ndarray]] = []
        self.links = self.docs = 0

    def _key(self, codes: np.ndarray) -> np.ndarray:
        radix = (codes >> self.shift) % self.radixes
        return (radix << self.bits | codes) << PLACE_BITS | self.docs

    def add(self, codes: np.ndarray, wide: list) -> None:
        if len(codes):
            self.keys.append(self._key(codes))
            self.links += len(codes)
        for of_a, of_b in wide:
            a, times_a = np.unique(np.array(of_a, np.int64), return_counts=True)
            b, times_b = np.unique(np.array(of_b, np.int64), return_counts=True)
            self.wide.append((self._key(np.bitwise_or.outer(a << self.shift, b).ravel()),
                              np.multiply.outer(times_a, times_b).ravel()))
            self.links += len(a) * len(b)
        self.docs += 1

    def full(self) -> bool:
        return self.links >= RUN_LINKS or self.docs >> PLACE_BITS

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(radix, heads, bodies) of the gathered records."""
        if not self.links:
            return
        keys = np.concatenate([*self.keys, *(k for k, _ in self.wide)])
        if self.wide:
            times = np.concatenate([np.ones(sum(map(len, self.keys)), np.int64), *(t for _, t in self.wide)])
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
        else:
            keys.sort()
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times, starts) if self.wide \
            else np.diff(starts, append=len(keys))
        keys = keys[starts]
        places, codes = keys & (1 << PLACE_BITS) - 1, keys >> PLACE_BITS
        heads = np.flatnonzero(np.diff(codes, prepend=-1))
        counts = np.diff(heads, append=len(codes))
        radix_of = codes[heads] >> self.bits
        distinct = codes[heads] & (1 << self.bits) - 1
        ends = np.append(heads, len(codes))
        for radix in range(self.radixes):
            x, y = np.searchsorted(radix_of, [radix, radix + 1])
            if x < y:
                a, b = ends[x], ends[y]
                yield (radix, pack_heads(distinct[x:y], counts[x:y]),
                       pack(np.diff(places[a:b], prepend=0), times[a:b]))


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = used = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and used + n > SLICE_CHARS:
            yield start, i
            start, used = i, 0
        used += n
    if start < len(texts):
        yield start, len(texts)


RUN_FIELDS = "run long, place int, n_a long, n_b long, n_groups long, n_links long, groups string, " \
             "radix int, heads binary, bodies binary, n_docs int"


def spill(docs: DataFrame, path_a: str, path_b: str, ws: Workspace, id_col: str = "doc_id",
          text_col: str = "text", radixes: int = RADIXES,
          shown: Callable[[str], str] | None = None) -> DataFrame:
    """The written table of documents (``radix`` null) and runs.

    ``groups`` holds ``shown(groups)`` of the documents with tokens; the default is
    the groups themselves.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType, True),
                           *T._parse_datatype_string(RUN_FIELDS).fields])

    def run_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(path_a, path_b)
        held, run = Spill(aligner, radixes), TaskContext.get().partitionId() << 31

        def table(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(n, t.type)
                 for f, t in zip(schema.fields, arrow, strict=True)], names=schema.names)

        def spilled() -> Iterator[pa.RecordBatch]:
            for radix, heads, bodies in held.runs():
                yield table(1, {"run": pa.array([run]), "radix": pa.array([radix], pa.int32()),
                                "heads": pa.array([heads], pa.binary()),
                                "bodies": pa.array([bodies], pa.binary()),
                                "n_docs": pa.array([held.docs], pa.int32())})

        arrow = None
        mask = (1 << 40) - 1
        for batch in batches:
            if arrow is None:
                kinds = {"run": pa.int64(), "place": pa.int32(), "groups": pa.string(), "radix": pa.int32(),
                         "heads": pa.binary(), "bodies": pa.binary(), "n_docs": pa.int32()}
                arrow = [pa.field(f.name, batch.schema.field(0).type if k == 0 else kinds.get(f.name, pa.int64()))
                         for k, f in enumerate(schema.fields)]
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                runs, places, groups, sums = [], [], [], []
                for text, codes, wide, total in aligner.align(texts[a:b]):
                    runs.append(run)
                    places.append(held.docs)
                    groups.append(shown(text) if shown and text else text)
                    sums.append(total)
                    held.add(codes, wide)
                    if held.full():
                        yield from spilled()
                        held, run = Spill(aligner, radixes), run + 1
                yield table(b - a, {
                    id_col: batch.column(0).slice(a, b - a),
                    "run": pa.array(runs, pa.int64()), "place": pa.array(places, pa.int32()),
                    "groups": pa.array(groups, pa.string()),
                    **{name: pa.array([s >> shift & mask for s in sums], pa.int64())
                       for name, shift in (("n_a", 0), ("n_b", 40), ("n_groups", 80), ("n_links", 120))}})
        if arrow is not None:
            yield from spilled()

    return ws.write(docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run_of, schema),
                    "spilled")


def _merged(blobs: list[bytes]) -> Iterator[tuple[int, int]]:
    """(pair, documents) of all runs, pairs ascending: a k-way heap merge of their heads."""
    def run(blob: bytes) -> Iterator[tuple[int, int]]:
        codes, counts = unpack_heads(blob)
        return zip(codes.tolist(), counts.tolist(), strict=True)

    for code, same in itertools.groupby(heapq.merge(*map(run, blobs)), key=lambda x: x[0]):
        yield code, sum(n for _, n in same)


def _merge_runs(group: pa.Table) -> pa.Table:
    pairs = list(_merged(group["heads"].to_pylist()))
    heads = pack_heads(np.array([c for c, _ in pairs], np.int64), np.array([n for _, n in pairs], np.int64))
    return pa.table({"radix": group["radix"][:1], "salt": group["salt"][:1],
                     "heads": pa.array([heads], pa.binary())})


def _marked(blobs: list[bytes], shift: int) -> Iterator[tuple[int, int, bool]]:
    """(pair, documents, whether no pair of its A id has more): one A id after the other."""
    for _, of_a in itertools.groupby(_merged(blobs), key=lambda x: x[0] >> shift):
        pairs = list(of_a)
        most = max(n for _, n in pairs)
        for code, n in pairs:
            yield code, n, n == most


def count_pairs(spilled: DataFrame, ws: Workspace, shift: int) -> DataFrame:
    """The written counts: ``radix, counts`` packed (pair, documents, best), in pair order."""
    runs = spilled.where(F.col("radix").isNotNull())
    parts = _salts(runs, F.octet_length("heads"))
    heads = runs.select("radix", "heads", _salt(parts).alias("salt"))
    while max(parts.values(), default=1) > 1:
        merged = heads.groupBy("radix", "salt").applyInArrow(_merge_runs, "radix int, salt long, heads binary")
        heads = ws.write(merged.withColumn("salt", F.floor(F.col("salt") / FAN_IN)),
                         f"merged-{max(parts.values())}")
        parts = {r: math.ceil(n / FAN_IN) for r, n in parts.items()}

    def mark(group: pa.Table) -> pa.Table:
        pairs, radix, out = _marked(group["heads"].to_pylist(), shift), group["radix"][0].as_py(), []
        while chunk := list(itertools.islice(pairs, COUNTS_CHUNK)):
            columns = [np.array(c, np.int64) for c in zip(*chunk, strict=True)]
            out.append(pack(np.diff(columns[0], prepend=0), *columns[1:]))
        return pa.table({"radix": pa.array([radix] * len(out), pa.int32()),
                         "counts": pa.array(out, pa.binary())})

    return ws.write(heads.groupBy("radix").applyInArrow(mark, "radix int, counts binary"), "counts")


def _salts(runs: DataFrame, size) -> dict[int, int]:
    """Of each radix, the tasks its runs are dealt to; there are at most ``radixes`` entries."""
    return {r: max(1, math.ceil(n / TARGET_BYTES))
            for r, n in runs.groupBy("radix").agg(F.sum(size)).collect()}


def _lookup(parts: dict[int, int]):
    if not parts:
        return F.lit(1)
    return F.element_at(F.create_map(*(F.lit(x) for kv in parts.items() for x in kv)), F.col("radix"))


def _salt(parts: dict[int, int]):
    return F.pmod(F.xxhash64("run"), _lookup(parts).cast("long"))


def _unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, counts, best = unpack(blob, 3)
    return np.cumsum(steps), counts, best


def pair_counts(counts: DataFrame, shift: int) -> DataFrame:
    """``a_id, b_id, n_docs, best`` of every pair linked in the corpus."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                codes, docs, best = _unpack_counts(blob)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((codes >> shift).astype(np.int32)),
                     pa.array((codes & (1 << shift) - 1).astype(np.int32)),
                     pa.array(docs), pa.array(best.astype(bool))], ["a_id", "b_id", "n_docs", "best"])

    return counts.select("counts").mapInArrow(rows, "a_id int, b_id int, n_docs long, best boolean")


def _contributions(runs: pa.Table, counts: pa.Table) -> pa.Table:
    chunks = sorted(map(_unpack_counts, counts["counts"].to_pylist()), key=lambda c: int(c[0][0]))
    out = []
    if runs.num_rows:
        codes, docs, best = (np.concatenate(c) for c in zip(*chunks, strict=True))
    for heads, bodies, n_docs in zip(*(runs[c].to_pylist() for c in ("heads", "bodies", "n_docs")), strict=True):
        pairs, held = unpack_heads(heads)
        steps, times = unpack(bodies, 2)
        places, at = np.cumsum(steps), np.searchsorted(codes, pairs)
        n_best, total = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        np.add.at(n_best, places, np.repeat(best[at], held) * times)
        np.add.at(total, places, np.repeat(docs[at], held) * times)
        out.append(pack(n_best, total))
    return pa.table({"run": runs["run"], "sums": pa.array(out, pa.binary())})


def _added(group: pa.Table) -> pa.Table:
    n_best = total = 0
    for blob in group["sums"].to_pylist():
        a, b = unpack(blob, 2)
        n_best, total = n_best + a, total + b
    n = len(n_best)
    return pa.table({"run": pa.array(np.full(n, group["run"][0].as_py(), np.int64)),
                     "place": pa.array(np.arange(n, dtype=np.int32)),
                     "n_best": pa.array(n_best), "count_sum": pa.array(total)})


def align(docs: DataFrame, path_a: str, path_b: str, ws: Workspace, id_col: str = "doc_id",
          text_col: str = "text", radixes: int = RADIXES,
          shown: Callable[[str], str] | None = None) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row of ``docs``.

    ``n_best`` counts the links whose pair no other pair of its A id exceeds,
    ``count_sum`` adds up the counts over the links; ``groups`` reads
    ``a1,a2|b1;a3|b2,b3``, or is what ``shown`` makes of that.
    """
    spilled = spill(docs, path_a, path_b, ws, id_col, text_col, radixes, shown)
    shift = vocabulary_shift(path_b)
    counts = count_pairs(spilled, ws, shift)
    runs = spilled.where(F.col("radix").isNotNull())
    parts = _salts(runs, F.octet_length("heads") + F.octet_length("bodies"))
    dealt = runs.select("radix", _salt(parts).alias("salt"), "run", "heads", "bodies", "n_docs")
    spread = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), _lookup(parts).cast("long") - 1))
                           .alias("salt"), "counts")
    back = dealt.groupBy("radix", "salt").cogroup(spread.groupBy("radix", "salt")) \
        .applyInArrow(_contributions, "run long, sums binary")
    sums = back.groupBy("run").applyInArrow(_added, "run long, place int, n_best long, count_sum long")
    rows = spilled.where(F.col("radix").isNull()).drop("radix", "heads", "bodies", "n_docs")
    return rows.join(sums, ["run", "place"], "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")), "groups")


def vocabulary_shift(path_b: str) -> int:
    """Bits of an id of the B vocabulary."""
    import sentencepiece
    return max(1, (sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size() - 1).bit_length())
