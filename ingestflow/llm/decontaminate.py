"""Benchmark decontamination with a distributed positional inverted index (operator 8).

``build_index`` cuts the documents into segments of about ``SEGMENT_WORDS``
words (a document is never cut) and writes, for each segment, the posting list
of every word: its positions in the segment, ascending, as differences.  The
index covers all words of all documents and holds no text.

``find_windows`` sends the benchmark's windows to the segments.  In each
segment a window's terms are ordered by the length of their posting lists
there, and the lists are intersected, offset by the terms' places in the
window, from the rarest term on.  ``find_near`` instead asks for the rarest
terms of a window within a span of words, in any order: the smallest window of
the document around each place of the rarest one.  The benchmark is read
in blocks of ``BLOCK_WORDS`` words, one pass over the index for each, and the
matches of a block are written before the next is read; so what is sent to the
executors, and the windows that the driver holds, have a size bound whatever the
benchmark's size.  Items come to the driver one partition of the benchmark at a
time.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII.

Defined results: null and empty texts have no words; benchmark items without
words match nothing; an item shorter than the window is one window; rows that
repeat an item id are windows of one item, and items without an id count under
the name ``null``; every document row gives one result row, repeated rows and
null ids included; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import Workspace

# Words are cut at ASCII characters only, so UTF-8 bytes can be searched as they are.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEGMENT_WORDS = 1 << 17
BLOCK_WORDS = 1 << 20
# Beyond any place in a segment.
FAR = 1 << 40

INDEX = ("segment long, doc_ids array<{id}>, doc_starts array<int>, terms array<string>, "
         "term_starts array<int>, steps array<int>")


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def build_index(docs: DataFrame, ws: Workspace, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write the positional index of ``docs``; one row per segment."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, segments = TaskContext.get().partitionId(), 0
        numbers = _Numbers()
        ids, lengths, parts, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            nonlocal segments
            tokens = np.concatenate([*parts, np.empty(0, np.int64)])
            # One sort of (word, position) pairs puts every posting list in order.
            pairs = np.sort(tokens << 32 | np.arange(len(tokens)))
            term, position = pairs >> 32, pairs & 0xFFFFFFFF
            first = np.flatnonzero(np.diff(term, prepend=-1))
            steps = np.diff(position, prepend=0).astype(np.int32)
            steps[first] = position[first]
            names = list(numbers)
            strings = pa.array([names[t] for t in term[first].tolist()], pa.binary())
            out = pa.RecordBatch.from_arrays([
                pa.array([task << 32 | segments], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()),
                                         pa.concat_arrays(ids) if ids else pa.array([])),
                _lists([np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()),
                                         strings.cast(pa.string())),
                _lists([np.append(first, len(tokens)).astype(np.int32)], pa.int32()),
                _lists([steps], pa.int32())],
                ["segment", "doc_ids", "doc_starts", "terms", "term_starts", "steps"])
            segments += 1
            return out

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                found = words(text.as_py())
                if ids and held + len(found) > SEGMENT_WORDS:
                    yield segment()
                    ids, lengths, parts, held, numbers = [], [], [], 0, _Numbers()
                ids.append(batch.column(0).slice(i, 1))
                lengths.append(len(found))
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                held += len(found)
        if ids:
            yield segment()

    schema = INDEX.format(id=kind.simpleString())
    return ws.write(docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema),
                    "index")


class Windows:
    """The windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.numbers = _Numbers()
        by_length: dict[int, tuple[list, list]] = {}
        for name, item in items:
            tokens = [self.numbers[w.decode()] for w in item]
            n = min(size, len(tokens))
            seen = by_length.setdefault(n, ([], []))
            for i in range(len(tokens) - n + 1):
                seen[0].append(name)
                seen[1].append(tokens[i:i + n])
        self.groups = [(names, np.array(rows, np.int64)) for names, rows in by_length.values()]


class Segment:
    """Posting lists of one index row, decoded when first asked for."""

    def __init__(self, row: dict, numbers: dict):
        self.starts, self.steps = row["term_starts"], row["steps"]
        self.place = np.full(len(numbers), -1, np.int64)
        for i, term in enumerate(row["terms"]):
            n = numbers.get(term)
            if n is not None:
                self.place[n] = i
        self.counts = np.zeros(len(numbers), np.int64)
        held = self.place >= 0
        self.counts[held] = np.diff(self.starts)[self.place[held]]
        self.lists: dict[int, np.ndarray] = {}

    def postings(self, n: int) -> np.ndarray:
        got = self.lists.get(n)
        if got is None:
            i = self.place[n]
            got = np.cumsum(self.steps[self.starts[i]:self.starts[i + 1]], dtype=np.int64)
            self.lists[n] = got
        return got


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(listed, values)
    at[at == len(listed)] = 0
    return listed[at] == values


def _exact(seg: Segment, doc_starts: np.ndarray, windows: Windows) -> Iterator[tuple]:
    """(item, document's place, first word, end) of every occurrence, in words of the segment."""
    for names, rows in windows.groups:
        n = rows.shape[1]
        counts = seg.counts[rows]
        for w in np.flatnonzero(counts.min(axis=1) > 0):
            row, order = rows[w], np.argsort(counts[w], kind="stable")
            at = seg.postings(row[order[0]]) - order[0]
            for k in order[1:]:
                at = at[_among(at + k, seg.postings(row[k]))]
                if not len(at):
                    break
            if len(at):
                doc = np.searchsorted(doc_starts, at, "right") - 1
                # documents of no words share their start with the next one: the last holds it
                for d, a in zip(doc.tolist(), at.tolist(), strict=True):
                    if a >= 0 and a + n <= doc_starts[d + 1]:
                        yield names[w], d, a, a + n


def _near(terms: int, span: int):
    def search(seg: Segment, doc_starts: np.ndarray, windows: Windows) -> Iterator[tuple]:
        for names, rows in windows.groups:
            counts = seg.counts[rows]
            for w in np.flatnonzero(counts.min(axis=1) > 0):
                chosen = np.unique(rows[w])
                chosen = chosen[np.argsort(seg.counts[chosen], kind="stable")][:terms]
                at = seg.postings(chosen[0])
                doc = np.searchsorted(doc_starts, at, "right") - 1
                # A window around the rarest term's place holds a term if it reaches the
                # term's last place before or its first one after, in the document.
                start, end = doc_starts[doc], doc_starts[doc + 1]
                before = np.full((len(chosen), len(at)), -FAR)
                after = np.full((len(chosen), len(at)), FAR)
                before[0] = after[0] = at
                for k, t in enumerate(chosen[1:], 1):
                    listed = seg.postings(t)
                    j = np.searchsorted(listed, at)
                    left, right = listed[np.maximum(j - 1, 0)], listed[np.minimum(j, len(listed) - 1)]
                    before[k] = np.where((j > 0) & (left >= start), left, -FAR)
                    after[k] = np.where((j < len(listed)) & (right < end), right, FAR)
                # The smallest window begins at one of the places before; what it misses is after.
                upto = np.where(before[None] < before[:, None], after[None], at).max(axis=1) + 1
                best, all_at = (upto - before).argmin(axis=0), np.arange(len(at))
                low, high = before[best, all_at], upto[best, all_at]
                ok = high - low <= span
                for i in np.flatnonzero(ok).tolist():
                    yield names[w], int(doc[i]), int(low[i]), int(high[i])
    return search


def _merged(found: Iterator[tuple]) -> dict[tuple[str, int], list[list[int]]]:
    """Overlapping occurrences of an item in a document joined into spans."""
    out: dict[tuple[str, int], list[list[int]]] = {}
    for item, doc, start, end in sorted(found):
        spans = out.setdefault((item, doc), [])
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return out


def _search(index: DataFrame, benchmark: DataFrame, size: int, how, item_col: str,
            text_col: str) -> DataFrame:
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")),
                             F.col(text_col).cast("string"))
    schema = "segment long, ordinal int, item_id string, start int, end int"
    out = None

    def over(windows: Windows):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cols = batch.to_pydict() if batch.num_rows == 0 else None
                for i in range(batch.num_rows if cols is None else 0):
                    row = {c: batch.column(c)[i].values for c in
                           ("doc_starts", "terms", "term_starts", "steps")}
                    row["terms"] = row["terms"].to_pylist()
                    row |= {c: row[c].to_numpy() for c in ("doc_starts", "term_starts", "steps")}
                    starts, seg = row["doc_starts"], Segment(row, windows.numbers)
                    rows = [(batch.column("segment")[i].as_py(), d, item, a - starts[d], b - starts[d])
                            for (item, d), spans in _merged(how(seg, starts, windows)).items()
                            for a, b in spans]
                    cols = list(zip(*rows, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(
                            cols, (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()),
                            strict=True)], ["segment", "ordinal", "item_id", "start", "end"])
        return run

    def matches(block: list) -> DataFrame:
        return index.select("segment", "doc_starts", "terms", "term_starts", "steps") \
            .mapInArrow(over(Windows(block, size)), schema)

    # Matches of a block are written before the next is read, so the driver holds one at a time.
    ws = Workspace(index.sparkSession, "matches")
    block, held, blocks = [], 0, 0
    for name, text in items.toLocalIterator():  # a block at a time
        item = words(text)
        if block and held + len(item) > BLOCK_WORDS:
            written = ws.write(matches(block), f"block{blocks}")
            out = written if out is None else out.union(written)
            block, held, blocks = [], 0, blocks + 1
        if item:
            block.append((name, item))
            held += len(item)
    last = matches(block)
    return last if out is None else out.union(last)


def find_windows(index: DataFrame, benchmark: DataFrame, size: int = 10,
                 item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Exact occurrences of item windows: ``segment, ordinal, item_id, start, end``.

    Spans are in words of the document; overlapping occurrences of one item
    are one span.
    """
    return _search(index, benchmark, size, _exact, item_col, text_col)


def find_near(index: DataFrame, benchmark: DataFrame, size: int = 10, terms: int = 4,
              span: int = 20, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Places where the ``terms`` rarest terms of a window lie within ``span`` words."""
    return _search(index, benchmark, size, _near(terms, span), item_col, text_col)


def document_hits(index: DataFrame, matches: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document row: its words, hit words, matching items and their digest."""
    docs = index.select("segment", F.posexplode("doc_ids").alias("ordinal", id_col), "doc_starts") \
        .select("segment", "ordinal", id_col,
                (F.col("doc_starts")[F.col("ordinal") + 1] - F.col("doc_starts")[F.col("ordinal")])
                .cast("long").alias("n_words"))
    hit = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0)))
            .cast("long").alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto")),
        lambda acc: acc["n"])
    found = matches.groupBy("segment", "ordinal").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    found = found.select("segment", "ordinal", hit.alias("n_hit"), "items")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return docs.join(found, ["segment", "ordinal"], "left").select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
