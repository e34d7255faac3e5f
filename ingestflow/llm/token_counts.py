"""Token counts by batch encoding in Arrow functions (operator 6).

The vocabulary's own library encodes; only lengths come back.  Every text is
cut at its ASCII blanks, which no token of these vocabularies crosses, so a
text's count is the sum over its pieces and a very long text never reaches
the library whole.  Each distinct piece of an Arrow batch is encoded once, in
library batches of about ``BATCH_BYTES`` bytes; pieces longer than that get a
batch of their own.  Counts of short pieces are kept per Python worker, in two
generations of ``CACHE_ENTRIES``.

``.json`` files are read by ``tokenizers``; ``.model`` files by
``sentencepiece``, whose pieces cross blanks: those texts are encoded whole.
Special strings inside texts are handled as the library does by default; no
begin, end or other special tokens are added, nothing is cut or padded.

A piece is safe on its own if the vocabulary drops white space: its split
pattern never matches a blank, a blank never composes with the character after
it, and special strings hold no blank.  ``SafeCut`` checks that the file says
so, and texts of other vocabularies are encoded whole.

Defined results: a null or empty text has 0 bytes and 0 tokens; every row
gives one result row, repeated rows and null ids included; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import worker_state

BATCH_BYTES = 1 << 18
CACHE_ENTRIES = 250_000
CACHE_CHARS = 64
PIECES = re.compile(r"[^ \t\n\r\f\v]+")


def drops_blanks(path: str) -> bool:
    """Whether the file's splitter keeps only matches that cannot hold a blank."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = spec.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    kept = first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"
    normal = spec.get("normalizer") or {}
    kinds = {s.get("type") for s in normal.get("normalizers") or [normal]} - {None}
    parts = {"[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"}
    return bool(kept) and all(p in parts or re.fullmatch(r"'[a-z]+", p) for p in pattern.split("|")) \
        and kinds <= {"NFC", "Replace", "Lowercase"} \
        and not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip")
                    for t in spec.get("added_tokens") or [])


class Counter:
    """Counts tokens with the library that the vocabulary file is for."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._lengths = lambda texts: [
                len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.cuts = drops_blanks(path)
        self.newer: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        """Token counts, by library batches of even size in bytes."""
        out: list[int] = []
        start = used = 0
        for i, t in enumerate(texts):
            if i > start and used + len(t) > BATCH_BYTES:
                out += self._lengths(texts[start:i])
                start, used = i, 0
            used += len(t)
        return out + (self._lengths(texts[start:]) if start < len(texts) else [])

    def count(self, texts: list[str | None]) -> list[int]:
        if not self.cuts:
            return self.encode([t or "" for t in texts])
        cut = [PIECES.findall(t) if t else [] for t in texts]
        known: dict[str, int] = {}
        new = []
        for piece in set().union(*cut):
            n = self.newer.get(piece)
            if n is None:
                n = self.older.get(piece)
            if n is None:
                new.append(piece)
            else:
                known[piece] = n
        new.sort(key=len)
        known.update(zip(new, self.encode(new), strict=True))
        if len(self.newer) + len(known) > CACHE_ENTRIES:
            self.older, self.newer = self.newer, {}
        self.newer.update((p, n) for p, n in known.items() if len(p) <= CACHE_CHARS)
        return [sum(map(known.__getitem__, pieces)) for pieces in cut]


def load(path: str) -> Counter:
    return worker_state("token counts", path, lambda: Counter(path))


def _slices(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    start = used = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and used + n > limit:
            yield start, i
            start, used = i, 0
        used += n
    if start < len(texts):
        yield start, len(texts)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` for every row of ``docs``."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts: list[int] = []
            for a, b in _slices(texts, 16 * BATCH_BYTES):
                counts += counter.count(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(counts, np.int64))],
                [id_col, "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))
    return docs.select(id_col, size.alias("n_bytes"), text.alias("text")).mapInArrow(run, schema)
