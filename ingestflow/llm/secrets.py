"""Secret scans: fixed patterns and a linear-chain conditional random field (operator 10).

Three fixed patterns give the base spans.  A conditional random field adds
spans that the patterns miss: it tags every token of a text as beginning a
secret, inside one, or outside, from the token's shape, the words next to it
and features of the whole text; the best tags are found by Viterbi.  Base
spans always stay; of a field's span that overlaps one only the rest is added.

The field is trained here, by gradient ascent on the conditional likelihood,
from at most ``TRAIN_DOCS`` different texts with base spans and as many without
(those with the smallest hash), cut to ``TRAIN_TOKENS`` tokens
around a span; the base spans are its labels (a secret's first token begins
it, its further tokens are inside), and each sample is used twice more, with a
value of mixed letters and digits in the secret's place: one of one token, and
one of several.  Without any base span in the
sample there is nothing to learn from and it adds no spans.

Tokens are runs of ``[A-Za-z0-9+/_.=-]`` (split after a run's ``=`` or ``:``)
and single other characters that are not blank.  All features are computed on
arrays of code points; Viterbi runs only where a tag other than outside can be
on the best path, a bound that is exact (see ``_doubtful``).

Defined results: null and empty texts have no spans; every row gives one
result row, repeated rows and null ids included; spans are in code points, end
exclusive, ordered by start, then by kind as listed in ``KINDS``; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import hash_sample

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

TRAIN_DOCS = 300
TRAIN_TOKENS = 80
EPOCHS = 80
# A field's span shorter than this is no secret.
LEAST_CHARS = 12
MASK = "[SECRET]"

OUT, BEGIN, INSIDE = range(3)
_BLANK, _LOWER, _UPPER, _DIGIT, _SIGN, _OTHER = range(6)
# Words are told apart by a hash of this many bits, for the features of neighbours.
WORD_BITS = 10
# Feature families of a token: length, digit share, letter cases, class changes, kind of start.
SHAPES = (8, 5, 6, 5, 4)
FILE_FEATURES = 4


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
                if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= 20]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


def values(text: str, spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The spans' secrets: of an assignment only the value is the secret."""
    out = []
    for a, kind, b in spans:
        m = ASSIGN.match(text, a) if kind == "assign" else None
        out.append((m.start(2) if m else a, kind, b))
    return out


def _classes() -> np.ndarray:
    of = np.full(0x110000, _OTHER, np.uint8)
    for c in (*range(9, 14), 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x3000):
        of[c] = _BLANK
    of[ord("a"):ord("z") + 1] = _LOWER
    of[ord("A"):ord("Z") + 1] = _UPPER
    of[ord("0"):ord("9") + 1] = _DIGIT
    for c in "+/_.=-":
        of[ord(c)] = _SIGN
    return of


_CLASS = _classes()


def _weights(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """A number for every character, the same for both cases of a letter and 0 for blanks."""
    folded = codes + np.where(kind == _UPPER, np.uint32(33), np.uint32(1))
    mixed = folded * np.uint32(0x9E3779B1) ^ (folded * np.uint32(0xC2B2AE35) >> np.uint32(13))
    return np.where(kind == _BLANK, np.uint32(0), mixed)


class Tokens:
    """The tokens of one text and their features, as arrays."""

    def __init__(self, text: str):
        self.text = text
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        kind = _CLASS[codes]
        filled = kind != _BLANK
        word = filled & (kind != _OTHER)
        # A token starts at every character that does not go on with the one before it.
        starts = filled.copy()
        starts[1:] &= ~(word[1:] & word[:-1]) | (codes[:-1] == ord("="))
        ends = filled.copy()
        ends[:-1] &= starts[1:] | ~filled[1:]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        n = len(self.start)
        if not n:
            self.shapes, self.words = np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.file, self.gap = np.zeros(FILE_FEATURES), np.zeros(0, np.int64)
            return
        size = self.end - self.start
        self.gap = np.append(1, self.start[1:] > self.end[:-1]).astype(np.int64)
        # Blanks weigh nothing in either table, so sums may run up to the next token.
        digits, upper, lower = (np.add.reduceat(kind == k, self.start, dtype=np.int64)
                                for k in (_DIGIT, _UPPER, _LOWER))
        change = np.zeros(len(codes), np.int16)
        change[1:] = (kind[1:] != kind[:-1]) & word[1:] & ~starts[1:]
        changes = np.add.reduceat(change, self.start)
        first = kind[self.start]
        self.shapes = np.ravel_multi_index((
            np.searchsorted((2, 4, 8, 12, 16, 24, 40), size, "right"),
            (digits > 0) * (1 + np.searchsorted((0.15, 0.45, 0.95), digits / size, "right")),
            (lower > 0) + 2 * (upper > 0) + 2 * ((upper > 1) & (lower > 0)),
            np.searchsorted((1, 2, 4, 8), changes, "right"),
            np.where(first >= _DIGIT, first - _DIGIT + 1, 0)), SHAPES)
        # A word is known by its letters' weights, its first character and its length.
        weights = _weights(codes, kind)
        h = np.add.reduceat(weights, self.start, dtype=np.uint32) + weights[self.start] * np.uint32(31) \
            + size.astype(np.uint32) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        self.words = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - WORD_BITS)).astype(np.int64)
        self.file = np.array([1.0, digits.sum() / len(codes), upper.sum() / len(codes),
                              min(np.log10(len(codes)), 8.0) / 8])

    def filled(self, a: int, b: int) -> bool:
        """Whether a letter or digit is in a part of the text."""
        return any(c.isalnum() for c in self.text[a:b])

    def labels(self, spans: list[tuple[int, str, int]]) -> np.ndarray:
        """Tags of values: the first token begins a secret, the others are inside it."""
        y = np.zeros(len(self.start), np.int64)
        upto = 0
        for a, _, b in sorted(spans):
            t = np.flatnonzero((self.start < b) & (self.end > max(a, upto)))
            if len(t):
                y[t] = INSIDE
                if a >= upto:
                    y[t[0]] = BEGIN
            upto = max(upto, b)
        return y


class Field:
    """Weights of the conditional random field."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        w = weights or {}
        self.shape = w.get("shape", np.zeros((sum(SHAPES), 3)))
        self.before = w.get("before", np.zeros(((1 << WORD_BITS) + 1, 3)))
        self.after = w.get("after", np.zeros(((1 << WORD_BITS) + 1, 3)))
        self.shape_before = w.get("shape_before", np.zeros((sum(SHAPES), 3)))
        self.file = w.get("file", np.zeros((FILE_FEATURES, 3)))
        self.gap = w.get("gap", np.zeros((2, 3)))  # whether a blank is before the token
        self.step = w.get("step", np.zeros((3, 3)))
        self.trained = bool(weights)
        self.tables = None

    def parts(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in
                ("shape", "before", "after", "shape_before", "file", "gap", "step")}

    def emissions(self, tokens: Tokens) -> np.ndarray:
        if self.tables is None:  # the sum of a token's features, for every shape there is
            at = _features(np.arange(np.prod(SHAPES)))
            self.tables = (self.shape[at].sum(axis=1), self.shape_before[at].sum(axis=1))
        own, before = self.tables
        none = [1 << WORD_BITS]
        out = own[tokens.shapes] + tokens.file @ self.file + self.gap[tokens.gap]
        out += self.before[np.concatenate([none, tokens.words[:-1]])]
        out += self.after[np.concatenate([tokens.words[1:], none])]
        out[1:] += before[tokens.shapes[:-1]]
        return out

    def tags(self, tokens: Tokens) -> np.ndarray:
        """The best tags: outside first, a secret's inside only after its beginning."""
        y = np.zeros(len(tokens.start), np.int64)
        if not self.trained or not len(y):
            return y
        e = self.emissions(tokens)
        doubt = _doubtful(e, self.step)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], doubt, [0]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2):
            y[a:b] = _viterbi(e[a:b], self.step, a > 0, b < len(y))
        return y

    def spans(self, tokens: Tokens, taken: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
        y, out = self.tags(tokens), []
        for t in np.flatnonzero(y == BEGIN).tolist():
            end = t + 1
            while end < len(y) and y[end] == INSIDE:
                end += 1
            a, b = int(tokens.start[t]), int(tokens.end[end - 1])
            if b - a < LEAST_CHARS:
                continue
            # What a pattern has found of the secret is its span; the rest is the field's.
            for p, _, q in sorted(s for s in taken if a < s[2] and s[0] < b):
                if tokens.filled(a, p):
                    out.append((a, "crf", p))
                a = max(a, q)
            if tokens.filled(a, b):
                out.append((a, "crf", b))
        return out


_OFFSETS = np.cumsum((0, *SHAPES[:-1]))


def _features(shapes: np.ndarray) -> np.ndarray:
    """Places in the weights of the features that shape numbers stand for."""
    return np.stack(np.unravel_index(shapes, SHAPES), axis=-1) + _OFFSETS


def _doubtful(e: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Tokens that may have another tag than outside on the best path.

    Take a run of other tags on a path, from a beginning at a to b, and set all
    of it outside.  The run is not on the best path if that gains, whatever the
    tags after a are; so a token is in doubt only if some run that holds it has
    a sum of at least 0, each token counted with its best tag and step.
    """
    lead = e[:, 1:] - e[:, [OUT]]
    begin, inside, end = (x - step[OUT, OUT] for x in (step[OUT, BEGIN], step[1:, 1:].max(), step[1:, OUT].max()))
    first = lead[:, 0] + begin
    first[0] = max(first[0], lead[0, 0])
    upto = np.cumsum(lead.max(axis=1) + inside)
    left = np.maximum.accumulate(first - upto)
    right = np.maximum.accumulate(upto[::-1])[::-1]
    # Sums of many tokens are rounded.
    return left + right + max(end, 0) >= -1e-6 * (1 + np.abs(upto).max())


_ALLOWED = np.array([[True, True, False], [True, True, True], [True, True, True]])


def _viterbi(e: np.ndarray, step: np.ndarray, after_out: bool, before_out: bool) -> np.ndarray:
    go = np.where(_ALLOWED, step, -np.inf)
    score = e[0] + (go[OUT] if after_out else np.array([0, 0, -np.inf]))
    back = np.zeros(e.shape, np.int64)
    for t in range(1, len(e)):
        ways = score[:, None] + go
        back[t] = ways.argmax(axis=0)
        score = ways.max(axis=0) + e[t]
    if before_out:
        score = score + go[:, OUT]
    y = np.zeros(len(e), np.int64)
    y[-1] = score.argmax()
    for t in range(len(e) - 1, 0, -1):
        y[t - 1] = back[t, y[t]]
    return y


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


_ALPHABET = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_"))
_JOINTS = np.array(list(":@$!#%&*^~"))


def _varied(text: str, spans: list[tuple[int, str, int]],
            several: bool = False) -> tuple[str, list[tuple[int, str, int]]]:
    """The text with its first secret's value replaced by one of mixed letters and digits.

    The patterns know few kinds of value; this keeps the field from learning
    those alone.  With ``several``, the value is one of several tokens.
    """
    start, kind, end = spans[0]
    draw = np.random.default_rng([len(text), start, several])
    value = "".join(draw.choice(_ALPHABET, draw.integers(20, 44)))
    if several:
        cuts = np.sort(draw.choice(np.arange(3, len(value) - 2), draw.integers(1, 5), replace=False))
        parts = [value[a:b] for a, b in zip([0, *cuts], [*cuts, len(value)], strict=True)]
        value = parts[0] + "".join(str(draw.choice(_JOINTS)) + part for part in parts[1:])
        value += "=" * int(draw.choice([0, 0, 1, 2]))
    more = len(value) - (end - start)
    others = [(a + more * (a >= end), k, b + more * (a >= end)) for a, k, b in spans[1:]
              if a >= end or b <= start]
    return text[:start] + value + text[end:], [(start, kind, start + len(value)), *others]


def fit(texts: list[str]) -> Field:
    """Train a field on texts whose base spans are its labels."""
    cuts = []
    samples = [(text, values(text, base_spans(text))) for text in texts]
    varied = [_varied(t, s, several) for several in (False, True) for t, s in samples if s]
    for text, spans in samples + varied:
        tokens = Tokens(text)
        if not len(tokens.start):
            continue
        y = tokens.labels(spans)
        marked = np.flatnonzero(y == BEGIN)
        middles = marked if len(marked) else [min(len(y) // 2, TRAIN_TOKENS // 2)]
        for m in middles[:4]:
            a = max(0, int(m) - TRAIN_TOKENS // 2)
            while y[a] == INSIDE:  # of a secret that begins before the cut
                a += 1
            cuts.append((tokens, y, a, min(len(y), a + TRAIN_TOKENS)))
    field = Field()
    if not any((y[a:b] != OUT).any() for _, y, a, b in cuts):
        return field
    # Padded arrays of all cuts: one pass of the recursions serves them together.
    none, n, width = 1 << WORD_BITS, len(cuts), max(b - a for _, _, a, b in cuts)
    shape = np.zeros((n, width, len(SHAPES)), np.int64)
    shape_before = np.zeros_like(shape)
    has_before, live = np.zeros((n, width, 1)), np.zeros((n, width), bool)
    before, after = (np.full((n, width), none) for _ in range(2))
    file, gold = np.zeros((n, FILE_FEATURES)), np.zeros((n, width), np.int64)
    gap = np.zeros((n, width), np.int64)
    for i, (tokens, y, a, b) in enumerate(cuts):
        at = _features(tokens.shapes)
        words = np.concatenate([[none], tokens.words, [none]])
        m = b - a
        shape[i, :m], before[i, :m], after[i, :m] = at[a:b], words[a:b], words[a + 2:b + 2]
        first = int(a == 0)
        shape_before[i, first:m] = at[a - 1 + first:b - 1]
        has_before[i, first:m] = 1
        gap[i, :m] = tokens.gap[a:b]
        file[i], gold[i, :m], live[i, :m] = tokens.file, y[a:b], True
    one = np.eye(3)[gold] * live[..., None]
    pair = np.zeros((3, 3))
    np.add.at(pair, (gold[:, :-1][live[:, 1:]], gold[:, 1:][live[:, 1:]]), 1)
    weights = field.parts()
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    closed = np.where(_ALLOWED, 0, -1e9)
    for epoch in range(1, EPOCHS + 1):
        e = (weights["shape"][shape].sum(axis=2)
             + weights["shape_before"][shape_before].sum(axis=2) * has_before
             + weights["before"][before] + weights["after"][after] + weights["gap"][gap]
             + (file @ weights["file"])[:, None])
        step = weights["step"] + closed
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + [0, 0, -1e9]
        for t in range(1, width):
            new = _logsum(alpha[:, t - 1, :, None] + step, 1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = _logsum(step + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], new, 0)
        total = _logsum(alpha[:, -1], 1)
        got = np.exp(alpha + beta - total[:, None, None]) * live[..., None]
        both = np.exp(alpha[:, :-1, :, None] + step + (e + beta)[:, 1:, None, :]
                      - total[:, None, None, None]) * live[:, 1:, None, None]
        off = one - got
        grad = {k: np.zeros_like(v) for k, v in weights.items()}
        for f in range(len(SHAPES)):
            np.add.at(grad["shape"], shape[..., f], off)
            np.add.at(grad["shape_before"], shape_before[..., f], off * has_before)
        np.add.at(grad["before"], before, off)
        np.add.at(grad["after"], after, off)
        np.add.at(grad["gap"], gap, off)
        grad["file"] += file.T @ off.sum(axis=1)
        grad["step"] += np.where(_ALLOWED, pair - both.sum(axis=(0, 1)), 0)
        for k, w in weights.items():  # Adam, with a Gaussian prior
            g = grad[k] / n - 1e-3 * w
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            w += 0.1 * (mean[k] / (1 - 0.9 ** epoch)) / (
                np.sqrt(square[k] / (1 - 0.99 ** epoch)) + 1e-8)
    return Field(weights)


def learn(docs: DataFrame, text_col: str = "text") -> Field:
    """Fit a field on a bounded sample of ``docs``: with base spans, and without."""
    text = F.col(text_col).cast("string")
    # The patterns in the engine's own dialect choose the sample; labels are the patterns above.
    marked = text.rlike(r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?[a-z0-9+/_.=-]{6}""") \
        | text.rlike("AKIA[A-Z0-9]{16}") | text.rlike("[0-9a-f]{24}")
    # Only the part around the first span travels.
    at = F.greatest(F.lit(1), F.regexp_instr(
        "text", F.lit(r"""[0-9a-f]{24}|AKIA[A-Z0-9]{16}|(?i)(password|passwd|secret|token|api_?key)["']? *[:=]"""))
        - 1000)
    rows = docs.select(text.alias("text")).where("text is not null") \
        .select(marked.alias("marked"), F.xxhash64("text").alias("h"), F.substr("text", at, F.lit(3000)).alias("t"))
    sample = [r.t for r in sorted(hash_sample(rows, "marked", TRAIN_DOCS, "h"), key=lambda r: (not r.marked, r.h))]
    return fit(sample)


def scan_text(text: str | None, field: Field) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans of a text, in order."""
    if not text:
        return []
    spans = base_spans(text)
    if field.trained:
        spans += field.spans(Tokens(text), spans)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def mask_text(text: str, spans: list[tuple[int, str, int]]) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                  T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` for every row of ``docs``."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("spans", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for a, k, b in scan_text(t, field)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)],
                                             [id_col, "spans"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def mask(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by ``[SECRET]``."""
    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: mask_text(t, scan_text(t, field)) if isinstance(t, str) else None)

    return docs.withColumn(text_col, masked(F.col(text_col).cast("string")))
