"""Quality scores by Bradley-Terry pairwise ranking (operator 12).

A document's score is a weighted sum of its text's features.  The weights are
learned from preference pairs: the chance that one document is preferred to
another is the logistic function of their scores' difference, and the logistic
loss on the feature differences is minimised by Newton's method.  The scores
of the training documents, weighted to the shares that their labels have in
the table, then give a quantile: at most the share of documents marked bad
should fall below the threshold, and scores are moved so that the threshold
is ``THRESHOLD``.

The model is fitted on at most ``SAMPLE`` labelled documents of each label, the
ones with the smallest hashes, and ``PAIRS`` pairs drawn of them; each
feature is a rate or a logarithm over the whole text, so texts of every length
are scored alike.  Only the ids and features of the sample come to the driver.

Defined results: every row has a score, repeated rows and null ids included; a
null text counts as empty, an empty one has the features of no words.  Labels
other than 0 and 1 and rows with a null id teach nothing, nor do labels
without a document; a document labelled both ways is in both samples; of
several documents with one id one is taken.  Without both labels all scores
are 0.5.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import hash_sample

SAMPLE = 2_000
PAIRS = 60_000
RIDGE = 1e-3
THRESHOLD = 0.3
# Standardised features beyond this are cut, so that one of them never decides alone.
REACH = 4.0
PACK_CHUNK = 1 << 16

_CLASS = np.full(256, 5, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[ord("0"):ord("9") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("a"):ord("z") + 1] = 3
_CLASS[0x80:] = 3
_CLASS[[ord(c) for c in ".,;:'\"?!-()"]] = 4

FEATURES = (
    "log_bytes", "blank", "digit", "upper", "mark", "symbol", "lines", "long_lines",
    "log_words", "distinct", "most_frequent", "three_most", "repeats", "word_length",
    "symbol_words", "upper_words", "mark_words", "short_words", "capital_words",
    "double_lines", "packed", "packed_log",
)


def features(text: str | None) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``."""
    data = (text or "").encode("utf-8", "replace")
    size = max(1, len(data))
    kinds = np.zeros(6)
    packed = 0
    squeeze = zlib.compressobj(1)
    for a in range(0, len(data), PACK_CHUNK):
        part = data[a:a + PACK_CHUNK]
        kinds += np.bincount(_CLASS[np.frombuffer(part, np.uint8)], minlength=6)
        packed += len(squeeze.compress(part))
    packed += len(squeeze.flush())
    words = (text or "").split()
    n = max(1, len(words))
    counts = Counter(words)
    three = [c for _, c in counts.most_common(3)]
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    symbols = upper = marks = short = capital = 0
    for w, c in counts.items():
        last = w[-1]
        if not last.isalnum():
            if last in ".,;:?!'\")":
                marks += c
            else:
                symbols += c
        if len(w) <= 3:
            short += c
        if w[0].isupper():
            capital += c
            if len(w) > 1 and w.upper() == w:
                upper += c
    lines = [x for x in (text or "").split("\n") if x.strip()]
    spread = Counter(lines)
    return [
        math.log(size), kinds[0] / size, kinds[1] / size, kinds[2] / size, kinds[4] / size, kinds[5] / size,
        len(lines) / n, math.log1p(len(words) / max(1, len(lines))),
        math.log1p(len(words)), len(counts) / n, (three[0] if three else 0) / n, sum(three) / n,
        repeats / n, math.log1p(sum(map(len, counts)) / max(1, len(counts))),
        symbols / n, upper / n, marks / n, short / n, capital / n,
        1 - len(spread) / max(1, len(lines)), packed / size, math.log(packed / size),
    ]


@dataclass(frozen=True)
class Model:
    """Bradley-Terry weights on standardised features, and the threshold they are moved by."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -REACH, REACH)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``THRESHOLD`` at the threshold."""
        raw = weighted(self.standard(x), self.weights) - self.threshold
        return logistic(raw + (math.log(THRESHOLD / (1 - THRESHOLD)) if self.weights.any() else 0.0))


def weighted(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each row's weighted sum; a matrix product's last bits depend on the row's place in the batch."""
    return (z * weights).sum(axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_pairs(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE, rounds: int = 60) -> np.ndarray:
    """Weights w that minimise the mean of log(1 + exp(-w.(better - worse))) + ridge/2 |w|^2."""
    apart = better - worse
    w = np.zeros(apart.shape[1])

    def loss(w: np.ndarray) -> float:
        return np.logaddexp(0, -apart @ w).mean() + ridge / 2 * (w @ w)

    for _ in range(rounds):
        p = logistic(apart @ w)
        slope = -apart.T @ (1 - p) / len(apart) + ridge * w
        if np.abs(slope).max() < 1e-9:
            break
        bend = (apart * (p * (1 - p))[:, None]).T @ apart / len(apart) + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        size, at = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > at:
            size /= 2
        w = w - size * step
    return w


def quantile(scores: np.ndarray, weights: np.ndarray, share: float) -> float:
    """The middle between the scores around the weighted quantile ``share``."""
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weights[order]) / weights.sum()
    k = int(np.searchsorted(below, share - 1e-9))
    return float((scores[order[k]] + scores[order[min(k + 1, len(scores) - 1)]]) / 2)


def fit(x: np.ndarray, good: np.ndarray, bad_share: float, seed: int = 12) -> Model:
    """The model of sampled documents: features, whether marked good, share of bad ones in the table."""
    if good.all() or not good.any():
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0)
    spread = x.std(axis=0)
    model = Model(x.mean(axis=0), np.where(spread > 0, spread, 1.0), np.zeros(x.shape[1]), 0.0)
    z = model.standard(x)
    rng = np.random.default_rng(seed)
    of_good, of_bad = np.flatnonzero(good), np.flatnonzero(~good)
    w = fit_pairs(z[rng.choice(of_good, PAIRS)], z[rng.choice(of_bad, PAIRS)])
    weights = np.where(good, (1 - bad_share) / good.sum(), bad_share / (~good).sum())
    return Model(model.centre, model.scale, w, quantile(weighted(z, w), weights, bad_share))


def learns(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learned; a null id is neither these nor held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(~learns(id_col), F.lit(False))


def featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], [id_col, "x"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", size: int = SAMPLE) -> Model:
    """The model of the labelled documents; pass only the labels that may be learned."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__good")) \
        .join(docs.select(F.col(id_col).alias("__id")).distinct(), "__id", "left_semi")
    counts = dict(marked.groupBy("__good").count().collect())
    sample = hash_sample(marked.withColumn("__hash", F.xxhash64("__id")), "__good", size, "__hash")
    if len(counts) < 2:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, bool), 0.0)
    wanted = docs.sparkSession.createDataFrame([(r["__id"],) for r in sample], "__id " +
                                               marked.schema["__id"].dataType.simpleString()).distinct()
    # at most 2 * size ids
    chosen = docs.join(F.broadcast(wanted), F.col(id_col) == F.col("__id")).select(id_col, text_col)
    found = featured(chosen, id_col, text_col).groupBy(id_col).agg(F.min("x").alias("x"))
    x_of = {r[id_col]: r["x"] for r in found.collect()}
    rows = sorted((r["__good"], str(r["__id"]), x_of[r["__id"]]) for r in sample)
    return fit(np.array([r[2] for r in rows]), np.array([r[0] == 1 for r in rows]),
               counts[0] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, predicted`` of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()])
            found = model.scores(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], [id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType())])
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
