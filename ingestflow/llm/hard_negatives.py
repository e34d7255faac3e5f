"""Hard negatives by segment summary filtering (operator 13).

A vector is cut into segments; of each, its mean m and its deviation d (the
length of the vector less its mean) are stored.  Over a segment of n
components the inner product of two vectors is ``n*m1*m2`` and at most
``d1*d2`` more or less, so sums of these bound a score from both sides.  The
segments are halved level by level (``SEGMENTS``): at each level only rows that
the bounds leave in doubt are bounded again, and what is left at the last is
scored exactly.

Rows are dealt by a hash of their id into blocks (``BLOCK_ROWS`` rows each,
``MIN_BLOCKS`` at least; their number depends on the number of rows alone).
Each block's task holds its rows with their summaries while the anchors
stream past in Arrow batches: a first pass finds each anchor's positives, a
second the negatives within the bands that the positives' scores open.  Each
block keeps its first rows of an anchor; a ranking over blocks keeps the first
of all.  The anchors are sent to every block, so their shuffle grows with
anchors x blocks; nothing is broadcast or collected.

Components become ``floor(scale * x)``; scores are integers.  Components
beyond +-2**26 count as +-2**26, which keeps scores of up to 1,024 components
within a long.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part.  Rows are told apart by their ids: an
anchor's other rows are those of another id; a repeated id's rows are all
ranked, and an anchor row that is repeated is answered once for each row.
Rows with a null id are no anchors and no other row of any.  Only vectors of
one length are compared; an empty vector scores 0.  Ties go to the smaller id.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestflow.llm.common import Workspace

SEGMENTS = (2, 8)
BLOCK_ROWS = 131_072
MIN_BLOCKS = 12
# Pairs of anchors and rows bounded at once, and the share of them beyond which all are computed.
PAIRS = 1 << 18
DENSE = 1 / 8
LIMIT = 1 << 26


class Block:
    """Rows of one block with their segment summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.x = vectors[order].astype(np.int64)
        self.floats = self.x.astype(np.float64)
        self.levels = [summary(self.floats, n) for n in SEGMENTS]
        self.largest = np.abs(self.floats).sum(axis=1).max(initial=0)

    def refine(self, anchors: np.ndarray, alive: np.ndarray, keep: Callable) -> np.ndarray:
        """The (anchor, row) pairs that no level's bounds rule out.

        ``keep(alive, low, high)`` gives, from bounds of all pairs' scores, the
        pairs that may still be among the results.
        """
        floats = anchors.astype(np.float64)
        # what rounding may move a bound by
        slack = (0.5 + 1e-12 * np.abs(floats).max(axis=1, initial=0) * self.largest)[:, None]
        low, high = np.full(alive.shape, -np.inf), np.full(alive.shape, np.inf)
        for level, segments in enumerate(SEGMENTS):
            mean, spread = self.levels[level]
            means, spreads = summary(floats, segments)
            if alive.mean() > DENSE:
                middle, away = means @ mean.T, spreads @ spread.T + slack
                low, high = np.maximum(low, middle - away), np.minimum(high, middle + away)
            else:
                for i in range(len(anchors)):
                    rows = np.flatnonzero(alive[i])
                    middle, away = mean[rows] @ means[i], spread[rows] @ spreads[i] + slack[i]
                    low[i, rows] = np.maximum(low[i, rows], middle - away)
                    high[i, rows] = np.minimum(high[i, rows], middle + away)
            alive = keep(alive, low, high)
        return alive

    def scores(self, anchors: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """The exact scores of the pairs that are alive; others are anything."""
        if np.abs(anchors).max(initial=0) * self.largest >= 1 << 53:
            return anchors @ self.x.T
        floats = anchors.astype(np.float64)
        if alive.mean() > DENSE:
            return (floats @ self.floats.T).astype(np.int64)
        out = np.zeros(alive.shape, np.int64)
        for i in range(len(anchors)):
            rows = np.flatnonzero(alive[i])
            out[i, rows] = self.floats[rows] @ floats[i]
        return out


def kth_highest(values: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Of each anchor, the ``k``-th highest value among the marked ones; -inf if there are fewer."""
    n = values.shape[1]
    if n < k:
        return np.full((len(values), 1), -np.inf)
    return np.partition(np.where(among, values, -np.inf), n - k, axis=1)[:, [n - k]]


def first(scores: np.ndarray, among: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """(anchor, row) of each anchor's ``k`` highest marked scores; rows are in the order of their ids."""
    least = kth_highest(scores.astype(np.float64), among, k)
    near = among & (scores >= least - 0.5 - 1e-9 * np.abs(np.where(np.isfinite(least), least, 0)))
    for i in range(len(scores)):
        rows = np.flatnonzero(near[i])
        for r in rows[np.argsort(-scores[i, rows], kind="stable")[:k]].tolist():
            yield i, r


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector's segments, sqrt(n) * mean and the deviation, so that products need no n."""
    n, dim = x.shape
    ends = np.linspace(0, dim, min(segments, max(1, dim)) + 1).astype(int)
    means, spreads = [], []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        part = x[:, a:b]
        mean = part.mean(axis=1) if b > a else np.zeros(n)
        means.append(mean * math.sqrt(b - a))
        spreads.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(means, axis=1), np.stack(spreads, axis=1)


def usable(embedding: Column, label: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return label.isNotNull() & F.coalesce(finite, F.lit(False))


def integer_rows(rows: DataFrame, ws: Workspace, scale: int = 256, id_col: str = "vec_id",
                 embedding_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """The written rows that take part: ``vec_id, label, dim, vector array<int>, block``."""
    label = F.col(label) if isinstance(label, str) else label
    embedding = F.col(embedding_col).cast("array<double>")
    # bounded before the floor, whose long would overflow on the largest doubles
    whole = F.transform(embedding, lambda x: F.floor(F.greatest(
        F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), x * F.lit(float(scale))))).cast("int"))
    kept = rows.where(F.col(id_col).isNotNull() & usable(embedding, label)).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        whole.alias("vector")).withColumn("dim", F.size("vector"))
    table = ws.write(kept, "integers")
    blocks = max(MIN_BLOCKS, math.ceil(table.count() / BLOCK_ROWS))
    return table.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))


def _streamed(rows: DataFrame, anchors: DataFrame, extra: list[str], answer: Callable,
              schema: str) -> DataFrame:
    """``answer(block, anchors of a batch)`` for every block and every batch of anchors.

    ``anchors`` has the columns of ``rows``, an ``anchor`` number and ``extra``.
    """
    blocks = rows.select("dim", "block").distinct()
    sent = anchors.drop("block").join(blocks, "dim")
    columns = ["dim", "block", "anchor", "vec_id", "label", "vector", *extra]
    both = rows.select("dim", "block", F.lit(-1).cast("long").alias("anchor"), "vec_id", "label", "vector") \
        .unionByName(sent.select(*columns), allowMissingColumns=True).select(*columns)
    # Blocks of one length are dealt one by one, so tasks are even.
    dealt = both.repartitionById(max(1, blocks.count()), F.col("block") + F.col("dim")) \
        .sortWithinPartitions("dim", "block", "anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, block = [], None, None

        def vectors(part: pa.RecordBatch, dim: int) -> np.ndarray:
            return part.column("vector").flatten().to_numpy().reshape(len(part), dim)

        for batch in batches:
            keys = np.stack([batch.column("dim").to_numpy(), batch.column("block").to_numpy(),
                             batch.column("anchor").to_numpy() >= 0], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                part, of = batch.slice(a, b - a), tuple(keys[a][:2])
                if of != key:
                    held, key, block = [], of, None
                if not keys[a][2]:
                    held.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(),
                                 vectors(part, keys[a][0])))
                    continue
                if block is None:
                    block = Block(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held = []
                lanes = max(1, PAIRS // len(block.ids))
                for c in range(0, len(part), lanes):
                    lane = part.slice(c, lanes)
                    yield from answer(block, lane, vectors(lane, keys[a][0]).astype(np.int64))

    return dealt.mapInArrow(run, schema)


def positives(rows: DataFrame, anchors: DataFrame, k: int = 5) -> DataFrame:
    """``anchor, anchor_id, positive_id, positive_score`` of the first ``k`` of the anchor's label."""
    def answer(block: Block, lane: pa.RecordBatch, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, labels = lane.column("vec_id").to_numpy(), lane.column("label").to_numpy()
        numbers = lane.column("anchor").to_numpy()
        same = (block.labels == labels[:, None]) & (block.ids != ids[:, None])
        alive = block.refine(x, same, lambda alive, low, high: alive & (high >= kth_highest(low, alive, k)))
        scores = block.scores(x, alive)
        yield _batch([(numbers[i], ids[i], block.ids[r], scores[i, r]) for i, r in first(scores, alive, k)],
                     ["anchor", "anchor_id", "positive_id", "positive_score"])

    found = _streamed(rows, anchors, [], answer,
                      "anchor long, anchor_id long, positive_id long, positive_score long")
    place = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([int(r[c]) for r in rows], pa.int64()) for c in range(len(names))], names)


def negatives(rows: DataFrame, anchors: DataFrame, k: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """Of each anchor and positive, the first ``k`` rows of other labels in the positive's band.

    ``anchors`` carry ``positives``, an array of ``(place, positive_id, positive_score)``.
    """
    names = ["anchor", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def answer(block: Block, lane: pa.RecordBatch, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, labels = lane.column("vec_id").to_numpy(), lane.column("label").to_numpy()
        numbers, found = lane.column("anchor").to_numpy(), lane.column("positives").to_pylist()
        # Of each anchor's n-th positive, the whole scores s with least * p <= 100 * s <= most * p.
        bands = []
        for n in range(max(map(len, found), default=0)):
            p = [f[n]["positive_score"] if n < len(f) else None for f in found]
            bands.append(tuple(np.array(b, np.int64)[:, None] for b in (
                [0 if v is None else -(-least * v // 100) for v in p],
                [-1 if v is None else most * v // 100 for v in p])))

        def keep(alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            kept = np.zeros(alive.shape, bool)
            for floor, ceiling in bands:
                sure = alive & (low >= floor) & (high <= ceiling)
                able = (high >= floor) & (low <= ceiling) & (floor <= ceiling)
                kept |= alive & able & (high >= kth_highest(low, sure, k))
            return kept

        alive = block.refine(x, (block.labels != labels[:, None]) & (block.ids != ids[:, None]), keep)
        scores = block.scores(x, alive)
        out = []
        for n, (floor, ceiling) in enumerate(bands):
            inside = alive & (scores >= floor) & (scores <= ceiling)
            out += [(numbers[i], found[i][n]["place"], ids[i], found[i][n]["positive_id"],
                     found[i][n]["positive_score"], block.ids[r], scores[i, r]) for i, r in first(scores, inside, k)]
        yield _batch(out, names)

    asked = _streamed(rows, anchors, ["positives"], answer, ", ".join(f"{n} long" for n in names))
    place = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return asked.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, ws: Workspace, n_positives: int = 5, n_negatives: int = 10,
         least: int = 30, most: int = 90) -> DataFrame:
    """Hard negatives of the anchors among ``rows``, the table of :func:`integer_rows`.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: of each anchor and each of its first ``n_positives`` rows
    of its label, the first ``n_negatives`` rows of other labels whose score is
    ``least`` to ``most`` hundredths of the positive's.
    """
    asked = ws.write(rows.where(anchors).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    near = positives(rows, asked, n_positives).groupBy("anchor").agg(F.collect_list(F.struct(
        F.col("place").cast("long").alias("place"), "positive_id", "positive_score")).alias("positives"))
    paired = ws.write(asked.join(near, "anchor"), "positives")
    return negatives(rows, paired, n_negatives, least, most).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
