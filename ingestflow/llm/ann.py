"""Approximate nearest neighbours by inner product on robust-pruned graphs (operator 1).

Vectors are dealt by a hash of their id into shards; in each shard a directed
graph is built.  A greedy search for a vector on the graph so far proposes its
neighbours; relaxed distance pruning then keeps a proposed neighbour only if
no kept one is nearer to it by the factor ``ALPHA``, so the kept edges point
in different directions; reverse edges are added and pruned the same way.  A
second pass over all vectors repairs what the first, on a growing graph, could
not see.  Queries run a beam search on every shard; each shard's best answers,
scored exactly, are merged.

Largest inner product becomes smallest distance by one more coordinate,
``sqrt(M**2 - |x|**2)`` with the shard's largest norm M (0 in queries).

Equal vectors are one node with a list of their rows, so any number of copies
neither breaks the graph nor crowds the beam; all of them are answers.

Every row is indexed.  The number of shards depends on the number of vectors
alone (``SHARD_ROWS`` rows each, ``MIN_SHARDS`` at least), which bounds a
shard's memory; queries stream past each shard's graph in Arrow batches.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, take no part.  A query's candidates are the vectors of
its own length with another id; ties go to the smaller id.  A query row that
is repeated is answered once for each row; rows with a null id are candidates
of no query and no queries.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestflow.llm.common import Workspace

DEGREE = 24
BEAM = 48
SEARCH_BEAM = 160
ALPHA = 1.2
SHARD_ROWS = 5_000
MIN_SHARDS = 12
LANES = 256


class Graph:
    """A directed graph over distinct vectors of one shard."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        last = np.sqrt(np.maximum(norms.max() - norms, 0)) if n else norms
        self.x = np.concatenate([vectors, last[:, None]], axis=1).astype(np.float32)
        self.square = (self.x ** 2).sum(axis=1)
        self.edges = np.full((n, DEGREE), -1, np.int32)
        self.entry = 0

    def build(self, seed: int = 0) -> "Graph":
        n = len(self.x)
        if n:
            middle = self.x.mean(axis=0)
            self.entry = int(((self.x - middle) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]]).astype(np.int64)[:n]
        for alpha in (1.0, ALPHA):
            at = 1
            while at < n:
                # The first pass doubles what it knows with each batch; the second knows all.
                size = LANES if alpha > 1 else min(at, LANES)
                self._insert(order[at:at + size], alpha)
                at += size
        return self

    def _insert(self, points: np.ndarray, alpha: float) -> None:
        found, _ = self.search(self.x[points], BEAM)
        proposed = np.concatenate([found, self.edges[points]], axis=1)
        self.edges[points] = self._prune(points, proposed, alpha)
        sources = np.repeat(points, DEGREE)
        targets = self.edges[points].ravel().astype(np.int64)
        real = targets >= 0
        self._add_reverse(targets[real], sources[real], alpha)

    def _add_reverse(self, targets: np.ndarray, sources: np.ndarray, alpha: float) -> None:
        order = np.argsort(targets, kind="stable")
        targets, sources = targets[order], sources[order]
        nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
        place = np.arange(len(targets)) - np.repeat(first, counts)
        for wide in (False, True):  # the few nodes with many new edges go apart, in a wider array
            chosen = (counts > DEGREE) == wide
            if not chosen.any():
                continue
            row_of = np.cumsum(chosen) - 1
            mine = np.repeat(chosen, counts)
            new = np.full((int(chosen.sum()), int(counts[chosen].max())), -1, np.int64)
            new[row_of[np.repeat(np.arange(len(nodes)), counts)[mine]], place[mine]] = sources[mine]
            picked = nodes[chosen]
            known = (new[:, :, None] == self.edges[picked][:, None, :]).any(axis=2)
            new[known] = -1
            both = np.concatenate([self.edges[picked], new], axis=1)
            fits = (both >= 0).sum(axis=1) <= DEGREE
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            self.edges[picked[fits]] = packed[fits, :DEGREE]
            for a in range(0, int((~fits).sum()), LANES):
                part = np.flatnonzero(~fits)[a:a + LANES]
                self.edges[picked[part]] = self._prune(picked[part], both[part], alpha)

    def _prune(self, points: np.ndarray, proposed: np.ndarray, alpha: float) -> np.ndarray:
        """The diverse ones among proposed neighbours, nearest first."""
        proposed = np.sort(proposed, axis=1)
        bad = (proposed < 0) | (proposed == points[:, None])
        bad[:, 1:] |= proposed[:, 1:] == proposed[:, :-1]
        at = np.maximum(proposed, 0)
        y = self.x[at]
        near = self.square[at] + self.square[points][:, None] \
            - 2 * np.einsum("pkd,pd->pk", y, self.x[points])
        near = np.maximum(near, 0)
        near[bad] = np.inf
        order = np.argsort(near, axis=1, kind="stable")
        at, near = np.take_along_axis(at, order, 1), np.take_along_axis(near, order, 1)
        y = np.take_along_axis(y, order[:, :, None], 1)
        sq = self.square[at]
        between = sq[:, :, None] + sq[:, None, :] - 2 * (y @ y.transpose(0, 2, 1))
        covered = alpha * alpha * between <= near[:, None, :]  # squared distances
        alive = np.isfinite(near)
        rows, out = np.arange(len(points)), np.full((len(points), DEGREE), -1, np.int32)
        for slot in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, slot] = at[rows, pick][some]
            alive &= ~covered[rows, pick]
            alive[rows, pick] = False
        return out

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances (less the query's square) of each query's beam."""
        n, q = len(self.x), len(queries)
        ids = np.full((q, beam), -1, np.int64)
        far = np.full((q, beam), np.inf, np.float32)
        done = np.ones((q, beam), bool)
        seen = np.zeros((q, n), bool)
        ids[:, 0], done[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = self.square[self.entry] - 2 * queries @ self.x[self.entry]
        live = np.arange(q)
        while len(live):
            open_far = np.where(done[live], np.inf, far[live])
            pick = open_far.argmin(axis=1)
            go = np.isfinite(open_far[np.arange(len(live)), pick])
            live, pick = live[go], pick[go]
            if not len(live):
                break
            done[live, pick] = True
            new = self.edges[ids[live, pick]].astype(np.int64)
            at = np.maximum(new, 0)
            known = (new < 0) | seen[live[:, None], at]
            row, col = np.nonzero(~known)
            seen[live[row], at[row, col]] = True
            reach = np.full(new.shape, np.inf, np.float32)
            picked = at[row, col]
            reach[row, col] = self.square[picked] - 2 * np.einsum(
                "rd,rd->r", self.x[picked], queries[live[row]])
            all_far = np.concatenate([far[live], reach], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            far[live] = np.take_along_axis(all_far, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), best, 1)
            done[live] = np.take_along_axis(
                np.concatenate([done[live], known], axis=1), best, 1)
        ids[~np.isfinite(far)] = -1
        return ids, far


def usable(embedding: Column) -> Column:
    """Vectors that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


INDEX = "dim int, shard int, node int, vec_id long, embedding array<float>, edges array<int>, entry boolean"


def build_index(vectors: DataFrame, ws: Workspace, id_col: str = "vec_id",
                embedding_col: str = "embedding") -> DataFrame:
    """Write the graphs of all usable rows of ``vectors``: one row for each of them.

    The first row of a node (a distinct vector) carries its edges.
    """
    embedding = F.col(embedding_col).cast("array<float>")
    rows = vectors.where(F.col(id_col).isNotNull() & usable(embedding)) \
        .select(F.col(id_col).cast("long").alias("vec_id"), embedding.alias("embedding"))
    shards = max(MIN_SHARDS, math.ceil(rows.count() / SHARD_ROWS))
    dealt = rows.withColumns({"dim": F.size("embedding"),
                              "shard": F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")})

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        x = np.stack(frame["embedding"].to_numpy()).astype(np.float32)
        distinct, node = np.unique(x, axis=0, return_inverse=True)
        graph = Graph(distinct).build()
        first = np.zeros(len(x), bool)
        first[np.unique(node, return_index=True)[1]] = True
        return pd.DataFrame({
            "dim": frame["dim"].to_numpy(), "shard": frame["shard"].to_numpy(),
            "node": node.astype(np.int32), "vec_id": frame["vec_id"].to_numpy(),
            "embedding": list(x),
            "edges": [graph.edges[k] if f else None for k, f in zip(node, first, strict=True)],
            "entry": first & (node == graph.entry)})

    def graphs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby(["dim", "shard"], sort=True):
                if held and tuple(held[0].iloc[0][["dim", "shard"]]) != tuple(part.iloc[0][["dim", "shard"]]):
                    yield build(pd.concat(held))
                    held = []
                held.append(part)
        if held:
            yield build(pd.concat(held))

    even = dealt.repartitionById(shards, F.col("shard") + F.col("dim")).sortWithinPartitions("dim", "shard")
    return ws.write(even.mapInPandas(graphs, INDEX), "index")


class Shard:
    """A graph read back from its index rows."""

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).sort_by([("node", "ascending"), ("vec_id", "ascending")])
        node = table["node"].to_numpy()
        self.ids = table["vec_id"].to_numpy()
        self.first = np.flatnonzero(np.diff(node, prepend=-1))
        self.ends = np.append(self.first[1:], len(node))
        flat = table["embedding"].combine_chunks()
        dim = len(flat[0])
        # float32 values are exact in double precision, and so are the scores
        self.vectors = flat.values.to_numpy().reshape(-1, dim)[self.first]
        self.graph = Graph(self.vectors)
        held = table.filter(pa.compute.is_valid(table["edges"]))
        self.graph.edges[held["node"].to_numpy()] = \
            held["edges"].combine_chunks().values.to_numpy().reshape(-1, DEGREE)
        self.graph.entry = int(held.filter(held["entry"])["node"][0].as_py())

    def answers(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        """(query's place, vec_id, score) of the best ``k`` rows found for each query."""
        padded = np.concatenate([queries, np.zeros((len(queries), 1), np.float32)], axis=1)
        for a in range(0, len(queries), LANES):
            found, _ = self.graph.search(padded[a:a + LANES], max(SEARCH_BEAM, 2 * k))
            for i, nodes in enumerate(found, start=a):
                nodes = nodes[nodes >= 0]
                scores = self.vectors[nodes].astype(np.float64) @ queries[i].astype(np.float64)
                out = []
                for j in np.argsort(-scores, kind="stable"):
                    if len(out) > k and scores[j] < out[k][0]:
                        break
                    rows = self.ids[self.first[nodes[j]]:self.ends[nodes[j]]][:k + 1]
                    out += [(scores[j], v) for v in rows.tolist()]
                out = sorted(((-s, v) for s, v in out if v != query_ids[i]))[:k]
                yield from ((i, v, -s) for s, v in out)


def search(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
           embedding_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query row."""
    embedding = F.col(embedding_col).cast("array<float>")
    asked = queries.where(F.col(id_col).isNotNull() & usable(embedding)).select(
        F.col(id_col).cast("long").alias("vec_id"), embedding.alias("embedding"),
        F.size(embedding).alias("dim"), F.monotonically_increasing_id().alias("query"))
    shards = index.select("dim", "shard").distinct()
    # Each shard's task reads its index rows first, then the queries as a stream of batches.
    both = index.select("dim", "shard", F.lit(-1).cast("long").alias("query"), "node", "vec_id",
                        "embedding", "edges", "entry") \
        .unionByName(asked.join(F.broadcast(shards), "dim"), allowMissingColumns=True)
    count = max(1, shards.count())
    # Shards of one length are dealt one by one, so tasks are even.
    dealt = both.repartitionById(count, F.col("shard") + F.col("dim")).sortWithinPartitions("dim", "shard", "query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, shard = [], None, None
        for batch in batches:
            keys = np.stack([batch.column("dim").to_numpy(), batch.column("shard").to_numpy(),
                             batch.column("query").to_numpy() >= 0], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                part, of = batch.slice(a, b - a), tuple(keys[a][:2])
                if of != key:
                    held, key, shard = [], of, None
                if not keys[a][2]:
                    held.append(part)
                    continue
                shard = shard or Shard(held)
                held = []
                x = part.column("embedding")
                x = x.flatten().to_numpy().reshape(len(part), -1)
                ids, places = part.column("vec_id").to_numpy(), part.column("query").to_numpy()
                rows = list(shard.answers(ids, x, k))
                at = [r[0] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places[at]), pa.array(ids[at]), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.float64())],
                    ["query", "query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query long, query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
