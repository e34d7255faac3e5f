"""Near duplicates by circulant MinHash (operator 4).

A document is the set of its distinct 5-word shingles.  Two permutations give
all signature coordinates: the first scatters the shingles over the 64-bit
integers, the second orders them, and coordinate k uses the second one shifted
circularly by k: ``min over x of order((scatter(x) + k) mod 2**64)``.

Bands of the signature propose pairs, exact Jaccard similarity on the full
sets decides them, and linked documents form components:

1.  Documents with equal sets are one class; everything after works on
    classes, so copies never meet in one task.
2.  In each band bucket every class is compared with one centre, not with
    every other class.
3.  For the members of buckets that still hold several components, the
    shingles that no other such member has are counted.  They bound every
    similarity exactly: what one set has alone, the other lacks.  In each of
    these buckets the member with fewest of them, the middle of the group, is
    compared with the members of other components that can reach the threshold.
4.  What is still apart in a bucket is compared in full: the members outside
    the bucket's largest component with the members of other components,
    where that bound, eight-bit signatures and odd sketches allow the threshold.
    An odd sketch holds, for each of 1,024 bins, whether an odd number of the
    set's shingles falls into it: two sets differ in at least as many shingles
    as their sketches in bins, so copies of one text that each changed it
    elsewhere are told apart before any text is looked at.  A component
    is therefore never compared with itself, copies with many changes of their
    own are compared with nothing, and no link that the bands propose is lost.

With ``BANDS`` bands of ``ROWS`` coordinates a pair at similarity 0.80 misses
all bands with probability 1e-7, one at 0.85 with 2e-10.  In step 4 the
eight-bit signature lets a pair at 0.80 fail with probability below 1e-6; the
odd sketch is exact for sets whose difference is small beside its bins, and
lets a pair of larger ones fail with probability below 1e-8.

Words are runs of characters other than the six ASCII blanks, A-Z lower-cased;
a document of fewer than five words is one shingle of them all.

Defined results: null texts and texts without words have an empty set and link
with nothing.  A row's component is the smallest id reachable from it; rows
repeated under one id have equal results; rows without an id take part, and
their component is null if no row with an id is reachable.  Every input row
gives one result row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.llm.common import Workspace, broadcast_if_small, worker_state

SHINGLE = 5
BANDS, ROWS = 30, 4
COORDINATES = BANDS * ROWS
SIGN_WORDS, SIGN_BITS = 2, 8  # 64-bit words of each bit of the signature
# Of the 120 eight-bit coordinates a pair at 0.80 shares 96.1 on average, deviation 4.4.
LEAST_SHARED = 73
ODD_BITS = 1024
# The number of bins that differ deviates by 16 at most: half the root of the bins.
ODD_SLACK = 96
# Bytes of word hashes kept per Python worker.
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 130
BLOCK = 512  # shingles whose coordinates are computed at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_U30, _U27, _U31 = np.uint64(30), np.uint64(27), np.uint64(31)
_SHIFTS = np.arange(COORDINATES, dtype=np.uint64)[:, None]
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(SHINGLE)], np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers (each step can be undone)."""
    x = (x ^ (x >> _U30)) * _M1
    x = (x ^ (x >> _U27)) * _M2
    return x ^ (x >> _U31)


class _Hashes(dict):
    used = 0

    def __missing__(self, word: bytes) -> int:
        if self.used >= CACHE_BYTES:
            self.clear()
            self.used = 0
        self[word] = h = xxhash.xxh64_intdigest(word)
        self.used += ENTRY_BYTES + len(word)
        return h


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit hashes."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = worker_state("word hashes", None, _Hashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    if n < size:
        # Fewer words than a shingle: their number takes part, so no longer text is equal to it.
        powers = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(n)], np.uint64)
        return scramble(np.array([(h * powers).sum() + np.uint64(n)], np.uint64))
    powers = _POWERS if size == SHINGLE else \
        np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(size)], np.uint64)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out += h[k:n - size + 1 + k] * powers[k]
    return np.unique(scramble(out))


def signature(items: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set: one scattering, one order shifted circularly."""
    scattered = scramble(items * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(scattered), BLOCK):
        np.minimum(out, scramble(scattered[at:at + BLOCK] + _SHIFTS).min(axis=1), out=out)
    return out


_MIX = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(ROWS)], np.uint64)


def bands(sig: np.ndarray) -> np.ndarray:
    return scramble((sig.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)).view(np.int64)


def signs(sig: np.ndarray) -> np.ndarray:
    """The lowest ``SIGN_BITS`` bits of every coordinate, one bit of all after the other, packed."""
    bits = np.zeros((SIGN_BITS, 64 * SIGN_WORDS), np.uint8)
    for k in range(SIGN_BITS):
        bits[k, :COORDINATES] = (sig >> np.uint64(k)) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.int64).ravel()


def odd(items: np.ndarray) -> np.ndarray:
    """Whether an odd number of the items falls into each of ``ODD_BITS`` bins, packed."""
    counts = np.bincount((items % np.uint64(ODD_BITS)).astype(np.int64), minlength=ODD_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def sketch(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write, for every row: number, id, set size, 128-bit digest of the set, bands, signs, odd sketch, text."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n", T.LongType()), T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("signs", T.ArrayType(T.LongType())),
        T.StructField("odd", T.ArrayType(T.LongType())), T.StructField("text", T.StringType())])
    names = schema.names
    lists = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes, d1, d2, keys, bits, odds = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                sizes.append(len(s))
                digest = xxhash.xxh128_intdigest(s.tobytes()) if len(s) else 0
                d1.append((digest >> 64) - (1 << 63))
                d2.append((digest & (1 << 64) - 1) - (1 << 63))
                sig = signature(s) if len(s) else None
                keys.append(bands(sig) if len(s) else None)
                bits.append(signs(sig) if len(s) else None)
                odds.append(odd(s) if len(s) else None)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, lists),
                 pa.array(bits, lists), pa.array(odds, lists), batch.column(1)], names)
            row += n

    return ws.write(docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema), "sketch")


def _verify(pairs: DataFrame, sketched: DataFrame, ws: Workspace, percent: int, name: str) -> DataFrame:
    """Write those of the class pairs ``a, b`` with 100 * intersection >= percent * union.

    Only the texts of classes in a pair are shuffled.
    """
    pairs = ws.write(pairs, f"{name}-pairs")
    named = ws.write(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(),
                     f"{name}-named")
    texts = sketched.select("row", "n", "text").join(broadcast_if_small(named), "row", "left_semi")
    of = {side: texts.select(F.col("row").alias(side), F.col("n").alias(f"n_{side}"),
                             F.col("text").alias(f"text_{side}")) for side in "ab"}
    joined = pairs.join(of["b"], "b").join(of["a"], "a").where(_alike(percent, "n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            ok = []
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            text_a, text_b = batch.column("text_a"), batch.column("text_b")
            for i, key in enumerate(a):  # rows come sorted by a
                if key != last:
                    last, last_set = key, shingles(text_a[i].as_py())
                other = shingles(text_b[i].as_py())
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                if 100 * both >= percent * (len(last_set) + len(other) - both):
                    ok.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in ok], pa.int64()), pa.array([b[i] for i in ok], pa.int64())],
                ["a", "b"])

    links = ws.write(joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), name)
    ws.drop(f"{name}-pairs", f"{name}-named")
    return links


def components(links: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``node, comp``: the smallest node reachable, for the nodes of ``links`` (a, b).

    Every round takes the smallest label among the neighbours, then the label
    of that label; it ends when nothing changes, after a number of rounds that
    grows with the logarithm of the longest path.
    """
    both = ws.write(links.select("a", "b").union(links.select("b", "a")), f"{name}-both")
    labels = ws.write(both.groupBy(F.col("a").alias("node"))
                      .agg(F.min(F.least("a", "b")).alias("comp")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = ws.write(
            labels.join(near, "node").select("node", F.col("comp").alias("was"),
                                             F.least("comp", "near").alias("comp")),
            f"{name}-{turn}-hooked")
        jump = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("upto"))
        new = ws.write(hooked.join(jump, "comp").select("node", "was", F.col("upto").alias("comp")),
                       f"{name}-{turn}")
        done = new.where("was != comp").isEmpty()
        ws.drop(f"{name}-{turn}-hooked", f"{name}-{turn - 1}")
        labels = new.select("node", "comp")
        if done:
            ws.drop(f"{name}-both")
            return labels


def _alike(percent: int, n_a: str, n_b: str) -> Column:
    """Set sizes that allow the threshold."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _reachable(percent: int, n_a: str, own_a: str, n_b: str, own_b: str) -> Column:
    """Whether two sets can reach the threshold: what one has alone, the other lacks."""
    most = F.least(F.col(n_a) - F.col(own_a), F.col(n_b) - F.col(own_b))
    return 100 * most >= percent * (F.col(n_a) + F.col(n_b) - most)


def _shared(a: str, b: str) -> Column:
    differ = F.lit(0)
    for word in range(SIGN_WORDS):
        apart = F.lit(0).cast("long")
        for bit in range(SIGN_BITS):
            k = bit * SIGN_WORDS + word
            apart = apart.bitwiseOR(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
        differ = differ + F.bit_count(apart)
    return F.lit(COORDINATES) - differ >= LEAST_SHARED


def _differ_little(percent: int, n_a: str, odd_a: str, n_b: str, odd_b: str) -> Column:
    """Whether the odd sketches of two sets allow the threshold.

    Linked sets differ in at most ``most`` shingles, their sketches therefore in
    no more bins; bins into which several of those fall make them fewer.
    """
    bins = F.lit(0)
    for word in range(ODD_BITS // 64):
        bins = bins + F.bit_count(F.col(odd_a)[word].bitwiseXOR(F.col(odd_b)[word]))
    most = (F.col(n_a) + F.col(n_b)) * (100 - percent) / (100 + percent)
    usual = ODD_BITS / 2 * (1 - F.exp(-2 / ODD_BITS * most)) + ODD_SLACK
    return bins <= F.least(F.floor(most), usual)


def link_classes(sketched: DataFrame, classes: DataFrame, ws: Workspace, percent: int) -> DataFrame:
    """``node, comp`` of the classes that have a link."""
    nodes = sketched.where("n > 0").select("row", "n", "bands") \
        .join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    slots = nodes.select("row", "n", F.posexplode("bands").alias("band", "key"))
    # Buckets of one class are the most; they go before anything is joined.
    buckets = ws.write(slots.groupBy("band", "key").agg(F.count("*").alias("size"),
                                                        F.min("row").alias("centre"))
                       .where("size > 1"), "buckets")
    members = ws.write(slots.join(buckets.select("band", "key", "centre"), ["band", "key"]), "members")

    def pairs(rows: DataFrame) -> DataFrame:
        """Distinct pairs of a centre and a member."""
        return rows.where("a != b").groupBy("a", "b").agg(F.count("*").alias("bands")) \
            .select("a", "b")

    links = _verify(pairs(members.select(F.col("centre").alias("a"), F.col("row").alias("b"))),
                    sketched, ws, percent, "links-1")
    joined = components(links, ws, "star")

    def mixed_members(comps: DataFrame, of: DataFrame, name: str) -> DataFrame:
        """Write the members of the buckets that hold several components, with the largest as ``main``."""
        now = ws.write(of.join(comps.select(F.col("node").alias("row"), "comp"), "row", "left")
                       .withColumn("comp", F.coalesce("comp", "row")), f"{name}-now")
        held = now.groupBy("band", "key", "comp").agg(F.count("*").alias("held"))
        main = ws.write(held.groupBy("band", "key").agg(
            F.count("*").alias("comps"), F.max(F.struct("held", "comp"))["comp"].alias("main"))
            .where("comps > 1").select("band", "key", "main"), f"{name}-main")
        out = ws.write(now.join(main, ["band", "key"]), name)
        ws.drop(f"{name}-now", f"{name}-main")
        return out

    # The member with the fewest shingles of its own, against the other components of its bucket.
    mixed = mixed_members(joined, members.select("band", "key", "row", "n"), "mixed")
    own = own_shingles(sketched, mixed, ws)
    mixed = ws.write(mixed.join(own, "row", "left").withColumn(
        "own", F.coalesce("own", F.lit(0).cast("long"))), "owned")
    ws.drop("own")
    middle = ws.write(mixed.groupBy("band", "key").agg(F.min(F.struct("own", "row", "n", "comp")).alias("c"))
                      .select("band", "key", F.col("c.row").alias("a"), F.col("c.own").alias("own_a"),
                              F.col("c.n").alias("n_a"), F.col("c.comp").alias("comp_a")), "middle")
    spokes = mixed.join(middle, ["band", "key"]).where(
        (F.col("comp") != F.col("comp_a")) & _reachable(percent, "n", "own", "n_a", "own_a"))
    more = _verify(pairs(spokes.select("a", F.col("row").alias("b"))), sketched, ws, percent, "links-2")
    links = links.union(more)
    joined = components(links, ws, "second")

    # The rest in full: members outside the bucket's main component, with all of other components.
    apart = ws.write(mixed_members(joined, mixed.drop("comp", "main"), "apart").join(
        sketched.select("row", "bands", "signs", "odd"), "row"), "apart-bands")
    cols = ("row", "n", "own", "signs", "odd", "bands", "comp")
    x = apart.where("comp != main").select("band", "key", *(F.col(c).alias(f"{c}_x") for c in cols))
    y = apart.select("band", "key", "main", *(F.col(c).alias(f"{c}_y") for c in cols))
    rest = x.join(y, ["band", "key"]).where(
        (F.col("comp_x") != F.col("comp_y"))
        & ((F.col("comp_y") == F.col("main")) | (F.col("row_x") < F.col("row_y")))
        & _reachable(percent, "n_x", "own_x", "n_y", "own_y") & _shared("signs_x", "signs_y")
        & _differ_little(percent, "n_x", "odd_x", "n_y", "odd_y")
        # A pair that shares several buckets is proposed by the first of them alone.
        & (F.array_position(F.zip_with("bands_x", "bands_y", lambda a, b: a == b), True)
           == F.col("band") + 1))
    rest = pairs(rest.select(F.least("row_x", "row_y").alias("a"), F.greatest("row_x", "row_y").alias("b")))
    last = _verify(rest, sketched, ws, percent, "links-3")
    if not last.isEmpty():
        joined = components(links.union(last), ws, "third")
    ws.drop("buckets", "members", "mixed", "owned", "middle", "apart", "apart-bands")
    return joined


def own_shingles(sketched: DataFrame, members: DataFrame, ws: Workspace) -> DataFrame:
    """Write ``row, own``: how many shingles no other class among ``members`` has."""
    rows = ws.write(members.select("row").distinct(), "own-rows")
    texts = sketched.select("row", "text").join(broadcast_if_small(rows), "row", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingles(t.as_py()).view(np.int64) for t in part.column(1)]
                rows = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), pa.array(rows)],
                                                 ["shingle", "row"])

    found = texts.mapInArrow(run, "shingle long, row long")
    single = found.groupBy("shingle").agg(F.count("*").alias("n"), F.min("row").alias("row")).where("n = 1")
    out = ws.write(single.groupBy("row").agg(F.count("*").alias("own")), "own")
    ws.drop("own-rows")
    return out


def near_duplicates(docs: DataFrame, ws: Workspace, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row."""
    sketched = sketch(docs, ws, id_col, text_col)
    classes = ws.write(sketched.where("n > 0").groupBy("d1", "d2").agg(
        F.min("row").alias("node"), F.min("id").alias("id")), "classes")
    joined = link_classes(sketched, classes, ws, percent)
    of = classes.join(joined, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    heads = ws.write(of.groupBy("comp").agg(F.min("id").alias("component_id")), "heads")
    found = ws.write(of.select("d1", "d2", "comp").join(heads, "comp")
                     .select("d1", "d2", "component_id"), "found")
    rows = sketched.select("row", "id", "n", "d1", "d2")
    linked = rows.where("n > 0").join(found, ["d1", "d2"])
    alone = rows.where("n = 0").withColumn("component_id", F.col("id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, ws: Workspace, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id, and all rows without words."""
    numbered = ws.write(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                     F.col("__row").alias("row")).alias("key"), text_col)
    gone = ws.write(near_duplicates(keyed, ws, percent, "key", text_col).where("not kept")
                    .select(F.col("key.row").alias("__row")), "gone")
    ws.drop("sketch")
    return numbered.join(broadcast_if_small(gone), "__row", "left_anti").drop("__row")
