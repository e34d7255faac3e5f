"""Hard negatives against a plain version and the query's SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ingestflow.llm import hard_negatives as hn
from ingestflow.llm.common import Workspace
from ingestflow.llm.queries import op13_hard_negatives
from ingestflow.llm.sql import ORACLE
from tests.conftest import SF_MID, SF_SMALL


def brute(rows, n_positives=5, n_negatives=10, least=30, most=90, every=100):
    """(anchor, positive, rank, negative, positive score, negative score), row by row."""
    kept = [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows
            if i is not None and v is not None and l is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in kept:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in kept
                  if j != i and len(w) == len(v)]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:n_positives]:
            band = [x for x in scored if x[2] != label and least * -s <= 100 * -x[0] <= most * -s]
            out += [(i, p, r, n[1], -s, -n[0]) for r, n in enumerate(band[:n_negatives], 1)]
    return sorted(out)


def mined(spark, rows, schema="vec_id long, embedding array<float>, label int", **kw):
    df = spark.createDataFrame(rows, schema)
    table = hn.integer_rows(df, Workspace(spark, "t13"))
    return sorted(tuple(r) for r in hn.mine(table, F.col("vec_id") % kw.pop("every", 100) == 0,
                                            Workspace(spark, "t13"), **kw).collect())


def vectors(seed, n, dim, spread=0.4, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] + centres.mean(axis=0) + rng.normal(size=dim) * spread
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], label))
    return out


@pytest.mark.parametrize("seed,n,dim,spread", [(1, 600, 16, 0.4), (2, 700, 7, 1.5), (3, 400, 1, 1.0), (4, 500, 33, 0.1)])
def test_against_brute_force(spark, seed, n, dim, spread):
    rows = vectors(seed, n, dim, spread)
    expected = brute(rows, every=20)
    assert mined(spark, rows, every=20) == expected
    assert expected or dim == 1


def test_other_numbers_and_bands(spark):
    rows = vectors(5, 500, 12)
    assert mined(spark, rows, every=25, n_positives=2, n_negatives=3, least=-50, most=100) == \
        brute(rows, 2, 3, -50, 100, every=25)


def test_hard_rows(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(4)], rng.randrange(3)) for i in range(300)]
    rows += [(1000, [1.0, 1.0, 1.0, 1.0], 1)] + [(1000 + k, [0.5] * 4, 2) for k in range(1, 30)]  # ties
    rows += [(2000, None, 1), (2100, [0.1, None, 0.2, 0.3], 1), (2200, [float("nan")] * 4, 1),
             (2300, [float("inf"), 0.0, 0.0, 0.0], 1), (2400, [0.5] * 4, None), (None, [0.5] * 4, 1),
             (2500, [], 1), (2600, [], 2), (2700, [0.5] * 3, 1), (2701, [0.5] * 3, 1), (2702, [0.4] * 3, 2),
             (2800, [0.0] * 4, 0)]
    assert mined(spark, rows) == brute(rows)


def test_one_hot_label_and_copies(spark):
    rows = [(i, [0.6, 0.8], 0) for i in range(400)] + [(1000 + i, [0.8, 0.1 * (i % 3)], 1) for i in range(60)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_empty_tables_and_extra_columns(spark):
    rows = vectors(7, 300, 8)
    twice = rows + [rows[0]] + [rows[37]]
    once, got = brute(rows), mined(spark, twice)
    assert {r[0] for r in got} == {r[0] for r in once}
    assert sum(r[0] == 0 for r in got) >= 2 * sum(r[0] == 0 for r in once) - 40
    assert mined(spark, []) == []
    clash = [(*r, 1, 2) for r in rows]
    assert mined(spark, clash, "vec_id long, embedding array<double>, label long, block int, anchor int") == once


def test_large_components_do_not_overflow(spark):
    rows = [(i, [3e38 if (i + k) % 5 == 0 else -1e30 * k for k in range(6)], i % 3) for i in range(200)]
    for r in mined(spark, rows):
        assert 30 * r[4] <= 100 * r[5] <= 90 * r[4]


@pytest.mark.parametrize("segments", [(1,), (2, 8), (64,)])
@pytest.mark.parametrize("dense", [0, 1])
def test_bounds_hold(segments, dense, monkeypatch):
    monkeypatch.setattr(hn, "SEGMENTS", segments)
    monkeypatch.setattr(hn, "DENSE", dense)
    rng = np.random.default_rng(8)
    x = rng.integers(-300, 300, (200, 24))
    block, exact = hn.Block(np.arange(200), np.zeros(200, int), x), x[:50] @ x.T

    def holds(alive, low, high):
        assert (low <= exact).all() and (exact <= high).all()
        return alive

    alive = block.refine(x[:50], np.ones(exact.shape, bool), holds)
    assert (block.scores(x[:50], alive) == exact).all()


def test_summaries_spare_exact_scores():
    """Rows whose components vary slowly are mostly ruled out by the summaries."""
    rng = np.random.default_rng(9)
    x = np.floor(16 * np.cumsum(rng.normal(size=(4000, 64)), axis=1)).astype(int)
    block, exact = hn.Block(np.arange(4000), np.zeros(4000, int), x), x[:20] @ x.T
    kept = block.refine(x[:20], np.ones(exact.shape, bool),
                        lambda alive, low, high: alive & (high >= hn.kth_highest(low, alive, 5)))
    assert kept.mean() < 0.1
    for i in range(20):
        assert kept[i, np.argsort(-exact[i], kind="stable")[:5]].all()


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got = op13_hard_negatives(spark, sf)
    cur = con.execute(ORACLE["op13_hard_negatives"])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    theirs = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == theirs and theirs
