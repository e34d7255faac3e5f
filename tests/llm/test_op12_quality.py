"""Pairwise quality ranking: the fit against plain descent, held-out accuracy, hard rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ingestflow.llm import quality_ranking as qr
from ingestflow.llm.queries import op12_quality

SF = "/root/testdata/sf0.1"


def test_fit_is_the_least_loss():
    """Newton's weights equal those of long plain gradient descent."""
    rng = np.random.default_rng(1)
    better, worse = rng.normal(0.5, 1, (300, 3)), rng.normal(0, 1, (300, 3))
    w = np.zeros(3)
    for _ in range(20_000):
        margin = (better - worse) @ w
        w -= 0.2 * (-(better - worse).T @ (1 / (1 + np.exp(margin))) / 300 + 0.01 * w)
    assert np.allclose(qr.fit_pairs(better, worse, ridge=0.01), w, atol=1e-6)


def test_pairwise_order_is_recovered():
    """Preferences drawn from known scores by the Bradley-Terry law give back those scores' direction."""
    rng = np.random.default_rng(2)
    true = np.array([2.0, -1.0, 0.0, 0.5])
    a, b = rng.normal(size=(40_000, 4)), rng.normal(size=(40_000, 4))
    wins = rng.random(40_000) < 1 / (1 + np.exp(-(a - b) @ true))
    w = qr.fit_pairs(np.where(wins[:, None], a, b), np.where(wins[:, None], b, a), ridge=1e-6)
    assert np.allclose(w, true, atol=0.08)


def test_quantile_is_weighted():
    scores, weights = np.array([3.0, 1.0, 2.0, 4.0]), np.array([1.0, 1.0, 1.0, 1.0])
    assert qr.quantile(scores, weights, 0.25) == 1.5
    assert qr.quantile(scores, weights, 0.5) == 2.5
    assert qr.quantile(scores, np.array([1.0, 7.0, 1.0, 1.0]), 0.7) == 1.5
    assert qr.quantile(scores, weights, 0.99) == 4.0


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in op12_quality(spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 500 and all(scored[r["doc_id"]]["held_out"] for r in held)
    good = [scored[r["doc_id"]]["predicted"] for r in held if r["quality"] == 1]
    bad = [1 - scored[r["doc_id"]]["predicted"] for r in held if r["quality"] == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) >= 0.97


def test_every_document_is_scored(spark, scored):
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for k, r in scored.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)


def test_held_out_labels_are_not_read(spark):
    """Turning every held-out label over changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(qr.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (qr.learn(docs, x.where(qr.learns())) for x in (labels, turned))
    assert (a.weights == b.weights).all() and a.threshold == b.threshold and a.weights.any()


HARD = [None, "", " ", "\n\n", "a", "word " * 50_000, "x" * 300_000, "日本語", "\x00", "!!! ### $$$", "é" * 10]


def test_hard_texts_and_rows(spark):
    rows = [(k, t, "en", 0.5, 1) for k, t in enumerate(HARD)] + [(None, "a b", "en", 0.1, 0), (3, "x", "de", 0.2, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, predicted int")
    labels = spark.createDataFrame(
        [(k, k % 2) for k in range(len(HARD))] * 2 + [(4, 0), (None, 1), (5, None), (6, 7), (99, 1)],
        "doc_id long, quality int")
    model = qr.learn(docs, labels)
    assert model.weights.any()
    got = qr.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert got[0]["score"] == got[1]["score"]


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for labels in (none, one):
        assert {(r["score"], r["predicted"]) for r in qr.score(docs, qr.learn(docs, labels)).collect()} == {(0.5, 1)}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert qr.score(empty, qr.learn(empty, one)).count() == 0


def test_copies_of_one_id_teach_once(spark):
    docs = spark.createDataFrame([(1, "good words here now")] * 500 + [(2, "bad ### ### ###")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in qr.score(docs, qr.learn(docs, labels)).collect()}
    assert got == {1: 1, 2: 0}
