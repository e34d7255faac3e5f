"""Await routing: truth table, fixture counts, hot-key path, rounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ingestflow import fixtures as fx
from ingestflow.functions.timing import epoch_ms
from ingestflow.operators.reconcile import await_results, await_rounds
from ingestflow.schemas import HISTORY, PENDING

NOW = dt.datetime(2024, 1, 31)
NOW_MS = epoch_ms(NOW)
MIN = 60000


def _pending(spark, rows):
    return spark.createDataFrame(
        [(f"r{i}", p, f, {}, q, NOW_MS - 5 * MIN, i) for i, (p, f, q) in enumerate(rows)], PENDING)


def _history(spark, rows):
    return spark.createDataFrame(
        [(p, path, st, 10, 9, e, fe, NOW - dt.timedelta(minutes=2), s)
         for p, path, st, e, fe, s in rows], HISTORY)


def test_truth_table(spark):
    old = str(NOW_MS - 20 * MIN)
    young = str(NOW_MS - 2 * MIN)
    exact = str(NOW_MS - 10 * MIN)   # age == max_age: not older, keeps waiting
    pend = _pending(spark, [
        (None, "a", young),            # 0 no pipe
        ("p", None, young),            # 1 no file
        ("p", "loaded", old),          # 2
        ("p", "partial", old),         # 3
        ("p", "failed", old),          # 4
        ("p", "progress", old),        # 5 in progress: waiting, no age test
        ("p", "none_old", old),        # 6 unmatched
        ("p", "none_young", young),    # 7 waiting
        ("p", "none_exact", exact),    # 8 waiting (strict >)
        ("p", "none_blank", ""),       # 9 waiting, stamped now
        ("p", "bad", "12x"),           # 10 invalid stamp
        ("p", "shared", young),        # 11 first of key: young ...
        ("p", "shared", old),          # 12 ... so this one uses the young age → waiting
        ("q", "loaded", old),          # 13 other pipe: no history → unmatched
    ])
    hist = _history(spark, [
        ("p", "loaded", "LOADED", None, None, 1),
        ("p", "partial", "PARTIALLY_LOADED", 3, "e3", 2),
        ("p", "failed", "LOAD_IN_PROGRESS", None, None, 3),
        ("p", "failed", "LOAD_FAILED", 5, "e5", 4),     # later entry wins
        ("p", "progress", "LOAD_IN_PROGRESS", None, None, 5),
    ])
    out = {r.arrival_seq: r for r in await_results(pend, hist, 10, NOW).collect()}
    routes = [out[i].route for i in range(14)]
    assert routes == ["load_failure", "load_failure", "loaded", "partially_loaded",
                      "load_failure", "waiting", "unmatched", "waiting", "waiting", "waiting",
                      "load_failure", "waiting", "waiting", "unmatched"]
    assert out[0].error.endswith("attribute: pipe")
    assert out[1].error.endswith("attribute: file")
    assert (out[3].error, out[3].error_count) == ("e3", "3")
    assert (out[4].error, out[4].error_count) == ("e5", "5")
    assert out[2].error is None and out[2].error_count is None
    assert out[6].queued_ms is None                       # cleared on unmatched
    assert out[9].queued_ms == str(NOW_MS)                # stamped
    assert out[7].queued_ms == str(NOW_MS - 2 * MIN)      # kept
    assert out[10].error == "invalid queued timestamp"
    assert out[12].age_minutes == 2                       # shares the first row's age
    assert out[2].payload == '{"path":"loaded","status":"LOADED","rows_parsed":10,"rows_loaded":9}'


def test_history_outside_window_is_ignored(spark):
    pend = _pending(spark, [("p", "x", str(NOW_MS - 30 * MIN))])  # lineage 5 min ago
    hist = spark.createDataFrame(
        [("p", "x", "LOADED", 1, 1, None, None, NOW - dt.timedelta(minutes=30), 1)], HISTORY)
    (r,) = await_results(pend, hist, 10, NOW).collect()
    assert r.route == "unmatched"


EXPECTED = {  # FIXTURES.md, sf0.001
    ("loaded", False): 29, ("partially_loaded", False): 38, ("load_failure", False): 30,
    ("load_failure", True): 3, ("waiting", False): 29, ("unmatched", False): 59,
}


def test_fixture_counts_sf0001(spark):
    out = await_results(fx.pending(spark, "/root/testdata/sf0.001"),
                        fx.history(spark, "/root/testdata/sf0.001"), fx.MAX_AGE_MINUTES, fx.NOW)
    got = {(r.route, r.missing): r.n for r in out.groupBy(
        "route", F.coalesce(F.col("error").startswith("Flow"), F.lit(False)).alias("missing")
    ).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == EXPECTED


def test_hot_key_path_gives_same_rows(spark):
    d = "/root/testdata/sf0.001"
    p = fx.pending(spark, d)
    # Make one key hold a third of all rows.
    hot = p.withColumn("pipe", F.when(F.col("arrival_seq") % 3 == 0, F.lit("pipe_0"))
                       .otherwise(F.col("pipe"))) \
           .withColumn("file", F.when(F.col("arrival_seq") % 3 == 0, F.lit("f_0.csv"))
                       .otherwise(F.col("file")))
    h = fx.history(spark, d)
    base = await_results(hot, h, fx.MAX_AGE_MINUTES, fx.NOW)
    forced = await_results(hot, h, fx.MAX_AGE_MINUTES, fx.NOW, min_hot_rows=0, max_hot_keys=20)
    cols = ["arrival_seq", "route", "queued_ms", "error", "error_count", "age_minutes"]
    a = sorted(tuple(r) for r in base.select(*cols).collect())
    b = sorted(tuple(r) for r in forced.select(*cols).collect())
    assert a == b and len(a) == p.count()


def test_rounds_loop_back(spark, tmpdir_path):
    pend = _pending(spark, [("p", "later", str(NOW_MS - 2 * MIN)),
                            ("p", "never", str(NOW_MS - 2 * MIN))])
    hist = spark.createDataFrame(
        [("p", "later", "LOADED", 1, 1, None, None, NOW + dt.timedelta(minutes=5), 1)], HISTORY)
    nows = [NOW, NOW + dt.timedelta(minutes=6), NOW + dt.timedelta(minutes=30)]
    out = {r.request_id: r for r in await_rounds(pend, hist, 10, nows).collect()}
    assert (out["r0"].route, out["r0"]["round"]) == ("loaded", 2)
    assert (out["r1"].route, out["r1"]["round"]) == ("unmatched", 3)


def test_rows_that_arrive_after_the_last_round_are_reported(spark):
    pend = _pending(spark, [("p", "a", str(NOW_MS - MIN)), ("p", "b", str(NOW_MS + 90 * MIN)),
                            ("p", "a", str(NOW_MS + 91 * MIN))])
    hist = spark.createDataFrame([], HISTORY)
    nows = [NOW, NOW + dt.timedelta(minutes=30)]
    out = await_rounds(pend, hist, 10, nows).collect()
    assert sorted((r.request_id, r.route, r["round"]) for r in out) == [
        ("r0", "unmatched", 2), ("r1", "waiting", 2), ("r2", "waiting", 2)]


def test_a_bad_stamp_changes_no_other_row(spark):
    pend = _pending(spark, [("p", "a", "soon"), ("p", "a", str(NOW_MS - 90 * MIN)), ("p", "a", str(NOW_MS))])
    out = {r.request_id: (r.route, r.age_minutes) for r in
           await_results(pend, spark.createDataFrame([], HISTORY), 60, NOW).collect()}
    assert out == {"r0": ("load_failure", 90), "r1": ("unmatched", 90), "r2": ("unmatched", 90)}


def test_missing_order_numbers_keep_the_match(spark):
    pend = _pending(spark, [("p", "a", str(NOW_MS - MIN))]).withColumn(
        "arrival_seq", F.lit(None).cast("long"))
    hist = spark.createDataFrame(
        [("p", "a", "LOADED", 1, 1, None, None, NOW - dt.timedelta(seconds=9), None)], HISTORY)
    (r,) = await_results(pend, hist, 60, NOW).collect()
    assert (r.route, r.age_minutes) == ("loaded", 1)


def test_empty_pending_gives_empty_result(spark):
    pend = spark.createDataFrame([], PENDING)
    hist = _history(spark, [("p", "a", "LOADED", None, None, 1)])
    out = await_results(pend, hist, 10, NOW)
    assert out.count() == 0
    assert out.columns[-6:] == ["age_minutes", "route", "status", "error", "error_count",
                                "payload"]
