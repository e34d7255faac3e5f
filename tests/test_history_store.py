"""Pruned history, look-back as a subquery, Bloom filter, upkeep of latest entries, ordered report."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ingestflow import fixtures as fx
from ingestflow.operators import history as hist
from ingestflow.operators.reconcile import await_results
from ingestflow.schemas import HISTORY
from ingestflow.sources import history_store as store
from tests.conftest import SF_SMALL

NOW = dt.datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run-history") / "h")
    entries = fx.history(spark, SF_SMALL).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    odd = spark.createDataFrame([(p, "x", "LOADED", 1, 1, 0, None, NOW - dt.timedelta(hours=1), 10 ** 6 + i)
                                 for i, p in enumerate(["", None, "a b/ä=%", "123"])], HISTORY)
    store.append_history(entries.select(*HISTORY.names).where("seq % 2 = 0"), path)
    store.append_history(entries.select(*HISTORY.names).where("seq % 2 = 1").unionByName(odd), path)
    return path, entries.select(*HISTORY.names).unionByName(odd)


def _rows(df):
    return sorted(df.select(*HISTORY.names).collect(), key=str)


def test_store_gives_back_every_entry(spark, kept):
    path, entries = kept
    assert _rows(store.read_history(spark, path, HISTORY)) == _rows(entries)


def test_multi_pipe_equals_plain_and_prunes(spark, kept):
    path, entries = kept
    pending = fx.pending(spark, SF_SMALL).where((F.col("pipe") == "pipe_2") | (F.col("pipe") == "pipe_4"))
    got = store.history_multi_pipe(store.read_history(spark, path, HISTORY), path, pending, fx.NOW)
    assert _rows(got) == _rows(hist.history_multi_pipe(entries, pending, fx.NOW))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    got = got.select("*")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "pipe_key" in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicpruning" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    # the scan's own count: folders of other pipes are not read
    def leaves(node):
        kids = [node.children().apply(i) for i in range(node.children().length())]
        if node.nodeName().startswith(("AdaptiveSparkPlan", "ResultQueryStage")):
            kids = [node.executedPlan() if node.nodeName().startswith("Adaptive") else node.plan()]
        elif "QueryStage" in node.nodeName():
            kids = [node.plan()]
        return [node] if not kids else [x for k in kids for x in leaves(k)]
    found = [n for n in leaves(got._jdf.queryExecution().executedPlan())
             if n.nodeName().startswith("Scan parquet") and "pipe_key" in n.output().toString()]
    parts = [n.metrics().apply("numPartitions").value() for n in found]
    days = len({(r.pipe, r.event_ts.date()) for r in entries.collect()})
    assert parts and 0 < parts[0] < days / 2


def test_trailing_window_of_one_pipe(spark, kept):
    path, entries = kept
    held = store.read_history(spark, path, HISTORY)
    for pipe in ("pipe_2", "", "a b/ä=%", "123"):
        got = store.pipe_history(held, pipe, 2880, fx.NOW)
        assert _rows(got) == _rows(hist.pipe_history(entries, pipe, -2880, fx.NOW))
    assert store.pipe_history(held, "123", 2880, fx.NOW).count() == 1


def test_look_back_runs_inside_the_query(spark):
    """No action while planning, and the bound still reaches the scan."""
    tracker = spark.sparkContext.statusTracker()
    history, pending = fx.history(spark, SF_SMALL), fx.pending(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        df = hist.history_multi_pipe(history, pending, fx.NOW)
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan and "LessThanOrEqual(ts" in plan


def test_extreme_times_abort_nothing(spark):
    """The widest stamps and lineage starts route like the others."""
    pending = spark.createDataFrame(
        [("r1", "p", "a", {}, str(-2 ** 63), 0, 1), ("r2", "p", "b", {}, str(2 ** 63 - 1), -10 ** 17, 2),
         ("r3", "p", "c", {}, "0", -2 ** 63, 3), ("r4", "p", "d", {}, None, 2 ** 63 - 1, 4)],
        "request_id string, pipe string, file string, attributes map<string,string>, queued_ms string, "
        "lineage_ms long, arrival_seq long")
    history = spark.createDataFrame([("p", "d", "LOADED", 1, 1, 0, None, dt.datetime(1990, 1, 1), 1)], HISTORY)
    got = {r.request_id: (r.route, r.age_minutes) for r in await_results(pending, history, 60, NOW).collect()}
    age = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp()) // 60
    assert got == {"r1": ("waiting", None), "r2": ("waiting", (age * 60000 - 2 ** 63 + 1) // 60000 + 1),
                   "r3": ("unmatched", age), "r4": ("loaded", 0)}
    assert hist.lookback_minutes(pending, NOW).first()[0] == (age * 60000 + 10 ** 17) // 60000


def test_bloom_filter_at_the_history_scan(spark):
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    history = fx.history(spark, SF_SMALL)
    pending = fx.pending(spark, SF_SMALL).where(F.col("arrival_seq") < 60)
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = hist.history_for_pending(history, pending)
        rows = _rows(got.select(*HISTORY.names))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # one scan of each side, and one of the pending side for each key's filter
    assert "might_contain" in plan and plan.split("== Initial Plan ==")[0].count("FileScan") <= 4
    keys = {(r.pipe, r.file) for r in pending.collect() if r.pipe and r.file}
    assert rows == sorted((r for r in history.select(*HISTORY.names).collect() if (r.pipe, r.path) in keys), key=str)
    for salts in (2, 16):
        assert _rows(hist.history_for_pending(history, pending, salts=salts).select(*HISTORY.names)) == rows


def test_latest_entries_are_kept_up(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "latest")
    runs = [[("p", f"f{i}", "LOAD_FAILED", 1, 0, 1, "e", NOW, 1) for i in range(40)] + [(None, "n", "LOADED", 1, 1, 0, None, NOW, 1)],
            [("p", "f3", "LOADED", 2, 2, 0, None, NOW, 2), ("q", "f3", "LOADED", 3, 3, 0, None, NOW, 2)],
            [], [("p", "f3", "LOAD_FAILED", 2, 0, 2, "x", NOW, 1), (None, "n", "LOAD_FAILED", 1, 0, 1, "y", NOW, 3)]]
    seen = []
    for i, run in enumerate(runs):
        before = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path)
                  if d.startswith("bucket=")} if seen else {}
        df = spark.createDataFrame(run, HISTORY)
        hist.update_latest(df, path, buckets=8)
        if i == 1:
            hist.update_latest(df, path, buckets=8)  # a repeated run changes nothing
        seen += run
        expected = hist.latest_per_file(spark.createDataFrame(seen, HISTORY))
        assert _rows(hist.read_latest(spark, path)) == _rows(expected)
        after = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("bucket=")}
        changed = {d for d in after if before.get(d) != after[d]}
        assert len(changed) <= (8 if i == 0 else len(run))


def test_report_parts_are_in_order(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "report")
    entries = spark.range(20_000).select(
        F.lit("p").alias("pipe"), F.col("id").cast("string").alias("path"),
        F.when(F.col("id") % 5000 != 7, (F.col("id") * 7919) % 20_011).alias("seq"))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        assert hist.write_history_document(entries.repartition(6), out)
    finally:
        spark.conf.set(conf, "true")
    parts = sorted(n for n in os.listdir(out) if n.startswith("part-"))
    assert len(parts) > 1
    seqs = [json.loads(line).get("seq") for n in parts for line in open(os.path.join(out, n))]
    assert seqs == sorted(seqs, key=lambda s: -1 if s is None else s) and len(seqs) == 20_000
