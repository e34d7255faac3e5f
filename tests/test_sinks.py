"""Report writer (only when non-empty), route fan-out, timer ticks in the stream."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from ingestflow.functions.timing import epoch_ms
from ingestflow.operators.history import pipe_history, write_history_document
from ingestflow.schemas import HISTORY, PENDING
from ingestflow.sinks.routes import write_routes
from ingestflow.streaming.await_stream import read_routes, start_await_stream

NOW = dt.datetime(2024, 2, 1)


def test_history_document_written_only_when_non_empty(spark, tmpdir_path):
    h = spark.createDataFrame(
        [("p", "a", "LOADED", 1, 1, None, None, NOW - dt.timedelta(minutes=5), 2),
         ("p", "b", "LOAD_FAILED", 1, 0, 1, "e", NOW - dt.timedelta(minutes=3), 1),
         ("q", "c", "LOADED", 1, 1, None, None, NOW - dt.timedelta(minutes=1), 3)], HISTORY)
    out = os.path.join(tmpdir_path, "doc")
    assert write_history_document(pipe_history(h, "p", -10, NOW), out)
    lines = []
    for n in sorted(os.listdir(out)):
        if n.startswith("part-"):
            with open(os.path.join(out, n)) as f:
                lines += [json.loads(x) for x in f if x.strip()]
    assert sorted(d["seq"] for d in lines) == [1, 2]
    assert "errors_seen" not in [d for d in lines if d["seq"] == 2][0]   # nulls omitted
    empty = os.path.join(tmpdir_path, "none")
    assert not write_history_document(pipe_history(h, "zzz", 10, NOW), empty)
    assert not os.path.exists(empty)


def test_write_routes(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "loaded"), (2, "waiting"), (3, "loaded")],
                               "id int, route string")
    out = os.path.join(tmpdir_path, "routes")
    write_routes(df, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("route=")) == [
        "route=loaded", "route=waiting"]
    assert spark.read.parquet(os.path.join(out, "route=loaded")).count() == 2


def test_ticks_advance_time_without_new_requests(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "req")
    os.makedirs(src)
    t0 = epoch_ms(NOW)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"request_id": "r1", "pipe": "p", "file": "x", "attributes": {},
                            "queued_ms": str(t0), "lineage_ms": t0, "arrival_seq": 1}) + "\n")
    hist = os.path.join(tmpdir_path, "hist")
    spark.createDataFrame([], HISTORY).write.parquet(hist)
    stream = spark.readStream.schema(PENDING).json(src)
    out = os.path.join(tmpdir_path, "out")
    # Each batch advances the clock by 10 minutes; max age is 25 minutes.
    q = start_await_stream(stream, lambda s: s.read.parquet(hist), 25, out,
                           os.path.join(tmpdir_path, "chk"),
                           trigger={"processingTime": "1 second"}, every_seconds=1,
                           clock=lambda b, i: NOW + dt.timedelta(minutes=10 * i))
    deadline = time.time() + 60
    try:
        while time.time() < deadline:
            time.sleep(2)
            routes = os.path.join(out, "routes")
            if os.path.exists(routes) and any(
                    os.path.exists(os.path.join(routes, d, "route=unmatched"))
                    for d in os.listdir(routes)):
                break
    finally:
        q.stop()
    routes = {r.request_id: r.route for r in read_routes(spark, out).collect()}
    assert routes == {"r1": "unmatched"}


def test_scheduled_history_reports(spark, tmpdir_path):
    from ingestflow.streaming.history_reports import start_history_reports
    h = spark.createDataFrame(
        [("p", "a", "LOADED", 1, 1, None, None, NOW + dt.timedelta(minutes=15), 1)], HISTORY)
    hist = os.path.join(tmpdir_path, "hist")
    h.write.parquet(hist)
    out = os.path.join(tmpdir_path, "reports")
    # Tick i reports [NOW + 10i - 10 min, NOW + 10i]: only tick 2 sees the entry (NOW + 15).
    q = start_history_reports(spark, lambda s: s.read.parquet(hist), "p", 10, out,
                              os.path.join(tmpdir_path, "chk"), period="1 second",
                              clock=lambda b, i: NOW + dt.timedelta(minutes=10 * i))
    deadline = time.time() + 60
    try:
        while time.time() < deadline:
            time.sleep(1)
            if q.lastProgress and q.lastProgress["batchId"] >= 4:
                break
    finally:
        q.stop()
    written = sorted(d for d in os.listdir(out) if d.startswith("batch="))
    assert written == ["batch=2"]


def test_reports_keep_the_event_time(spark, tmpdir_path):
    from ingestflow.streaming.history_reports import ReportBatches
    h = spark.createDataFrame(
        [("p", "a", "LOADED", 1, 1, None, None, NOW - dt.timedelta(minutes=5), 1)], HISTORY)
    ReportBatches(lambda s: h, "p", 10, tmpdir_path, lambda b, i: NOW)(spark.range(1), 0)
    (line,) = spark.read.json(os.path.join(tmpdir_path, "batch=0")).collect()
    assert line.event_ts.startswith("2024-01-31T23:55")
