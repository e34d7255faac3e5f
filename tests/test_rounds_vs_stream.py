"""Batch rounds with loop-back and the streaming form end in the same routes."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ingestflow import fixtures as fx
from ingestflow.operators.reconcile import await_rounds
from ingestflow.schemas import PENDING
from ingestflow.streaming.await_stream import read_routes, start_await_stream

D = "/root/testdata/sf0.001"
NOWS = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 31)]


def test_rounds_equal_stream(spark, tmpdir_path):
    pending = fx.pending(spark, D)
    history = fx.history(spark, D)
    batch = {r.request_id: r.route for r in
             await_rounds(pending, history, fx.MAX_AGE_MINUTES, NOWS).collect()}

    # Same arrivals, one input file per round, fed to the stream.
    src = os.path.join(tmpdir_path, "req")
    os.makedirs(src)
    rows = pending.withColumn("q", F.col("queued_ms").cast("long")).collect()
    prev = None
    for i, now in enumerate(NOWS):
        hi = int(now.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        part = [r for r in rows if r.q <= hi and (prev is None or r.q > prev)]
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            for r in part:
                d = r.asDict()
                d.pop("q")
                f.write(json.dumps(d) + "\n")
        os.utime(os.path.join(src, f"p{i}.json"), (1_000_000 + i, 1_000_000 + i))
        prev = hi
    hist_path = os.path.join(tmpdir_path, "hist")
    history.write.parquet(hist_path)
    stream = spark.readStream.schema(PENDING).option("maxFilesPerTrigger", 1).json(src)
    out = os.path.join(tmpdir_path, "out")
    q = start_await_stream(stream, lambda s: s.read.parquet(hist_path), fx.MAX_AGE_MINUTES, out,
                           os.path.join(tmpdir_path, "chk"), trigger={"availableNow": True},
                           clock=lambda b, i: NOWS[i], ticks=False)
    q.awaitTermination(600)
    streamed = {r.request_id: r.route for r in read_routes(spark, out).collect()}
    assert streamed == batch
    assert len(batch) == pending.count()
