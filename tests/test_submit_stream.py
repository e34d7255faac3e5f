"""The retry stream decides as the batch rounds do and loses no request."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow import fixtures as fx
from ingestflow.operators.submit import submit_rounds
from ingestflow.streaming.submit_stream import SubmitBatches, read_submitted, start_submit_stream
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("request_id", "pipe", "file")])


def test_stream_decides_as_rounds(spark, tmpdir_path):
    first = fx.outcomes(spark, SF_SMALL, 1)
    second = fx.outcomes(spark, SF_SMALL, 2).where(F.col("request_id").cast("long") % 3 != 0)
    rounds = [first, second, second.limit(0)]
    batch = {r.request_id: (r.route, r["round"]) for r in submit_rounds(rounds).collect()}

    def submit(todo):
        answers = None
        for attempt, outcomes in enumerate(rounds, 1):
            part = todo.where(F.col("attempt") == attempt).join(
                outcomes.select("request_id", "kind", "message"), "request_id").select("submit_id", "kind", "message")
            answers = part if answers is None else answers.unionByName(part)
        return answers

    fn, out = SubmitBatches(submit, SCHEMA, tmpdir_path), tmpdir_path
    requests = first.select("request_id", "pipe", "file")
    fn(requests, 0)
    none = requests.limit(0)
    fn(none, 1)
    got = read_submitted(spark, out, SCHEMA).collect()
    fn(none, 1)  # a replay changes nothing
    assert sorted(read_submitted(spark, out, SCHEMA).collect(), key=str) == sorted(got, key=str)
    fn(none, 2)
    fn(none, 3)
    rows = read_submitted(spark, out, SCHEMA).collect()
    assert len(rows) == len(batch) and {r.request_id: r.route for r in rows} == {k: v[0] for k, v in batch.items()}
    assert {r.request_id: r.attempt for r in rows if r.route != "retry"} == {
        k: v[1] for k, v in batch.items() if v[0] != "retry"}
    assert any(v[0] == "retry" for v in batch.values()) and {r.attempt for r in rows if r.route == "retry"} == {5}
    assert sorted(os.listdir(os.path.join(out, "retry"))) == ["batch=2", "batch=3"]


def test_stream_with_equal_and_missing_ids(spark, tmpdir_path):
    """Requests are told apart by their arrival, whatever their ids; silence is retried."""
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    for i, rows in enumerate([[{"request_id": "a"}, {"request_id": "a"}, {}], [{"request_id": "b"}]]):
        with open(os.path.join(src, f"q{i}.json"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(os.path.join(src, f"q{i}.json"), (1_000_000 + i, 1_000_000 + i))

    def submit(todo):
        return todo.where("attempt > 1").select("submit_id", F.lit(None).cast("string").alias("kind"),
                                                F.lit(None).cast("string").alias("message"))

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    out = os.path.join(tmpdir_path, "out")
    start_submit_stream(stream, submit, out, os.path.join(tmpdir_path, "chk"), {"availableNow": True},
                        ticks=False).awaitTermination(120)
    got = sorted((r.request_id or "", r.route, r.attempt) for r in read_submitted(spark, out, SCHEMA).collect())
    assert got == [("", "success", 2), ("a", "success", 2), ("a", "success", 2), ("b", "retry", 2)]
