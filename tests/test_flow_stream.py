"""The chained stream: outputs of each batch, replays, ageing; folders compacted at any rate."""

import datetime as dt
import os

import pytest

from ingestflow.operators.load import PipeSpec
from ingestflow.schemas import PENDING
from ingestflow.streaming.await_stream import AwaitBatches, read_routes
from ingestflow.streaming.flow_stream import RESULT, FlowBatches

NOW = dt.datetime(2024, 5, 1, 8, 0)
SPECS = [PipeSpec("c", schema_ddl="k INT, v STRING"), PipeSpec("j", "json", "k INT", on_error="SKIP_FILE")]


def _stage(root):
    os.makedirs(os.path.join(root, "st"))
    for name, text in {"good.csv": "1,a\n2,b\n", "mixed.csv": "3,c\nx,d\n", "one.json": '{"k": 5}\n',
                       "bad.json": '{"k": 5}\n{broken\n', "late.csv": "9,z\n"}.items():
        with open(os.path.join(root, "st", name), "w") as f:
            f.write(text)


def _everything(spark, out):
    found = {}
    for part in ("submitted", "history", "rows/c", "rows/j", "await/routes", "await/waiting"):
        path = os.path.join(out, part)
        rows = []
        for batch in sorted(os.listdir(path)):
            if not batch.startswith("batch="):
                continue
            files = [os.path.join(d, f) for d, _, names in os.walk(os.path.join(path, batch)) for f in names
                     if f.endswith(".parquet")]
            if files:
                df = spark.read.option("recursiveFileLookup", "true").parquet(*files)
                rows += [(batch, str(sorted(r.asDict(True).items(), key=str))) for r in df.drop("wait_id").collect()]
        found[part] = sorted(rows)
    return found


def test_batches_and_replays(spark, tmpdir_path):
    stages, out = os.path.join(tmpdir_path, "stages"), os.path.join(tmpdir_path, "out")
    _stage(stages)
    ticks = iter(range(100))
    fn = FlowBatches(SPECS, stages, 60, out, lambda b, i: NOW + dt.timedelta(minutes=40 * i, seconds=next(ticks)))

    def results(*rows):
        return spark.createDataFrame([(f"r{n}", pipe, file, {"n": str(n)}) for n, pipe, file in rows], RESULT)

    batches = [results((1, "c", "st/good.csv"), (2, "c", "st/mixed.csv"), (3, "j", "st/one.json"),
                       (4, "none", "st/x.csv"), (5, "c", "st/good.csv")),
               results((6, "j", "st/bad.json"), (7, "c", "st/good.csv")), results()]
    for i, b in enumerate(batches):
        fn(b, i)
    routes = {r.request_id: r.route for r in read_routes(spark, f"{out}/await").collect()}
    assert routes == {"r1": "loaded", "r2": "partially_loaded", "r3": "loaded", "r5": "loaded",
                      "r6": "load_failure", "r7": "waiting"}
    before = _everything(spark, out)
    fn(batches[2], 2)  # the last batch again
    assert _everything(spark, out) == before
    assert [len(before[k]) for k in ("submitted", "rows/c", "rows/j")] == [7, 3, 1]
    # r7's file was loaded before r7 was queued: its entry is too old for it, and it ages out
    fn(results(), 3)
    assert {r.request_id: r.route for r in read_routes(spark, f"{out}/await").collect()}["r7"] == "unmatched"


def test_a_batch_cut_short_is_finished_by_its_replay(spark, tmpdir_path, monkeypatch):
    stages = os.path.join(tmpdir_path, "stages")
    _stage(stages)
    batch = spark.createDataFrame([("r1", "c", "st/good.csv", {}), ("r2", "j", "st/one.json", {})], RESULT)
    whole, cut = os.path.join(tmpdir_path, "whole"), os.path.join(tmpdir_path, "cut")
    FlowBatches(SPECS, stages, 60, whole, lambda b, i: NOW)(batch, 0)
    fn = FlowBatches(SPECS, stages, 60, cut, lambda b, i: NOW)
    monkeypatch.setattr(AwaitBatches, "__call__", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fn(batch, 0)
    monkeypatch.undo()
    FlowBatches(SPECS, stages, 60, cut, lambda b, i: NOW + dt.timedelta(days=3))(batch, 0)
    assert _everything(spark, cut) == _everything(spark, whole)


def test_any_compaction_rate(spark, tmpdir_path):
    """Readers find the compacted folders by their marks; the rate may change between starts."""
    ms = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    history = spark.createDataFrame([], "pipe string, path string, status string, rows_parsed long, "
                                    "rows_loaded long, errors_seen long, first_error string, event_ts timestamp, seq long")
    out = tmpdir_path
    for i in range(9):
        rows = [(f"r{i}", "p", f"f{i}", {}, str(ms), ms, i)] if i < 5 else []
        rate = 2 if i < 4 else 3 if i < 7 else 50
        AwaitBatches(lambda s: history, 60 if i < 8 else -1, out, lambda b, k: NOW, compact_every=rate)(
            spark.createDataFrame(rows, PENDING), i)
        got = sorted((r.request_id, r.route) for r in read_routes(spark, out).collect())
        assert got == [(f"r{k}", "waiting" if i < 8 else "unmatched") for k in range(min(i + 1, 5))]
    assert sorted(os.listdir(os.path.join(out, "compacted"))) and len(os.listdir(os.path.join(out, "compacted"))) >= 3
