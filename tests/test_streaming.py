"""Streaming await: micro-batches with loop-back of waiting rows."""

import datetime as dt
import json
import os

from ingestflow.functions.timing import epoch_ms
from ingestflow.schemas import HISTORY, PENDING
from ingestflow.streaming.await_stream import read_routes, start_await_stream

T0 = dt.datetime(2024, 3, 1, 12, 0)
MS = epoch_ms(T0)
MIN = 60000


def _req(rid, file, queued_min, lineage_min=None, pipe="p"):
    q = MS + int(queued_min * MIN)
    lin = MS + int((queued_min if lineage_min is None else lineage_min) * MIN)
    return {"request_id": rid, "pipe": pipe, "file": file, "attributes": {},
            "queued_ms": str(q), "lineage_ms": lin, "arrival_seq": int(rid[1:])}


def test_stream_await(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "requests")
    os.makedirs(src)
    batches = [
        [_req("r1", "a", 0), _req("r2", "b", 0), _req("r3", "c", 0),
         _req("r6", None, 0)],                               # missing file name
        [_req("r4", "d", 3.5, lineage_min=0), _req("r7", "a", 3.5, lineage_min=0)],
        [_req("r5", "e", 25)],
    ]
    for i, rows in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(os.path.join(src, f"part-{i}.json"), (1_000_000 + i, 1_000_000 + i))
    hist = spark.createDataFrame([
        ("p", "a", "LOADED", 1, 1, None, None, T0 + dt.timedelta(minutes=1), 1),
        ("p", "b", "LOAD_IN_PROGRESS", None, None, None, None, T0 + dt.timedelta(minutes=1), 2),
        ("p", "d", "LOADED", 2, 2, None, None, T0 + dt.timedelta(minutes=1), 4),
        ("p", "b", "LOADED", 5, 5, None, None, T0 + dt.timedelta(minutes=3), 3),
    ], HISTORY)
    hist_path = os.path.join(tmpdir_path, "history")
    hist.write.parquet(hist_path)

    clocks = [T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=4),
              T0 + dt.timedelta(minutes=30)]
    stream = (spark.readStream.schema(PENDING).option("maxFilesPerTrigger", 1).json(src))
    out_dir = os.path.join(tmpdir_path, "routes")
    q = start_await_stream(stream, lambda s: s.read.parquet(hist_path), 10, out_dir,
                           os.path.join(tmpdir_path, "chk"), trigger={"availableNow": True},
                           clock=lambda b, i: clocks[i], ticks=False)
    q.awaitTermination(300)
    got = {r.request_id: (r.route, r.batch) for r in read_routes(spark, out_dir).collect()}
    assert got == {"r1": ("loaded", 0), "r6": ("load_failure", 0), "r2": ("loaded", 1),
                   "r4": ("loaded", 1), "r7": ("loaded", 1), "r3": ("unmatched", 2),
                   "r5": ("waiting", 2)}


def _size(path):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path)
               for n in names if n.startswith("part-"))


def test_a_poll_writes_only_what_changed(spark, tmpdir_path):
    """Rows that go on waiting are not written again; compaction and replays keep every row once."""
    from ingestflow.streaming.await_stream import AwaitBatches
    rows = [_req(f"r{i}", f"f{i}", 0) for i in range(300)]
    first = spark.createDataFrame([tuple(r[f] for f in PENDING.names) for r in rows], PENDING)
    none = first.limit(0)
    hist = spark.createDataFrame([("p", "f7", "LOADED", 1, 1, None, None, T0 + dt.timedelta(minutes=3), 1)],
                                 HISTORY)
    out = os.path.join(tmpdir_path, "out")
    step = AwaitBatches(lambda s: hist, 60, out, lambda b, i: T0 + dt.timedelta(minutes=1 + i),
                        compact_every=4)
    written = []
    for i in range(7):
        before = _size(out)
        step(first if i == 0 else none, i)
        if i == 2:
            step(none, i)                                  # a replayed batch
        written.append(_size(out) - before)
    assert max(written[1], written[3], written[5]) < written[0] / 3
    got = {}
    for r in read_routes(spark, out, compact_every=4).collect():
        got.setdefault(r.request_id, []).append(r.route)
    assert got == {f"r{i}": ["loaded" if i == 7 else "waiting"] for i in range(300)}
