"""Keyed-state await: same routes as the batch form, timers without arrivals, hot keys split."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.operators.reconcile import OUTPUT_EXTRA, await_results
from ingestflow.schemas import HISTORY, PENDING
from ingestflow.streaming.keyed_await import STATE_CONF, start_keyed_await, waiting_rows

MIN = 60000
MAX_AGE = 10


@pytest.fixture(autouse=True)
def rocksdb(spark):
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    yield
    for k in STATE_CONF:
        spark.conf.unset(k)


def _request(rid, file, age_ms, now, pipe="p", stamp=None, seq=...):
    at = now - age_ms
    return {"request_id": rid, "pipe": pipe, "file": file, "attributes": {"filename": file or "", "n": rid},
            "queued_ms": str(at) if stamp is None else stamp, "lineage_ms": now - 30 * MIN,
            "arrival_seq": int(rid[1:]) if seq is ... else seq}


def _entry(file, status, seq, minutes_ago, now, pipe="p"):
    bad = status in ("PARTIALLY_LOADED", "LOAD_FAILED")
    return {"pipe": pipe, "path": file, "status": status, "rows_parsed": 9, "rows_loaded": 5,
            "errors_seen": 4 if bad else 0, "first_error": f"err {seq}" if bad else None,
            "event_ts": dt.datetime.fromtimestamp(now / 1000 - minutes_ago * 60, dt.timezone.utc)
            .strftime("%Y-%m-%dT%H:%M:%S.000Z"), "seq": seq}


def _write(root, name, rows):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, f".{name}"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    os.rename(os.path.join(root, f".{name}"), os.path.join(root, name))


def _wait(query, until, seconds=120):
    end = time.time() + seconds
    while time.time() < end:
        if query.exception():
            raise query.exception()
        if until():
            return
        time.sleep(0.5)
    raise AssertionError("the stream did not get there")


def _streams(spark, root):
    for d in ("requests", "entries"):
        os.makedirs(os.path.join(root, d), exist_ok=True)
    return (spark.readStream.schema(PENDING).json(os.path.join(root, "requests")),
            spark.readStream.schema(HISTORY).json(os.path.join(root, "entries")))


def _out(spark, path):
    """What the sink has committed so far."""
    log = os.path.join(path, "_spark_metadata")
    if not (os.path.isdir(log) and any(n.isdigit() for n in os.listdir(log))):
        return []
    schema = T.StructType([*PENDING.fields, *[T.StructField(c, T.LongType() if c == "age_minutes" else T.StringType())
                                              for c in OUTPUT_EXTRA]])
    return spark.read.schema(schema).parquet(path).collect()


def _key(r):
    return (r["request_id"], r["pipe"], r["file"], r["route"], r["status"], r["error"], r["error_count"],
            None if r["payload"] is None else json.dumps(json.loads(r["payload"]), sort_keys=True),
            r["arrival_seq"], tuple(sorted(r["attributes"].items())))


@pytest.mark.parametrize("salts,hot", [(1, False), (4, True)])
def test_same_routes_as_batch(spark, tmpdir_path, salts, hot):
    """Entries before and after their requests, ageing without arrivals, a hot key, bad rows."""
    root, out = tmpdir_path, os.path.join(tmpdir_path, "out")
    chk = os.path.join(tmpdir_path, "chk")
    asked, known = _streams(spark, root)
    kw = {"salts": salts, "hot": F.col("file").startswith("hot") if hot else None}
    q = start_keyed_await(asked, known, MAX_AGE, out, chk, {"processingTime": "1 second"}, **kw)
    _write(os.path.join(root, "requests"), "warm.json", [_request("r0", None, 0, 0)])
    _wait(q, lambda: len(_out(spark, out)) == 1)
    now = int(time.time() * 1000)
    soon = (MAX_AGE + 1) * MIN - 25_000  # too old in 25 seconds
    requests = [_request("r1", "a", 0, now), _request("r2", "b", 0, now), _request("r3", "c", 0, now),
                _request("r4", "d", soon, now), _request("r5", "d", 0, now), _request("r6", None, 0, now),
                _request("r7", "e", 0, now, pipe=None), _request("r8", "a", 0, now, stamp="soon"),
                _request("r9", "f", soon, now), _request("r10", "g", 5 * MIN, now),
                _request("r11", "a", 0, now, stamp=""), _request("r12", "h", 20 * MIN, now),
                _request("r13", "i", 0, now), _request("r14", "i", 20 * MIN, now, seq=None)]
    requests += [_request(f"r{k}", "hot", soon if k == 100 else 0, now) for k in range(100, 400)]
    requests += [_request(f"r{k}", "hot2", 0, now) for k in range(400, 600)]
    entries = [_entry("a", "LOADED", 1, 2, now), _entry("b", "LOADED", 5, 2, now),
               _entry("b", "LOAD_FAILED", 6, 3, now), _entry("c", "PARTIALLY_LOADED", 3, 1, now),
               _entry("f", "LOAD_IN_PROGRESS", 4, 1, now), _entry("hot2", "LOADED", 9, 1, now),
               _entry("g", "LOADED", 10, 24 * 60, now), _entry("never", "LOADED", 11, 1, now)]
    _write(os.path.join(root, "entries"), "e0.json", entries[:4])
    try:
        _write(os.path.join(root, "requests"), "q0.json", requests[:10])
        _wait(q, lambda: len(_out(spark, out)) >= 6)
        _write(os.path.join(root, "requests"), "q1.json", requests[10:])
        _write(os.path.join(root, "entries"), "e1.json", entries[4:])
        # r4, r5 and the hot key age out with nothing arriving
        _wait(q, lambda: {"r4", "r5"} <= {r["request_id"] for r in _out(spark, out)
                                          if r["route"] == "unmatched"})
        _wait(q, lambda: sum(r["file"] == "hot" for r in _out(spark, out)) == 300)
    finally:
        q.stop()
    end = dt.datetime.fromtimestamp(time.time(), dt.timezone.utc).replace(tzinfo=None)
    rows = [tuple(r[c] for c in PENDING.names) for r in requests]
    history = spark.read.schema(HISTORY).json(os.path.join(root, "entries"))
    batch = await_results(spark.createDataFrame(rows, PENDING), history, MAX_AGE, end).collect()
    streamed = [r for r in _out(spark, out) if r["request_id"] != "r0"]
    # A row with an invalid stamp fails alike, but does not look its entry up.
    odd = [next(r for r in x if r["request_id"] == "r8") for x in (streamed, batch)]
    assert len({(r["route"], r["error"], r["queued_ms"]) for r in odd}) == 1
    assert sorted(_key(r) for r in streamed if r["request_id"] != "r8") == sorted(
        _key(r) for r in batch if r["route"] != "waiting" and r["request_id"] != "r8")
    waiting = {r["request_id"] for r in waiting_rows(spark, chk).collect()}
    assert waiting == {r["request_id"] for r in batch if r["route"] == "waiting"} == {"r9", "r10", "r13", "r14"}
    by_id = {r["request_id"]: r for r in streamed}
    assert by_id["r4"]["queued_ms"] is None and by_id["r1"]["queued_ms"] == requests[0]["queued_ms"]
    assert by_id["r11"]["queued_ms"].isdigit()


def test_restart_and_result_before_request(spark, tmpdir_path):
    """State survives a restart, and an entry that came first decides a later request."""
    now = int(time.time() * 1000)
    root, out, chk = tmpdir_path, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "chk")
    asked, known = _streams(spark, root)
    _write(os.path.join(root, "entries"), "e0.json", [_entry("x", "LOADED", 1, 1, now)])
    _write(os.path.join(root, "requests"), "q0.json", [_request("r1", "y", 0, now)])
    q = start_keyed_await(asked, known, MAX_AGE, out, chk, {"availableNow": True})
    q.awaitTermination(120)
    assert [r["request_id"] for r in waiting_rows(spark, chk).collect()] == ["r1"]
    _write(os.path.join(root, "requests"), "q1.json", [_request("r2", "x", 0, now)])
    _write(os.path.join(root, "entries"), "e1.json", [_entry("y", "LOAD_FAILED", 2, 0, now)])
    q = start_keyed_await(asked, known, MAX_AGE, out, chk, {"availableNow": True})
    q.awaitTermination(120)
    assert sorted((r["request_id"], r["route"]) for r in _out(spark, out)) == [
        ("r1", "load_failure"), ("r2", "loaded")]
    assert waiting_rows(spark, chk).count() == 0
