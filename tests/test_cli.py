"""The command line runs a step over files."""

import datetime as dt
import json
import os

from ingestflow.__main__ import main


def test_cli_load_then_await_then_report(spark, tmpdir_path):
    stage = os.path.join(tmpdir_path, "stage")
    os.makedirs(stage)
    with open(os.path.join(stage, "a.csv"), "w") as f:
        f.write("1,x\nbad,y\n")
    with open(os.path.join(stage, "b.csv"), "w") as f:
        f.write("2,z\n")
    hist = os.path.join(tmpdir_path, "history")
    now = "2024-07-01T10:00:00"
    assert main(["load", "--stage-dir", stage, "--pipe", "db.s.p", "--schema", "k INT, v STRING",
                 "--rows", os.path.join(tmpdir_path, "rows"), "--history", hist, "--now", now],
                spark) == 0
    h = spark.read.parquet(hist)
    assert sorted((os.path.basename(r.path), r.status) for r in h.collect()) == [
        ("a.csv", "PARTIALLY_LOADED"), ("b.csv", "LOADED")]
    # A re-run loads nothing twice: both files are already loaded by this pipe.
    assert main(["load", "--stage-dir", stage, "--pipe", "db.s.p", "--schema", "k INT, v STRING",
                 "--rows", os.path.join(tmpdir_path, "rows"), "--history", hist, "--now", now],
                spark) == 0
    assert spark.read.parquet(hist).count() == 2
    assert spark.read.parquet(os.path.join(tmpdir_path, "rows")).count() == 2

    # Pending requests name the files as the history does (full path here).
    pend = os.path.join(tmpdir_path, "pending.json")
    ms = int(dt.datetime(2024, 7, 1, 9, 59, tzinfo=dt.timezone.utc).timestamp() * 1000)
    with open(pend, "w") as f:
        for i, r in enumerate(h.collect()):
            f.write(json.dumps({"request_id": f"r{i}", "pipe": "db.s.p", "file": r.path,
                                "attributes": {}, "queued_ms": str(ms), "lineage_ms": ms,
                                "arrival_seq": i}) + "\n")
    out = os.path.join(tmpdir_path, "routes")
    assert main(["await", "--pending", pend, "--history", hist, "--max-age-minutes", "60",
                 "--out", out, "--now", now], spark) == 0
    routes = sorted(d for d in os.listdir(out) if d.startswith("route="))
    assert routes == ["route=loaded", "route=partially_loaded"]

    rep = os.path.join(tmpdir_path, "report")
    assert main(["report", "--history", hist, "--pipe", "db.s.p", "--trailing-minutes", "5",
                 "--out", rep, "--now", now], spark) == 0
    assert os.path.isdir(rep)


def test_cli_stage(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    for n in ("x1.csv", "x2.csv", "y.txt"):
        with open(os.path.join(src, n), "w") as f:
            f.write("1\n")
    req = os.path.join(tmpdir_path, "requests.json")
    with open(req, "w") as f:
        f.write(json.dumps({"request_id": "q1", "input_directory": src, "file_name": "x*.csv",
                            "internal_stage": "st", "auto_compress": "false",
                            "source_compression": "default", "parallel": "2"}) + "\n")
    man = os.path.join(tmpdir_path, "manifest")
    spark.createDataFrame([], "stage string, target_name string, md5 string").write.parquet(man)
    out = os.path.join(tmpdir_path, "staged")
    assert main(["stage", "--requests", req, "--manifest", man, "--stage-root",
                 os.path.join(tmpdir_path, "stages"), "--out", out], spark) == 0
    got = sorted(r.target_filename for r in spark.read.parquet(out).collect())
    assert got == ["x1.csv", "x2.csv"]
    assert sorted(os.listdir(os.path.join(tmpdir_path, "stages", "st"))) == ["x1.csv", "x2.csv"]
