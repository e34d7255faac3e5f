"""Whole pipeline over temp folders: stage → submit → load → await."""

import datetime as dt
import os

from ingestflow.operators.load import PipeSpec
from ingestflow.plans.flow import run_flow


def test_end_to_end(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    data = {"good.csv": "1,a\n2,b\n", "mixed.csv": "3,c\nx,d\n", "bad.csv": "y,e\n",
            "skip.txt": "ignored\n"}
    for n, t in data.items():
        with open(os.path.join(src, n), "w") as f:
            f.write(t)
    raw = spark.createDataFrame(
        [("r1", src, "*.csv", "st", "false", "default", "4"),
         ("r2", src, "missing.csv", "st", "default", "default", "4")],
        "request_id string, input_directory string, file_name string, internal_stage string, "
        "auto_compress string, source_compression string, parallel string")
    manifest = spark.createDataFrame([], "stage string, target_name string, md5 string")
    spec = PipeSpec(name="db.s.pipe", format="csv", schema_ddl="k INT, v STRING")
    now = dt.datetime(2024, 5, 1, 8, 0)
    out = run_flow(spark, raw, manifest, os.path.join(tmpdir_path, "stages"), [spec], now,
                   max_age_minutes=60, work_dir=os.path.join(tmpdir_path, "work"))
    stage = sorted((r.request_id, r.target_filename, r.route)
                   for r in out["stage_routes"].collect())
    assert stage == [("r1", "bad.csv", "uploaded"), ("r1", "good.csv", "uploaded"),
                     ("r1", "mixed.csv", "uploaded"), ("r2", None, "failure")]
    assert sorted(r.route for r in out["submit_routes"].collect()) == ["success"] * 3
    routes = {r.file: (r.route, r.error_count) for r in out["await_routes"].collect()}
    assert routes == {"st/good.csv": ("loaded", None), "st/mixed.csv": ("partially_loaded", "1"),
                      "st/bad.csv": ("load_failure", "1")}
    assert out["target_rows"]["db.s.pipe"].count() == 3
    assert all(r.transmission_ms >= 0 and r.target_url.endswith("/st") for r in out["audit"].collect())
    assert sorted(r.target_name for r in out["manifest_additions"].collect()) == [
        "bad.csv", "good.csv", "mixed.csv"]

    # Second run over the same folders with the updated manifest: one new file only.
    with open(os.path.join(src, "new.csv"), "w") as f:
        f.write("9,z\n")
    man2 = out["manifest_additions"]
    out2 = run_flow(spark, raw, man2, os.path.join(tmpdir_path, "stages"), [spec],
                    now + dt.timedelta(minutes=5), max_age_minutes=60, history=out["history"],
                    work_dir=os.path.join(tmpdir_path, "work2"))
    stage2 = sorted((r.target_filename, r.route) for r in out2["stage_routes"].collect()
                    if r.request_id == "r1")
    assert stage2 == [("bad.csv", "skipped"), ("good.csv", "skipped"),
                      ("mixed.csv", "skipped"), ("new.csv", "uploaded")]
    assert {r.file: r.route for r in out2["await_routes"].collect()} == {"st/new.csv": "loaded"}
    assert out2["target_rows"]["db.s.pipe"].count() == 1
    assert [r.seq for r in out2["history"].collect()] == [2]


def test_stages_and_pipes_of_events(spark, tmpdir_path):
    """Each event names its stage and pipe; files of every stage are followed."""
    from ingestflow.api import StageFiles
    for d, text in (("csv", "1,a\nx,b\n"), ("json", '{"k": 1}\n'), ("odd", "1\n")):
        os.makedirs(os.path.join(tmpdir_path, d))
        with open(os.path.join(tmpdir_path, d, f"f.{d}"), "w") as f:
            f.write(text)
    ev = spark.createDataFrame(
        [(d, {"dir": os.path.join(tmpdir_path, d), "pipe": f"p_{d}", "tag": d.upper()})
         for d in ("csv", "json", "odd")], "request_id string, attributes map<string,string>")
    raw = StageFiles("${dir}", "*", "st_${tag}", auto_compress="false").requests(ev)
    manifest = spark.createDataFrame([], "stage string, target_name string, md5 string")
    specs = [PipeSpec(name="p_csv", format="csv", schema_ddl="k INT, v STRING"),
             PipeSpec(name="p_json", format="json", schema_ddl="k INT")]
    out = run_flow(spark, raw, manifest, os.path.join(tmpdir_path, "stages"), specs,
                   dt.datetime(2024, 5, 1), max_age_minutes=60, work_dir=os.path.join(tmpdir_path, "work"))
    assert {r.request_id: r.attributes["tag"] for r in out["stage_routes"].collect()} == {
        "csv": "CSV", "json": "JSON", "odd": "ODD"}
    assert {r.request_id: (r.route, r.error_message) for r in out["submit_routes"].collect()} == {
        "csv": ("success", None), "json": ("success", None),
        "odd": ("failure", "pipe is not defined: p_odd")}
    assert {r.file: (r.pipe, r.route) for r in out["await_routes"].collect()} == {
        "st_CSV/f.csv": ("p_csv", "partially_loaded"), "st_JSON/f.json": ("p_json", "loaded")}
    assert {p: d.count() for p, d in out["target_rows"].items()} == {"p_csv": 1, "p_json": 1}
