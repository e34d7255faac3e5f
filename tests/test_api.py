"""Processor-style step configurations resolve properties per event."""

import datetime as dt
import os

from ingestflow.api import QUEUED_ATTRIBUTE, AwaitResults, HistoryReport, StageFiles, SubmitLoads
from ingestflow.functions.timing import epoch_ms
from ingestflow.schemas import HISTORY

NOW = dt.datetime(2024, 4, 1, 12, 0)
MS = epoch_ms(NOW)


def test_stage_properties_from_attributes(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    for n in ("a1.csv", "a2.csv", "b.csv"):
        with open(os.path.join(src, n), "w") as f:
            f.write("1\n")
    ev = spark.createDataFrame([("e1", {"dir": src, "pat": "a*.csv"})],
                               "request_id string, attributes map<string,string>")
    step = StageFiles(input_directory="${dir}", file_name="${pat}", internal_stage="st",
                      auto_compress="false")
    (req,) = step.requests(ev).collect()
    assert (req.input_directory, req.file_name, req.parallel) == (src, "a*.csv", "4")
    out = os.path.join(tmpdir_path, "routed")
    step.run(ev, spark.createDataFrame([], "stage string, target_name string, md5 string"),
             os.path.join(tmpdir_path, "stages")).write.parquet(out)
    got = sorted((r.target_filename, r.route) for r in spark.read.parquet(out).collect())
    assert got == [("a1.csv", "uploaded"), ("a2.csv", "uploaded")]


def test_submit_and_report(spark, tmpdir_path):
    ev = spark.createDataFrame([({"filename": "x.csv", "p": "db.s.p"},)],
                               "attributes map<string,string>")
    (r,) = SubmitLoads(pipe="${p}").requests(ev).collect()
    assert (r.pipe, r.file) == ("db.s.p", "x.csv")
    h = spark.createDataFrame([("p", "a", "LOADED", 1, 1, None, None,
                                NOW - dt.timedelta(minutes=5), 1)], HISTORY)
    assert HistoryReport("p", -10).run(h, NOW).count() == 1
    assert not HistoryReport("p", 2).write(h, NOW, os.path.join(tmpdir_path, "r"))


def test_await_keeps_stamp_in_attributes(spark):
    ev = spark.createDataFrame(
        [("e1", {"pipe": "p", "filename": "a"}, MS, 1),
         ("e2", {"pipe": "p", "filename": "b", QUEUED_ATTRIBUTE: str(MS - 90 * 60000)}, MS, 2)],
        "request_id string, attributes map<string,string>, lineage_ms long, arrival_seq long")
    h = spark.createDataFrame([], HISTORY)
    out = {r.request_id: r for r in AwaitResults(max_file_age_minutes=60).run(ev, h, NOW).collect()}
    assert out["e1"].route == "waiting"
    assert out["e1"].attributes[QUEUED_ATTRIBUTE] == str(MS)      # stamped now
    assert out["e2"].route == "unmatched"
    assert QUEUED_ATTRIBUTE not in out["e2"].attributes          # cleared to wait again later
