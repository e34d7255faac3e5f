"""Listing, digests, wildcard expansion over real files, staging copies."""

import gzip
import hashlib
import os

from pyspark.sql import functions as F

from ingestflow.operators.staging import expand_wildcards, plan_staging, route_stage
from ingestflow.plans.flow import manifest_additions, stage_step
from ingestflow.sources.files import file_digest, list_files


def _make_src(root):
    src = os.path.join(root, "src")
    os.makedirs(os.path.join(src, "sub"))
    files = {"a1.csv": b"1,2,3\n", "a2.csv": b"4,5,6\n", "b.csv": b"", "z w ä.csv": b"x\n", "p (1).csv": b"y\n", "c.gz": gzip.compress(b"q\n")}
    for n, data in files.items():
        with open(os.path.join(src, n), "wb") as f:
            f.write(data)
    with open(os.path.join(src, "sub", "a3.csv"), "wb") as f:
        f.write(b"nested\n")
    return src, files


def test_list_files(spark, tmpdir_path):
    src, files = _make_src(tmpdir_path)
    dirs = spark.createDataFrame([(src,), (src,), (os.path.join(tmpdir_path, "missing"),)],
                                 "dir string")
    listing = list_files(dirs)
    got = {r.name: r.size for r in listing.collect()}
    assert got == {n: len(d) for n, d in files.items()}          # zero-length kept, no subdir
    dig = {r.name: (r.md5, bytes(r.header)) for r in file_digest(listing).collect()}
    for n, d in files.items():
        assert dig[n][0] == hashlib.md5(d).hexdigest()
        assert dig[n][1] == d[:16]


def test_wildcards_on_listing(spark, tmpdir_path):
    src, _ = _make_src(tmpdir_path)
    req = spark.createDataFrame([("r1", src, "a*.csv"), ("r2", src, "p (1).csv"),
                                 ("r3", src, "z w ?.csv"), ("r4", src, "none*"),
                                 ("r5", src, "b.csv")],
                                "request_id string, input_directory string, file_name string")
    listing = list_files(req.select(F.col("input_directory").alias("dir")))
    out = sorted((r.request_id, r.name) for r in expand_wildcards(req, listing, salt_buckets=3)
                 .collect())
    assert out == [("r1", "a1.csv"), ("r1", "a2.csv"), ("r2", "p (1).csv"),
                   ("r3", "z w ä.csv"), ("r4", None), ("r5", "b.csv")]


def test_plan_staging_ignores_duplicate_manifest_rows(spark):
    files = spark.createDataFrame([("s", "a", "m1"), ("s", "b", "m2"), ("s", "c", "m3")],
                                  "stage string, target_name string, md5 string")
    man = spark.createDataFrame([("s", "a", "m1"), ("s", "a", "m1"), ("s", "b", "zz")],
                                "stage string, target_name string, md5 string")
    out = sorted((r.target_name, r.status) for r in plan_staging(files, man).collect())
    assert out == [("a", "SKIPPED"), ("b", "UPLOADED"), ("c", "UPLOADED")]


def test_route_stage_no_results_text(spark):
    req = spark.createDataFrame(
        [("1", "/d", "f*", "db.s.st", "true", "default", 4), ("2", "/d", "g", "st", "default",
                                                              "GZIP", 10)],
        "request_id string, input_directory string, file_name string, internal_stage string, "
        "auto_compress string, source_compression string, parallel int")
    res = spark.createDataFrame([("1", "/d/f1", "f1.gz", 1, 1, "NONE", "GZIP", "UPLOADED", "E",
                                  "")],
                                "request_id string, source_filename string, target_filename "
                                "string, source_size long, target_size long, source_compression "
                                "string, target_compression string, status string, encryption "
                                "string, message string")
    out = {r.request_id: (r.route, r.error) for r in route_stage(req, res).collect()}
    assert out["1"] == ("uploaded", None)
    assert out["2"] == ("failure", "No results received from PUT statement: "
                        "PUT file:///d/g @st SOURCE_COMPRESSION = GZIP PARALLEL = 10")


def test_stage_files(spark, tmpdir_path):
    src, files = _make_src(tmpdir_path)
    stage_root = os.path.join(tmpdir_path, "stages")
    raw = spark.createDataFrame(
        [("r1", src, "a*.csv", "st", "true", "AUTO_DETECT", "4"),
         ("r2", src, "c.gz", "st", "default", "default", "2"),
         ("r3", src, "nothing*", "st", "default", "default", "4"),
         ("r4", "", "x", "st", "maybe", "default", "x")],
        "request_id string, input_directory string, file_name string, internal_stage string, "
        "auto_compress string, source_compression string, parallel string")
    man = spark.createDataFrame([("st", "a2.csv.gz", hashlib.md5(b"4,5,6\n").hexdigest())],
                                "stage string, target_name string, md5 string")
    routed_path = os.path.join(tmpdir_path, "routed")
    stage_step(raw, man, stage_root, parallel=2).write.parquet(routed_path)
    routed = spark.read.parquet(routed_path)
    new_man = manifest_additions(routed)
    out = sorted((r.request_id, r.target_filename, r.route, r.target_compression)
                 for r in routed.collect())
    assert out == [("r1", "a1.csv.gz", "uploaded", "GZIP"), ("r1", "a2.csv.gz", "skipped", "GZIP"),
                   ("r2", "c.gz", "uploaded", "GZIP"), ("r3", None, "failure", None),
                   ("r4", None, "failure", None)]
    with gzip.open(os.path.join(stage_root, "st", "a1.csv.gz")) as f:
        assert f.read() == b"1,2,3\n"
    with open(os.path.join(stage_root, "st", "c.gz"), "rb") as f:
        assert f.read() == files["c.gz"]        # already compressed: copied as is
    assert not [n for n in os.listdir(os.path.join(stage_root, "st")) if n.endswith(".tmp")]
    assert sorted((r.target_name, r.md5) for r in new_man.collect()) == [
        ("a1.csv.gz", hashlib.md5(b"1,2,3\n").hexdigest()),
        ("c.gz", hashlib.md5(files["c.gz"]).hexdigest())]


def test_validate_requests_rules(spark):
    from ingestflow.operators.staging import validate_requests
    rows = [("ok", "/d", "f", "s", "true", "GZIP", "10"),
            ("blank", " ", "f", "s", None, None, None),
            ("empty", "", "", "", "default", "default", "4"),
            ("values", "/d", "f", "s", "yes", "LZO", " 5"),
            ("decimal", "/d", "f", "s", "default", "default", "5.0"),
            ("big", "/d", "f", "s", "default", "default", "99999999999"),
            ("signed", "/d", "f", "s", "default", "default", "+7")]
    df = spark.createDataFrame(rows, "request_id string, input_directory string, file_name "
                               "string, internal_stage string, auto_compress string, "
                               "source_compression string, parallel string")
    out = {r.request_id: (r.invalid_reason, r.parallel, r.auto_compress)
           for r in validate_requests(df).collect()}
    assert out["ok"] == (None, 10, "true")
    assert out["blank"] == (None, 4, "default")            # non-empty, not non-blank
    assert out["empty"][0] == ("input_directory is empty; file_name is empty; "
                               "internal_stage is empty")
    assert out["values"][0] == ("auto_compress is not an allowed value; source_compression is "
                                "not an allowed value; parallel is not an integer")
    assert out["decimal"][0] == "parallel is not an integer"
    assert out["big"][0] == "parallel is not an integer"
    assert out["signed"] == (None, 7, "default")


RAW = ("request_id string, input_directory string, file_name string, internal_stage string, "
       "auto_compress string, source_compression string, parallel string")


def test_each_file_is_copied_once(spark, tmpdir_path, monkeypatch):
    """However many requests name a file, and however often the routes are read."""
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    for n in ("a.csv", "b.csv"):
        with open(os.path.join(src, n), "w") as f:
            f.write("1\n")
    raw = spark.createDataFrame([("r1", src, "*.csv", "st", "false", "default", "2"),
                                 ("r2", src, "a.csv", "st", "false", "default", "1")], RAW)
    man = spark.createDataFrame([], "stage string, target_name string, md5 string")
    root = os.path.join(tmpdir_path, "stages")
    routed = stage_step(raw, man, root)
    stamp = {n: os.stat(os.path.join(root, "st", n)).st_mtime_ns for n in ("a.csv", "b.csv")}
    assert routed.count() == 3 and routed.where("route = 'uploaded'").count() == 3
    got = routed.collect()
    assert stamp == {n: os.stat(os.path.join(root, "st", n)).st_mtime_ns for n in stamp}
    assert {(r.request_id, r.target_filename) for r in got} == {("r1", "a.csv"), ("r1", "b.csv"),
                                                              ("r2", "a.csv")}
    assert len({(r.target_filename, r.start_ms, r.end_ms) for r in got}) == 2     # one copy per file
    assert all(r.url == f"{root}/st" and r.duration_s == r.transmission_ms // 1000 for r in got)


def test_two_sources_of_one_target_name(spark, tmpdir_path):
    for d in ("x", "y"):
        os.makedirs(os.path.join(tmpdir_path, d))
        with open(os.path.join(tmpdir_path, d, "same.csv"), "w") as f:
            f.write(d)
    raw = spark.createDataFrame([(d, os.path.join(tmpdir_path, d), "same.csv", "st", "false", "default", "2")
                                 for d in ("x", "y")], RAW)
    man = spark.createDataFrame([], "stage string, target_name string, md5 string")
    root = os.path.join(tmpdir_path, "stages")
    got = {r.request_id: (r.route, r.message) for r in stage_step(raw, man, root).collect()}
    assert got["x"] == ("uploaded", "")
    assert got["y"] == ("failure", f"target name is taken by {tmpdir_path}/x/same.csv")
    with open(os.path.join(root, "st", "same.csv")) as f:
        assert f.read() == "x"


def test_wildcards_with_missing_and_equal_request_ids(spark):
    req = spark.createDataFrame([(None, "/d", "a*"), ("1", "/d", "a*"), ("1", "/d", "none*"), ("2", "/d", "b.csv"),
                                 ("3", None, "a*")], "request_id string, input_directory string, file_name string")
    files = spark.createDataFrame([("/d", "a1"), ("/d", "b.csv"), ("/e", "a2")], "dir string, name string")
    out = expand_wildcards(req, files)
    got = sorted(((r.request_id, r.file_name, r.name) for r in out.collect()), key=str)
    assert got == sorted([(None, "a*", "a1"), ("1", "a*", "a1"), ("1", "none*", None), ("2", "b.csv", "b.csv"),
                          ("3", "a*", None)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1


def test_text_that_starts_like_zlib_data(spark):
    from ingestflow.functions.compression import sniff_compression
    df = spark.createDataFrame([(bytearray(b"x^2 + y^2"),), (bytearray(b"x\x9cKL"),), (bytearray(b"x^KL\x04"),)],
                               "h binary")
    assert [r.c for r in df.select(sniff_compression("h").alias("c")).collect()] == ["NONE", "DEFLATE", "DEFLATE"]
