"""Loading staged files: per-file statistics and loaded rows under both error policies."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from ingestflow.operators.history import latest_per_file
from ingestflow.operators.load import (PipeSpec, as_history, claim_run, load_files, load_once,
                                       load_through_pipes, next_run, parse_lines, rows_of_runs)

SPEC = PipeSpec(name="db.s.pipe", format="csv", schema_ddl="a INT, b STRING")


def _stage(root):
    d = os.path.join(root, "stage")
    os.makedirs(d)
    content = {
        "clean.csv": "1,x\n2,y\n\n3,z\n",
        "mixed.csv": "1,x\nbad,y\n2,y,extra\n3,z\n",
        "allbad.csv": "q,x\nr,y\n",
        "empty.csv": "",
        "z w ä.csv": "5,w\n",
        "p (1).csv": "6,p\nnope,p\n",
    }
    for n, t in content.items():
        with open(os.path.join(d, n), "w", encoding="utf-8") as f:
            f.write(t)
    with open(os.path.join(d, "zipped.csv.gz"), "wb") as f:
        f.write(gzip.compress(b"7,g\n8,h\nx,y\n"))
    return d


def _paths(spark, d):
    return spark.createDataFrame([(os.path.join(d, n),) for n in os.listdir(d)], "path string")


def test_load_files(spark, tmpdir_path):
    d = _stage(tmpdir_path)
    rows, stats = load_files(spark, SPEC, d, _paths(spark, d))
    s = {os.path.basename(r.path): (r.status, r.rows_parsed, r.rows_loaded, r.errors_seen,
                                    r.first_error) for r in stats.collect()}
    assert s["clean.csv"] == ("LOADED", 3, 3, 0, None)
    assert s["mixed.csv"] == ("PARTIALLY_LOADED", 4, 2, 2, "Invalid record: bad,y")
    assert s["allbad.csv"] == ("LOAD_FAILED", 2, 0, 2, "Invalid record: q,x")
    assert s["empty.csv"] == ("LOADED", 0, 0, 0, None)
    assert s["z w ä.csv"] == ("LOADED", 1, 1, 0, None)
    assert s["p (1).csv"] == ("PARTIALLY_LOADED", 2, 1, 1, "Invalid record: nope,p")
    assert s["zipped.csv.gz"] == ("PARTIALLY_LOADED", 3, 2, 1, "Invalid record: x,y")
    assert rows.count() == 3 + 2 + 1 + 1 + 2
    assert set(r.pipe for r in stats.collect()) == {"db.s.pipe"}


def test_skip_file_policy(spark, tmpdir_path):
    d = _stage(tmpdir_path)
    spec = PipeSpec(name="p", format="csv", schema_ddl="a INT, b STRING", on_error="SKIP_FILE")
    rows, stats = load_files(spark, spec, d, _paths(spark, d))
    s = {os.path.basename(r.path): (r.status, r.rows_loaded) for r in stats.collect()}
    assert s["mixed.csv"] == ("LOAD_FAILED", 0)
    assert s["clean.csv"] == ("LOADED", 3)
    loaded = sorted(os.path.basename(r.path) for r in rows.collect())
    assert loaded == ["clean.csv"] * 3 + ["z w ä.csv"]


def test_json_lines(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "j")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": "oops"}\n{broken\n')
    spec = PipeSpec(name="p", format="json", schema_ddl="a INT, b STRING")
    rows, stats = load_files(spark, spec, d)
    (r,) = stats.collect()
    assert (r.status, r.rows_parsed, r.errors_seen) == ("PARTIALLY_LOADED", 3, 2)
    assert rows.count() == 1


def test_parquet_stage(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "pq")
    spark.range(10).selectExpr("cast(id as int) as a", "cast(id as string) as b") \
        .repartition(2).write.parquet(d)
    spec = PipeSpec(name="p", format="parquet", schema_ddl="a INT, b STRING")
    rows, stats = load_files(spark, spec, d, path_glob="*.parquet")
    got = [(r.status, r.rows_loaded, r.errors_seen) for r in stats.collect()]
    assert len(got) == 2 and all(g[0] == "LOADED" and g[2] == 0 for g in got)
    assert sum(g[1] for g in got) == 10
    assert rows.count() == 10


def test_reload_skips_loaded_files(spark, tmpdir_path):
    d = _stage(tmpdir_path)
    rows, stats = load_files(spark, SPEC, d, _paths(spark, d))
    from pyspark.sql import functions as F
    hist = stats.select("pipe", "path", "status", F.lit(1).cast("long").alias("seq"))
    again_rows, again_stats = load_files(spark, SPEC, d, _paths(spark, d), history=hist)
    # Only the file that failed outright may be loaded again.
    assert sorted(os.path.basename(r.path) for r in again_stats.collect()) == ["allbad.csv"]
    assert again_rows.count() == 0


def _write(d, **files):
    os.makedirs(d, exist_ok=True)
    for n, t in files.items():
        with open(os.path.join(d, n.replace("_csv", ".csv")), "w") as f:
            f.write(t)


def _stats(stats):
    return {os.path.basename(r.path): (r.status, r.rows_loaded, r.first_error) for r in stats.collect()}


def test_files_that_are_not_there_fail_on_their_own_row(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv="1,x\n", blank_csv="\n \n", empty_csv="")
    names = ["a.csv", "blank.csv", "empty.csv", "gone.csv"]
    files = spark.createDataFrame([(os.path.join(d, n),) for n in names], "path string")
    rows, stats = load_files(spark, SPEC, d, files)
    assert _stats(stats) == {"a.csv": ("LOADED", 1, None), "blank.csv": ("LOADED", 0, None),
                             "empty.csv": ("LOADED", 0, None), "gone.csv": ("LOAD_FAILED", 0, "File not found")}
    assert rows.count() == 1


def test_an_unreadable_file_fails_on_its_own_row(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "pq")
    spark.range(4).selectExpr("cast(id as int) as a", "cast(id as string) as b").coalesce(1).write.parquet(d)
    with open(os.path.join(d, "broken.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    spec = PipeSpec(name="p", format="parquet", schema_ddl="a INT, b STRING")
    rows, stats = load_files(spark, spec, d, path_glob="*.parquet")
    got = sorted((r.status, r.rows_loaded, r.first_error) for r in stats.collect())
    assert got == [("LOADED", 4, None), ("LOAD_FAILED", 0, "File cannot be read")]
    assert rows.count() == 4


def test_every_spelling_of_a_path(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s t")
    _write(d, a_csv="1,x\n", b_csv="2,y\n", c_csv="3,z\n")
    _write(os.path.join(d, "x[1]"), d_csv="4,w\n")
    files = spark.createDataFrame(
        [(f"file://{d}/a.csv",), (f"file:{d}/b.csv",), (f"{d}//c.csv",), (f"{d}/x[1]/d.csv",)], "path string")
    rows, stats = load_files(spark, SPEC, f"file://{d}", files)
    assert {s[0] for s in _stats(stats).values()} == {"LOADED"} and len(_stats(stats)) == 4
    assert sorted(r.a for r in rows.collect()) == [1, 2, 3, 4]
    assert {os.path.dirname(r.path) for r in stats.collect()} == {d, f"{d}/x[1]"}


def test_header_and_records_of_several_lines(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv='a,b\n1,x\n2,"y\nz"\nq,w\n', only_csv="a,b\n")
    spec = PipeSpec(name="p", schema_ddl="a INT, b STRING", options={"header": "true", "multiLine": "true"})
    rows, stats = load_files(spark, spec, d)
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [(1, "x"), (2, "y\nz")]
    got = _stats(stats)
    assert got["a.csv"] == ("PARTIALLY_LOADED", 2, "Invalid record: q,w")
    assert got["only.csv"] == ("LOADED", 0, None)
    with pytest.raises(ValueError):
        parse_lines(spark.createDataFrame([("1,x",)], "value string"), spec)


def test_a_later_run_wins_whatever_the_clock_says(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, **{f"f{i}_csv": "bad,x\n" for i in range(8)})
    _, stats = load_files(spark, SPEC, d)
    day1 = spark.createDataFrame(as_history(stats, dt.datetime(2024, 1, 2), next_run(None)).collect(),
                                 as_history(stats, dt.datetime(2024, 1, 2)).schema)
    _write(d, **{f"f{i}_csv": "1,x\n" for i in range(8)})
    _, stats = load_files(spark, SPEC, d, history=day1)
    day2 = as_history(stats, dt.datetime(2024, 1, 1), next_run(day1))
    latest = latest_per_file(day1.unionByName(day2)).collect()
    assert len(latest) == 8 and {r.status for r in latest} == {"LOADED"} and {r.seq for r in latest} == {2}


def test_only_chosen_files_are_opened_and_no_line_is_shuffled(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv="1,x\n", b_csv="2,y\n")
    files = spark.createDataFrame([(os.path.join(d, "a.csv"),)], "path string")
    rows, _ = load_files(spark, SPEC, d, files)
    assert [os.path.basename(f) for f in rows.inputFiles()] == ["a.csv"]
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_two_pipes_in_one_load(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv="1,x\n", b_csv='{"a": 5}\n')
    req = spark.createDataFrame([("c", f"{d}/a.csv"), ("j", f"{d}/b.csv"), ("none", f"{d}/a.csv")],
                                "pipe string, path string")
    rows, stats = load_through_pipes(
        spark, [PipeSpec("c", schema_ddl="a INT, b STRING"), PipeSpec("j", "json", "a INT")], req, d)
    assert {p: [r.a for r in x.collect()] for p, x in rows.items()} == {"c": [1], "j": [5]}
    assert sorted((r.pipe, r.status) for r in stats.collect()) == [("c", "LOADED"), ("j", "LOADED")]


def _outcomes(stats):
    return {os.path.basename(r.path): (r.status, r.rows_parsed, r.rows_loaded, r.errors_seen, r.first_error)
            for r in stats.collect()}


def test_one_pass_equals_two(spark, tmpdir_path):
    d = _stage(tmpdir_path)
    with open(os.path.join(d, "blank.csv"), "w") as f:
        f.write("\n \n")
    files = _paths(spark, d).union(spark.createDataFrame([(os.path.join(d, "gone.csv"),)], "path string"))
    for policy in ("CONTINUE", "SKIP_FILE"):
        spec = PipeSpec(name="p", schema_ddl="a INT, b STRING", on_error=policy)
        (rows, stats), (rows1, stats1) = (f(spark, spec, d, files) for f in (load_files, load_once))
        assert sorted(stats1.collect(), key=str) == sorted(stats.collect(), key=str)
        assert sorted(rows1.collect(), key=str) == sorted(rows.collect(), key=str)


def test_rows_and_statistics_come_from_one_reading(spark, tmpdir_path):
    """Neither needs the source files once the load has run."""
    d = _stage(tmpdir_path)
    rows, stats = load_once(spark, SPEC, d, _paths(spark, d))
    for n in os.listdir(d):
        os.rename(os.path.join(d, n), os.path.join(tmpdir_path, f"moved {n}"))
    assert rows.count() == 3 + 2 + 1 + 1 + 2
    assert _outcomes(stats)["mixed.csv"] == ("PARTIALLY_LOADED", 4, 2, 2, "Invalid record: bad,y")


def test_one_pass_over_other_formats(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv='a,b\n1,x\n2,"y\nz"\nq,w\n', only_csv="a,b\n")
    spec = PipeSpec(name="p", schema_ddl="a INT, b STRING", options={"header": "true", "multiLine": "true"})
    rows, stats = load_once(spark, spec, d)
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [(1, "x"), (2, "y\nz")]
    assert {n: r[0] for n, r in _outcomes(stats).items()} == {"a.csv": "PARTIALLY_LOADED", "only.csv": "LOADED"}
    pq = os.path.join(tmpdir_path, "pq")
    spark.range(4).selectExpr("cast(id as int) as a", "cast(id as string) as b").coalesce(1).write.parquet(pq)
    with open(os.path.join(pq, "broken.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    rows, stats = load_once(spark, PipeSpec(name="p", format="parquet", schema_ddl="a INT, b STRING"), pq,
                            path_glob="*.parquet")
    assert sorted((r.status, r.rows_loaded, r.first_error) for r in stats.collect()) == [
        ("LOADED", 4, None), ("LOAD_FAILED", 0, "File cannot be read")]
    assert rows.count() == 4


@pytest.mark.parametrize("load", [load_files, load_once])
def test_a_stream_that_breaks_off_is_damaged(spark, tmpdir_path, load):
    """A compressed file cut in half is never ``LOADED``, and loads nothing under SKIP_FILE."""
    d = os.path.join(tmpdir_path, "s t")
    os.makedirs(d)
    whole = gzip.compress("".join(f"{i},x{i}\n" for i in range(200_000)).encode())
    for name, data in (("cut one.csv.gz", whole[:len(whole) // 2]), ("cut2.csv.gz", whole[:-6]), ("whole.csv.gz", whole),
                       ("two.csv.gz", gzip.compress(b"1,a\n") + gzip.compress(b"2,b\n")), ("plain.csv", b"5,p\n")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    rows, stats = load(spark, SPEC, d)
    got = _outcomes(stats)
    # the last record read may itself be cut
    assert got["cut one.csv.gz"][0] == "PARTIALLY_LOADED" and 0 < got["cut one.csv.gz"][2] < 200_000
    assert got["cut2.csv.gz"][0] == "PARTIALLY_LOADED"
    assert got["cut2.csv.gz"][3] >= 1 and "damaged" in got["cut2.csv.gz"][4]
    assert {n: r[:4] for n, r in got.items() if not n.startswith("cut")} == {
        "whole.csv.gz": ("LOADED", 200_000, 200_000, 0), "two.csv.gz": ("LOADED", 2, 2, 0),
        "plain.csv": ("LOADED", 1, 1, 0)}
    assert rows.count() == sum(r[2] for r in got.values())
    skip = PipeSpec(name="p", schema_ddl="a INT, b STRING", on_error="SKIP_FILE")
    rows, stats = load(spark, skip, d)
    assert {n: r[0] for n, r in _outcomes(stats).items() if n.startswith("cut")} == {
        "cut one.csv.gz": "LOAD_FAILED", "cut2.csv.gz": "LOAD_FAILED"}
    assert {os.path.basename(r.path) for r in rows.select("path").distinct().collect()} == {
        "whole.csv.gz", "two.csv.gz", "plain.csv"}


@pytest.mark.parametrize("load", [load_files, load_once])
def test_any_file_name(spark, tmpdir_path, monkeypatch, load):
    """Names that Spark's listing passes over, and paths relative to the stage."""
    d = os.path.join(tmpdir_path, "s")
    _write(d, a_csv="1,x\n", _under_csv="2,y\nbad,z\n", **{"_empty": ""})
    _write(os.path.join(d, "_dir"), in_csv="4,w\n")
    with open(os.path.join(d, ".dot.csv.gz"), "wb") as f:
        f.write(gzip.compress(b"3,z\n"))
    names = ["a.csv", "_under.csv", ".dot.csv.gz", "_dir/in.csv", "_empty", "_gone.csv"]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    rows, stats = load(spark, SPEC, d, files)
    got = _outcomes(stats)
    assert {n: r[:2] for n, r in got.items()} == {
        "a.csv": ("LOADED", 1), "_under.csv": ("PARTIALLY_LOADED", 2), ".dot.csv.gz": ("LOADED", 1),
        "in.csv": ("LOADED", 1), "_empty": ("LOADED", 0), "_gone.csv": ("LOAD_FAILED", 0)}
    assert got["_gone.csv"][4] == "File not found"
    assert sorted((r.a, r.path) for r in rows.collect()) == [
        (1, f"{d}/a.csv"), (2, f"{d}/_under.csv"), (3, f"{d}/.dot.csv.gz"), (4, f"{d}/_dir/in.csv")]


def test_runs_at_the_same_time_get_their_own_numbers(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor
    folder = os.path.join(tmpdir_path, "_runs")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: claim_run(spark, folder), range(16)))
    assert sorted(numbers) == list(range(1, 17))
    history = spark.createDataFrame([("p", "f", 40), ("p", "g", 1)], "pipe string, path string, seq long")
    assert claim_run(spark, folder, history) == 41
    for run in (1, 2):
        spark.createDataFrame([(run,)], "a int").write.parquet(os.path.join(tmpdir_path, "rows", f"run={run}"))
    assert [r.a for r in rows_of_runs(spark, os.path.join(tmpdir_path, "rows"), history).collect()] == [1]


def test_paths_without_need_of_regular_expressions_are_spelt_as_those_with(spark):
    from urllib.parse import unquote

    from ingestflow.operators.load import _plain, normalise_path
    paths = ["file:///a/b.csv", "file:/a/b.csv", "file://localhost/a/b", "file:////a//b", "file://host/a", "/a/b", "//a/b",
             "/a//b///c", "s3://k/a/b", "s3://k//a//b", "s3:///k", "file:a", "a+b", "file:///a%20b+c", "/x%2By", "", "file:",
             "file:///path=a%3Ab/part-0", "hdfs://h:9/a://b", "/a:/b", "/a://b//c", "file:///", "file://"]
    df = spark.createDataFrame([(p,) for p in [*paths, None]], "p string")
    got = {r.p: (r.plain, r.decoded) for r in df.select(
        "p", normalise_path(F.col("p")).alias("plain"), normalise_path(F.col("p"), encoded=True).alias("decoded")).collect()}
    assert got == {p: (_plain(p), _plain(unquote(p))) for p in paths} | {None: (None, None)}


def test_load_once_writes_its_records_unsorted(spark, tmpdir_path):
    """A folder for each kind of record, or a first error among all records, sorts whole tasks."""
    spark.createDataFrame([(f"{k},{k}" if k % 7 else f"{k},x",) for k in range(100)], "value string") \
        .coalesce(2).write.text(f"{tmpdir_path}/in")
    spec = PipeSpec("p", schema_ddl="a INT, b INT", on_error="CONTINUE")
    rows, stats = load_once(spark, spec, f"{tmpdir_path}/in")
    assert not [f for f in rows.inputFiles() if "_record_kind=" in f]
    assert rows.count() == 85
    got = stats.where("rows_parsed > 0").collect()
    assert sum(r.rows_parsed for r in got) == 100 and sum(r.errors_seen for r in got) == 15
    assert "Invalid record: 0,x" in {r.first_error for r in got}
