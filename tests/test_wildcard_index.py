"""The pattern index finds the pairs that trying every pattern on every name finds."""

import functools
import random
import re

from pyspark.sql import functions as F

from ingestflow.functions.glob import glob_regex
from ingestflow.operators.staging import expand_wildcards, wildcard_candidates


@functools.cache
def _regex(pattern):
    return re.compile("".join("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c) for c in pattern))


def _matches(pattern, name):
    return _regex(pattern).fullmatch(name) is not None


def test_random_patterns_against_all_pairs(spark):
    rng = random.Random(3)
    letters = "ab.ä😀-"
    names = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(150)})
    patterns = sorted({"".join(rng.choice(letters + "**??") for _ in range(rng.randint(1, 6))) for _ in range(200)}
                      | {"*", "?", "**", "a*", "*a", "*ab*", "?a?", "*a.ä*b*", "", "a"})
    files = spark.createDataFrame([(d, n) for d in ("x", "y") for n in names], "dir string, name string")
    req = spark.createDataFrame([(str(i), "xyz"[i % 3], p) for i, p in enumerate(patterns)],
                                "request_id string, dir string, pattern string")
    for kw in ({}, {"salt_buckets": 3, "min_hot_rows": 0, "max_hot_keys": 10}):
        got = sorted((r.request_id, r.name or "") for r in expand_wildcards(
            req, files, dir_col="dir", pattern_col="pattern", **kw).collect())
        expected = []
        for i, p in enumerate(patterns):
            hits = [n for n in names if "xyz"[i % 3] != "z" and _matches(p, n)]
            expected += [(str(i), n) for n in hits] or [(str(i), "")]
        assert got == sorted(expected)


def test_candidates_grow_with_matches(spark):
    """1,000 patterns and 2,000 names of one directory: few pairs are compared, and each once."""
    files = spark.range(2000).select(F.lit("d").alias("__dir"), F.lit(0).cast("long").alias("__salt"),
                                     F.format_string("part-%05d-x.csv", F.col("id")).alias("name"))
    wild = spark.range(250).select(F.explode(F.array(
        F.format_string("part-%05d*", F.col("id")), F.format_string("part-%04d?-*", F.col("id")),
        F.format_string("*%05d-x.csv", F.col("id")), F.format_string("*t-%04d1*", F.col("id")))).alias("__pat")) \
        .select(F.lit("d").alias("__dir"), F.lit(0).cast("long").alias("__salt"), "__pat")
    pairs = wildcard_candidates(wild, files)
    rows = pairs.select("__pat", "name", F.regexp(F.col("name"), glob_regex("__pat")).alias("hit")).collect()
    assert len({r[:2] for r in rows}) == len(rows)
    all_pats = {r[0] for r in wild.select("__pat").collect()}
    all_names = [r[0] for r in files.select("name").collect()]
    assert {r[:2] for r in rows if r.hit} == {(p, n) for p in all_pats for n in all_names if _matches(p, n)}
    # Patterns with a literal start or end are compared with what they match, and little more.
    sure = [r.hit for r in rows if not r[0].startswith("*t-")]
    assert len(sure) <= 1.1 * sum(sure)
