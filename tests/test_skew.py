"""Balanced lookup and semi joins: same rows whether a key is hot or not."""

from pyspark.sql import functions as F

from ingestflow.operators.skew import lookup_join, semi_join
from ingestflow.operators.staging import expand_wildcards


def _rows(spark, n=3000):
    # key "hot" holds a third of the rows, some keys are null, the rest spread out.
    df = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") % 50 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"))
    return df


def test_lookup_join_hot_path_equals_plain(spark):
    rows = _rows(spark)
    per_key = rows.where(F.col("k").isNotNull()).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    plain = lookup_join(rows, per_key, ["k"], "n")                       # nothing hot
    forced = lookup_join(rows, per_key, ["k"], "n", min_hot_rows=0, max_hot_keys=10)
    a = sorted(tuple(r) for r in plain.collect())
    b = sorted(tuple(r) for r in forced.collect())
    assert a == b and len(a) == 3000
    assert all(r[3] is None for r in a if r[1] is None)                  # null keys never match
    hot_first = {r[3] for r in a if r[1] == "hot"}
    assert hot_first == {0}


def test_hot_keys_are_bounded(spark):
    rows = _rows(spark)
    per_key = rows.where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = per_key.agg(F.sum("n")).first()[0]
    hot = per_key.where(F.col("n") > max(0, total / 10)).count()
    assert hot < 10


def test_hot_rows_spread_over_partitions(spark):
    rows = _rows(spark, 30000)
    per_key = rows.where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = lookup_join(rows, per_key, ["k"], "n", min_hot_rows=0, max_hot_keys=10)
    sizes = out.where(F.col("k") == "hot").groupBy(F.spark_partition_id()).count().collect()
    # Without the salt every "hot" row would sit in one partition.
    assert len(sizes) > 1


def test_hot_rows_spread_in_the_shuffled_join(spark):
    """The salt is a key of the shuffled join: a constant one would be folded into a condition."""
    rows = _rows(spark, 30000)
    per_key = rows.where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        out = lookup_join(rows, per_key, ["k"], "n", min_hot_rows=0, max_hot_keys=10)
        # The joined column is asked for: a left join that adds nothing would be left out.
        sizes = [r.rows for r in out.groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("rows"), F.max("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 30000 and max(sizes) < 30000 / 4


def test_semi_and_anti_join(spark):
    rows = _rows(spark)
    keys = spark.createDataFrame([("hot",), ("k5",), ("absent",)], "k string")
    semi = semi_join(rows, keys, ["k"], min_hot_rows=0, max_hot_keys=10)
    anti = semi_join(rows, keys, ["k"], anti=True, min_hot_rows=0, max_hot_keys=10)
    want_semi = rows.join(keys, "k", "left_semi")
    want_anti = rows.join(keys, "k", "left_anti")
    assert sorted(r.id for r in semi.collect()) == sorted(r.id for r in want_semi.collect())
    assert sorted(r.id for r in anti.collect()) == sorted(r.id for r in want_anti.collect())


def test_wildcard_join_hot_directory(spark):
    files = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("/big")).otherwise(
            F.concat(F.lit("/d"), (F.col("id") % 10).cast("string"))).alias("dir"),
        F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".csv")).alias("name"))
    req = spark.createDataFrame([("a", "/big", "f1*.csv"), ("b", "/big", "f?.csv"),
                                 ("c", "/d1", "*.csv"), ("d", "/big", "f3.csv"),
                                 ("e", "/none", "*")],
                                "request_id string, dir string, pattern string")
    got = expand_wildcards(req, files, dir_col="dir", pattern_col="pattern", min_hot_rows=0,
                           max_hot_keys=5, salt_buckets=8)
    counts = {r.request_id: r.n for r in got.groupBy("request_id").agg(
        F.count("name").alias("n")).collect()}
    import fnmatch
    want = {}
    fl = [(r.dir, r.name) for r in files.collect()]
    for rid, d, p in [("a", "/big", "f1*.csv"), ("b", "/big", "f?.csv"), ("c", "/d1", "*.csv"),
                      ("d", "/big", "f3.csv"), ("e", "/none", "*")]:
        want[rid] = sum(1 for fd, fn in fl if fd == d and fnmatch.fnmatchcase(fn, p))
    assert counts == want


def test_lookup_join_with_map_column(spark):
    rows = _rows(spark, 600).withColumn("attrs", F.create_map(F.lit("k"), F.col("k")))
    per_key = rows.where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = lookup_join(rows, per_key, ["k"], "n", min_hot_rows=0, max_hot_keys=10)
    assert out.count() == 600
