"""Stage requests: validation, wildcard expansion, skip check and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.functions.command import stage_command
from ingestflow.functions.glob import glob_regex, has_wildcard, name_anchors, pattern_anchor
from ingestflow.operators.skew import (DEFAULT_MAX_HOT_KEYS, DEFAULT_MIN_HOT_ROWS, hot_threshold,
                                       lookup_join)
from ingestflow.schemas import AUTO_COMPRESS_VALUES, PARALLEL_DEFAULT, SOURCE_COMPRESSION_VALUES

# Error text for a request whose copy returned no result rows.
NO_RESULTS_TEXT = "No results received from PUT statement: "
DEFAULT_SALT_BUCKETS = 64


def _non_empty(c):
    return c.isNotNull() & (F.length(c) > 0)


def validate_requests(raw: DataFrame) -> DataFrame:
    """Add ``invalid_reason`` (null when valid) and an integer ``parallel``.

    Directory, file name and stage must be non-empty; auto-compress and
    source-compression must be allowed values (null means the default);
    parallel must be an integer (null means 4).  Every failed rule is listed.
    """
    par = F.col("parallel")
    # An integer as Integer.parseInt reads it: optional sign, digits, in range
    # (a cast alone would also accept surrounding blanks).
    par_int = F.when(par.rlike(r"^[+-]?[0-9]+$"), par.try_cast("int"))
    reasons = [
        F.when(~_non_empty(F.col("input_directory")), F.lit("input_directory is empty")),
        F.when(~_non_empty(F.col("file_name")), F.lit("file_name is empty")),
        F.when(~_non_empty(F.col("internal_stage")), F.lit("internal_stage is empty")),
        F.when(F.col("auto_compress").isNotNull()
               & ~F.col("auto_compress").isin(*AUTO_COMPRESS_VALUES),
               F.lit("auto_compress is not an allowed value")),
        F.when(F.col("source_compression").isNotNull()
               & ~F.col("source_compression").isin(*SOURCE_COMPRESSION_VALUES),
               F.lit("source_compression is not an allowed value")),
        F.when(par.isNotNull() & par_int.isNull(), F.lit("parallel is not an integer")),
    ]
    reason = F.concat_ws("; ", *reasons)
    return (raw.withColumn("invalid_reason", F.when(reason != "", reason))
               .withColumn("auto_compress", F.coalesce("auto_compress", F.lit("default")))
               .withColumn("source_compression",
                           F.coalesce("source_compression", F.lit("default")))
               .withColumn("parallel", F.coalesce(par_int, F.lit(PARALLEL_DEFAULT))))


def with_stage_command(requests: DataFrame) -> DataFrame:
    return requests.withColumn("stage_command", stage_command())


def expand_wildcards(requests: DataFrame, files: DataFrame, dir_col: str = "input_directory",
                     pattern_col: str = "file_name",
                     salt_buckets: int = DEFAULT_SALT_BUCKETS,
                     min_hot_rows: int = DEFAULT_MIN_HOT_ROWS,
                     max_hot_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """Left-join each request to the files its pattern matches in its directory.

    A request row yields one row per matching file (the request's columns are
    repeated on each), or one row with null file columns when nothing
    matches; equal or missing request ids do not matter.

    Each distinct (directory, pattern) is matched once, however many requests
    ask for it, and one left join attaches the matches to the requests (Spark
    splits the partition of a pair that many requests share).  Plain names are
    an equi-join on (directory, name).  Patterns with ``*``/``?`` are found by an
    index of their literals (``wildcard_candidates``), and the regular
    expression runs on the candidates alone.  A directory holding more than
    ``max(min_hot_rows, files / max_hot_keys)`` files is *hot* (fewer than
    ``max_hot_keys`` can be, so their list is broadcast): its files are spread
    over ``salt_buckets`` sub-groups and its patterns are repeated once per
    sub-group, so it is matched by many tasks, never one.
    """
    req = requests.withColumns({"__dir": F.col(dir_col), "__pat": F.col(pattern_col)})
    f = files.withColumnRenamed("dir", "__dir")
    fcols = [c for c in f.columns if c != "__dir"]
    pairs = req.where(F.col("__dir").isNotNull() & F.col("__pat").isNotNull()) \
        .select("__dir", "__pat").distinct()
    exact = pairs.where(~has_wildcard("__pat")).join(
        f.withColumn("__pat", F.col("name")), ["__dir", "__pat"])

    counts = f.groupBy("__dir").agg(F.count(F.lit(1)).alias("__n"))
    threshold = hot_threshold(counts, "__n", min_hot_rows, max_hot_keys)
    # Size bound: fewer than max_hot_keys directories (see operators.skew).
    hot = F.broadcast(counts.where(F.col("__n") > threshold)
                      .select("__dir", F.lit(True).alias("__hot")))
    zero = F.lit(0).cast("long")
    salted = f.join(hot, "__dir", "left").withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64("name"), F.lit(salt_buckets)))
        .otherwise(zero)).drop("__hot")
    wild = pairs.where(has_wildcard("__pat")).join(hot, "__dir", "left").withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), F.sequence(zero, F.lit(salt_buckets - 1).cast("long")))
                            .otherwise(F.array(zero)))).drop("__hot")
    matched = wildcard_candidates(wild, salted).where(F.regexp(F.col("name"), glob_regex("__pat")))
    matches = exact.select("__dir", "__pat", *fcols).unionByName(
        matched.select("__dir", "__pat", *fcols))
    return req.join(matches, ["__dir", "__pat"], "left").select(*requests.columns, *fcols)


def wildcard_candidates(wild: DataFrame, files: DataFrame) -> DataFrame:
    """(pattern, file) pairs of one ``__dir`` and ``__salt`` whose name has the pattern's anchor.

    A pattern is known by one literal of its own: its start, its end, or a
    piece of its inside (``pattern_anchor``).  A file is listed under its
    name's parts of the shapes that patterns of its directory have, so an
    equi-join finds the candidates: pairs grow with what patterns and names
    share, not with patterns times files.  A pair is found once.
    """
    key = ["__dir", "__salt"]
    keyed = wild.select(*key, "__pat", pattern_anchor("__pat").alias("__anchor"))
    # At most three kinds times the longest name's length for each directory.
    shapes = keyed.groupBy(*key).agg(F.collect_set(F.struct(
        F.col("__anchor.kind").alias("kind"), F.col("__anchor.len").alias("len"))).alias("__shapes"))
    listed = files.join(shapes, key).withColumn(
        "__anchor", F.explode(name_anchors("name", F.col("__shapes")))).drop("__shapes")
    return keyed.join(listed, [*key, "__anchor"]).drop("__anchor")


def plan_staging(files: DataFrame, manifest: DataFrame, stage: str = "stage",
                 target: str = "target_name", md5: str = "md5") -> DataFrame:
    """Mark each file ``SKIPPED`` when its stage already holds the same name and MD5.

    The manifest is reduced to distinct (stage, name, md5) keys first, so a
    manifest listing a file twice cannot duplicate it.  Everything else is
    ``UPLOADED`` (to be copied).
    """
    keys = [stage, target, md5]
    marks = (manifest.select(F.col("stage").alias(stage), F.col("target_name").alias(target),
                             F.col("md5").alias(md5))
             .distinct().withColumn("__hit", F.lit(True)))
    out = files.join(marks, on=keys, how="left")
    return (out.withColumn("status", F.when(F.col("__hit"), "SKIPPED").otherwise("UPLOADED"))
               .drop("__hit").select(*files.columns, "status"))


def route_stage(requests: DataFrame, results: DataFrame, **skew_kw) -> DataFrame:
    """One output row per stage result, plus one per request that got none.

    Results inherit their request's columns (through a balanced lookup join,
    so a request expanding to millions of files is spread over many tasks);
    ``UPLOADED`` → ``uploaded``, ``SKIPPED`` → ``skipped``, anything else →
    ``failure``.  A request without results → ``failure`` with the text of its
    stage command in ``error``.
    """
    req = with_stage_command(requests)
    clash = [c for c in req.columns if c != "request_id" and c in results.columns]
    for c in clash:
        req = req.withColumnRenamed(c, f"request_{c}")
    rcols = [c for c in req.columns if c != "request_id"]
    counts = results.groupBy("request_id").agg(F.count(F.lit(1)).alias("__n"))
    # Ids of results without a request count too: such a key may be the hot one.
    per_req = req.withColumn("__asked", F.lit(True)).join(counts, on="request_id", how="full_outer")
    res = results.select(*results.columns)
    joined = lookup_join(res, per_req.select("request_id", "__n", *rcols), ["request_id"],
                         "__n", **skew_kw).drop("__n")
    routed = joined.withColumn(
        "route", F.when(F.col("status") == "UPLOADED", "uploaded")
                  .when(F.col("status") == "SKIPPED", "skipped").otherwise("failure")
    ).withColumn("error", F.lit(None).cast("string"))
    empty = per_req.where(F.col("__asked") & F.col("__n").isNull()).drop("__n", "__asked")
    for c in results.columns:
        if c not in empty.columns:
            empty = empty.withColumn(c, F.lit(None).cast(results.schema[c].dataType))
    empty = (empty.withColumn("route", F.lit("failure"))
                  .withColumn("error", F.concat(F.lit(NO_RESULTS_TEXT), F.col("stage_command"))))
    return routed.unionByName(empty.select(*routed.columns))
