"""Composite steps: stage, submit, load and the whole pipeline.

stage files ──► request load ──► load (parse + per-file statistics) ──► await results
``stage_step``   ``classify_submission``   ``load_step``                 ``await_results``
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestflow.functions.compression import detect_compression, target_compression
from ingestflow.functions.template import resolve_template
from ingestflow.functions.timing import epoch_ms, int_div
from ingestflow.operators import audit, load, reconcile, staging, submit
from ingestflow.session import materialize
from ingestflow.sinks.stage import copy_to_stage, target_name
from ingestflow.sources.files import file_digest, file_header, list_files


def plan_copies(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """What to do with each distinct (file, stage, compression): target name and status.

    ``UPLOADED`` (to be copied), ``SKIPPED`` (the stage holds the same name and
    MD5) or ``FAILED`` (another source file of this run, first by directory and
    name, takes the same target).
    """
    # Only the first bytes are needed to name the target (compression sniffing).
    tagged = (file_header(files)
              .withColumn("source_compression", detect_compression("declared_compression", "header"))
              .withColumn("target_compression",
                          target_compression("source_compression", "auto_compress"))
              .withColumn("target_name", target_name())
              .drop("header"))
    source = F.struct("dir", "name", "target_compression")
    owners = tagged.groupBy("stage", "target_name").agg(F.min(source).alias("__owner"))
    # Only files whose target name the stage already holds need their MD5
    # before copying (to decide SKIPPED); new names are hashed during the copy,
    # so a new file is read once.
    names = (manifest.select("stage", "target_name").distinct()
             .withColumn("__known", F.lit(True)))
    marked = (tagged.join(owners, on=["stage", "target_name"])
              .withColumn("__clash", source != F.col("__owner"))
              .join(names, on=["stage", "target_name"], how="left"))
    marked = materialize(marked.withColumn("message", F.when(
        F.col("__clash"), F.concat(F.lit("target name is taken by "), F.col("__owner.dir"), F.lit("/"),
                                   F.col("__owner.name")))).drop("__owner"), "stage-marked")
    held = F.coalesce(F.col("__known"), F.lit(False)) & ~F.col("__clash")
    known = file_digest(marked.where(held).drop("__known", "__clash")).drop("header")
    rest = (marked.where(~held).withColumn("md5", F.lit(None).cast("string"))
            .withColumn("status", F.when(F.col("__clash"), "FAILED").otherwise("UPLOADED")))
    return staging.plan_staging(known, manifest).unionByName(rest.select(*known.columns, "status"))


def stage_step(raw_requests: DataFrame, manifest: DataFrame, stage_root: str,
               parallel: int | None = None) -> DataFrame:
    """Validate, expand wildcards, skip unchanged files, copy the rest, route.

    Invalid requests go to ``failure`` with their reasons as the error.  Every
    result inherits its request's columns (attributes included) and says where
    the file went and how long it took.  A file is listed, looked at and copied
    once, however many requests name it: the listing, the plan and the copy's
    results are written to the shared folder, and everything after reads those.
    ``parallel`` is the number of copy tasks; without it, the largest number
    that a valid request asks for.
    """
    v = staging.validate_requests(raw_requests)
    invalid = v.where(F.col("invalid_reason").isNotNull())
    valid = materialize(v.where(F.col("invalid_reason").isNull()).drop("invalid_reason"),
                        "stage-requests")
    listing = materialize(list_files(valid.select(F.col("input_directory").alias("dir"))),
                          "stage-listing")
    expanded = staging.expand_wildcards(valid, listing.withColumnRenamed("size", "file_size"))
    file_keys = ["dir", "name", "stage", "auto_compress", "declared_compression"]
    matched = materialize(expanded.where(F.col("name").isNotNull()).select(
        "request_id", F.col("input_directory").alias("dir"), "name",
        F.col("file_size").alias("size"), F.col("internal_stage").alias("stage"),
        "auto_compress", F.col("source_compression").alias("declared_compression")), "stage-matched")
    planned = materialize(plan_copies(matched.select(*file_keys, "size").distinct(), manifest),
                          "stage-planned")
    # Requests that differ in options only may share a target: it is copied once.
    copies = planned.dropDuplicates(["dir", "name", "stage", "target_name", "target_compression"])
    tasks = parallel or valid.agg(F.max("parallel")).first()[0]
    copied = materialize(copy_to_stage(
        copies.withColumn("request_id", F.concat_ws("|", "dir", "name", "stage", "target_name",
                                                    "target_compression")), stage_root, tasks), "stage-copied")
    of_file = planned.select(*file_keys, F.concat_ws(
        "|", "dir", "name", "stage", "target_name", "target_compression").alias("__copy"))
    results = matched.join(of_file, file_keys).select("request_id", "__copy").join(
        copied.withColumnRenamed("request_id", "__copy"), "__copy").drop("__copy")
    routed = staging.route_stage(valid, materialize(results, "stage-results"))
    failed = (staging.with_stage_command(invalid)
              .withColumn("route", F.lit("failure"))
              .withColumn("error", F.col("invalid_reason")))
    for c in routed.columns:
        if c not in failed.columns:
            failed = failed.withColumn(c, F.lit(None).cast(routed.schema[c].dataType))
    routed = routed.unionByName(failed.select(*routed.columns))
    elapsed = F.when(F.col("route") == "uploaded", F.col("end_ms") - F.col("start_ms"))
    return routed.withColumns({"transmission_ms": elapsed, "duration_s": int_div(elapsed, 1000)})


def manifest_additions(stage_routes: DataFrame) -> DataFrame:
    """(stage, name, md5) of the files a stage step actually copied."""
    return stage_routes.where(F.col("route") == "uploaded").select(
        F.col("internal_stage").alias("stage"), F.col("target_filename").alias("target_name"),
        "md5").distinct()


def load_step(spark: SparkSession, specs: list[load.PipeSpec], stage_root: str, loaded_at,
              requests: DataFrame, history: DataFrame | None = None, run: int | None = None
              ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load (pipe, file) requests below ``stage_root``: (target rows by pipe, history entries).

    ``run`` numbers the entries; without it, one more than any entry has.
    Paths of rows and entries are relative to the stage root, as requests name them.
    """
    prefix = stage_root.rstrip("/") + "/"
    wanted = requests.select("pipe", F.concat(F.lit(prefix), "file").alias("path"))
    prior = history.withColumn("path", F.concat(F.lit(prefix), "path")) if history is not None else None
    rows, stats = load.load_through_pipes(spark, specs, wanted, stage_root, prior)
    start = re.sub("^file:(//)?", "", prefix)
    relative = F.when(F.startswith("path", F.lit(start)), F.substring("path", len(start) + 1, 2 ** 31 - 1)) \
        .otherwise(F.col("path"))
    return ({name: r.withColumn("path", relative) for name, r in rows.items()},
            load.as_history(stats.withColumn("path", relative), loaded_at,
                            load.next_run(history) if run is None else run))


def run_flow(spark: SparkSession, raw_requests: DataFrame, manifest: DataFrame, stage_root: str,
             specs: list[load.PipeSpec], now, max_age_minutes: int, work_dir: str,
             pipe: Column | None = None, history: DataFrame | None = None,
             parallel: int | None = None) -> dict[str, DataFrame]:
    """The whole pipeline over one batch of stage requests; returns every step's output.

    Each uploaded file is loaded through the pipe that ``pipe`` (a column of the
    stage results; by default their ``pipe`` attribute, or the only pipe there
    is) names.  Files of all stages are followed.  A file for a pipe that is
    not defined fails at submission and is not waited for.

    The stage routes and the history are written to ``work_dir`` (a shared
    folder) and read back, so nothing is copied or parsed again downstream.
    """
    work = work_dir.rstrip("/")
    stage_step(raw_requests, manifest, stage_root, parallel).write.mode("overwrite") \
        .parquet(f"{work}/stage_routes")
    staged = spark.read.parquet(f"{work}/stage_routes")
    if pipe is None:
        named = resolve_template("${pipe}") if "attributes" in staged.columns else F.lit("")
        pipe = F.when(named != "", named).otherwise(
            F.lit(specs[0].name if len(specs) == 1 else None))
    attributes = F.col("attributes") if "attributes" in staged.columns else \
        F.create_map().cast("map<string,string>")
    # Only what this run copied is submitted and loaded; skipped files were
    # staged (and loaded) before, and other files in the stages are not ours.
    uploaded = staged.where(F.col("route") == "uploaded").select(
        "request_id", pipe.alias("pipe"),
        F.concat("internal_stage", F.lit("/"), "target_filename").alias("file"),
        attributes.alias("attributes"))
    defined = F.coalesce(F.col("pipe").isin([s.name for s in specs]), F.lit(False))
    submitted = submit.classify_submission(uploaded.withColumns({
        "kind": F.when(~defined, "other"),
        "message": F.when(~defined, F.concat(F.lit("pipe is not defined: "),
                                             F.coalesce("pipe", F.lit(""))))}))
    accepted = submitted.where(F.col("route") == "success")
    target_rows, entries = load_step(spark, specs, stage_root, now,
                                     accepted.select("pipe", "file").distinct(), history)
    entries.write.mode("overwrite").parquet(f"{work}/history")
    entries = spark.read.parquet(f"{work}/history")
    now_ms = epoch_ms(now)
    pending = accepted.select(
        "request_id", "pipe", "file", "attributes",
        F.lit(str(now_ms)).alias("queued_ms"), F.lit(now_ms).alias("lineage_ms"),
        F.xxhash64("request_id", "file").alias("arrival_seq"))
    known = entries if history is None else history.select(*entries.columns).unionByName(entries)
    awaited = reconcile.await_results(pending, known, max_age_minutes, now)
    return {
        "stage_routes": staged,
        "audit": audit.audit_events(staged.where(F.col("route") == "uploaded")),
        "manifest_additions": manifest_additions(staged),
        "submit_routes": submitted,
        "target_rows": target_rows,
        "history": entries,
        "await_routes": awaited,
        "await_counts": audit.route_counts(awaited),
    }
