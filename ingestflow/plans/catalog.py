"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (through ``ingestflow.fixtures``) and runs
the engine's operators over the whole of them; outputs alias every computed
column so the DuckDB oracle in ``ingestflow.plans.oracle`` can name them alike.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestflow import fixtures as fx
from ingestflow.api import StageFiles
from ingestflow.functions.codes import response_code
from ingestflow.functions.compression import detect_compression, target_compression
from ingestflow.functions.template import resolve_template
from ingestflow.functions.timing import int_div, queue_age
from ingestflow.operators import audit, history as hist, load, reconcile, staging, submit
from ingestflow.session import shared_dir
from ingestflow.sources import history_store
from ingestflow.streaming import await_stream, flow_stream

LINE_SPEC = load.PipeSpec(name=fx.LOAD_PIPE, format="csv",
                          schema_ddl="orderkey BIGINT, partkey BIGINT, quantity INT")
JSON_SPEC = load.PipeSpec(name="database.schema.events_pipe", format="json",
                          schema_ddl="id BIGINT, user BIGINT, kind STRING")
LINE_SPEC_SKIP = load.PipeSpec(name=fx.LOAD_PIPE, format="csv",
                               schema_ddl="orderkey BIGINT, partkey BIGINT, quantity INT",
                               on_error="SKIP_FILE")


def _await(spark, sf_dir, blank=False):
    return reconcile.await_results(fx.pending(spark, sf_dir, blank_stamps=blank),
                                   fx.history(spark, sf_dir), fx.MAX_AGE_MINUTES, fx.NOW)


def await_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _await(spark, sf_dir).select(
        "arrival_seq", "request_id", "pipe", "file", "route", "queued_ms", "error",
        "error_count", "age_minutes", "status")


def await_routes_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with a third of all requests on one key, hot-key path forced on."""
    out = reconcile.await_results(fx.pending_skewed(spark, sf_dir), fx.history(spark, sf_dir),
                                  fx.MAX_AGE_MINUTES, fx.NOW, min_hot_rows=0, max_hot_keys=100)
    return out.select("arrival_seq", "request_id", "pipe", "file", "route", "queued_ms",
                      "error", "error_count", "age_minutes", "status")


def route_counts(spark, sf_dir):
    return audit.route_counts(_await(spark, sf_dir))


def queue_age_q(spark, sf_dir):
    p = fx.pending(spark, sf_dir, blank_stamps=True)
    return p.select("arrival_seq", "queued_ms",
                    queue_age("queued_ms", fx.NOW_MS).alias("age_minutes"))


def queue_stamp(spark, sf_dir):
    return _await(spark, sf_dir, blank=True).select("arrival_seq", "route", "queued_ms")


def result_payload(spark, sf_dir):
    return _await(spark, sf_dir).where(F.col("payload").isNotNull()).select(
        "arrival_seq", "payload")


def lookback(spark, sf_dir):
    return hist.lookback_minutes(fx.pending(spark, sf_dir), fx.NOW)


def distinct_pipes(spark, sf_dir):
    return hist.distinct_pipes(fx.pending(spark, sf_dir))


def first_wins_age(spark, sf_dir):
    return reconcile.first_wins_age(fx.pending(spark, sf_dir), fx.NOW)


def latest_per_file(spark, sf_dir):
    return hist.latest_per_file(fx.history(spark, sf_dir)).select(
        "pipe", "path", "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error",
        "seq")


def history_for_pending(spark, sf_dir):
    return hist.history_for_pending(fx.history(spark, sf_dir), fx.pending(spark, sf_dir)).select(
        "seq", "pipe", "path", "status")


def history_for_pending_skewed(spark, sf_dir):
    """Semi-join with a third of all history on one pending key, every key split over 16 tasks."""
    return hist.history_for_pending(fx.history_skewed(spark, sf_dir), fx.pending(spark, sf_dir),
                                    salts=16).select(
        "seq", "pipe", "path", "status")


def history_multi_pipe(spark, sf_dir):
    return hist.history_multi_pipe(fx.history(spark, sf_dir), fx.pending(spark, sf_dir),
                                   fx.NOW).select("seq", "pipe", "path", "status")


def pipe_history(spark, sf_dir):
    return hist.pipe_history(fx.history(spark, sf_dir), fx.REPORT_PIPE,
                             fx.REPORT_TRAIL_MINUTES, fx.NOW).select(
        "seq", "pipe", "path", "status", "errors_seen", "first_error")


def history_document(spark, sf_dir):
    h = hist.pipe_history(fx.history(spark, sf_dir), fx.REPORT_PIPE,
                          fx.REPORT_TRAIL_MINUTES, fx.NOW)
    h = h.select("pipe", "path", "status", "rows_parsed", "rows_loaded", "errors_seen",
                 "first_error",
                 F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
                 "seq")
    return hist.history_document(h)


def submit_routes(spark, sf_dir):
    return submit.classify_submission(fx.outcomes(spark, sf_dir)).select(
        "request_id", "pipe", "file", "route", "response_code", "error_message")


def submit_two_rounds(spark, sf_dir):
    return submit.submit_rounds([fx.outcomes(spark, sf_dir, 1), fx.outcomes(spark, sf_dir, 2)]
                                ).select("request_id", "route", "round", "response_code",
                                         "error_message")


def response_code_q(spark, sf_dir):
    m = fx.error_messages(spark, sf_dir)
    return m.select("id", response_code("message").alias("response_code"))


def load_requests(spark, sf_dir):
    ev = fx.attribute_events(spark, sf_dir)
    return submit.load_requests(ev, "pipe_${k}").select("event_id", "pipe", "file")


def resolve_template_q(spark, sf_dir):
    ev = fx.attribute_events(spark, sf_dir)
    t1, t2, t3 = fx.ATTR_TEMPLATES
    return ev.select("event_id", resolve_template(t1).alias("t1"),
                     resolve_template(t2).alias("t2"), resolve_template(t3).alias("t3"))


def stage_command(spark, sf_dir):
    req = staging.validate_requests(fx.stage_requests(spark, sf_dir))
    return staging.with_stage_command(req).select("request_id", "stage_command")


def validate_requests(spark, sf_dir):
    req = staging.validate_requests(fx.stage_requests(spark, sf_dir, with_invalid=True))
    return req.select("request_id", "invalid_reason", "parallel")


def wildcard_match(spark, sf_dir):
    req = fx.wildcard_requests(spark, sf_dir)
    files = fx.source_files(spark, sf_dir).select("dir", "name", "size")
    return staging.expand_wildcards(req, files, dir_col="dir", pattern_col="pattern").select(
        "request_id", "dir", "pattern", "name", "size")


def stage_plan(spark, sf_dir):
    files = fx.source_files(spark, sf_dir).withColumn("target_name", F.col("name"))
    return staging.plan_staging(files, fx.stage_manifest(spark, sf_dir)).select(
        "stage", "dir", "name", "size", "md5", "status")


def _stage_routes(spark, sf_dir, skewed=False, **kw):
    req = staging.validate_requests(fx.stage_requests_all(spark, sf_dir))
    res = (fx.stage_results_skewed if skewed else fx.stage_results)(spark, sf_dir).select(
        "request_id", "source_filename", "target_filename", "source_size", "target_size",
        "source_compression", "target_compression", "status", "encryption", "message")
    return staging.route_stage(req, res, **kw)


def stage_routes_skewed(spark, sf_dir):
    """Stage routing with a third of all results on one request, hot-key path forced on."""
    return _stage_routes(spark, sf_dir, skewed=True, min_hot_rows=0, max_hot_keys=100).select(
        "request_id", "source_filename", "status", "route", "error", "stage_command")


def stage_routes(spark, sf_dir):
    return _stage_routes(spark, sf_dir).select("request_id", "source_filename", "status",
                                               "route", "error")


def stage_route_counts(spark, sf_dir):
    return audit.route_counts(_stage_routes(spark, sf_dir))


def submit_route_counts(spark, sf_dir):
    return audit.route_counts(submit.classify_submission(fx.outcomes(spark, sf_dir)))


def stage_no_results(spark, sf_dir):
    return _stage_routes(spark, sf_dir).where(F.col("source_filename").isNull()).select(
        "request_id", "route", "error")


def audit_events(spark, sf_dir):
    return audit.audit_events(fx.stage_results(spark, sf_dir))


def load_rows(spark, sf_dir):
    return load.loaded_rows(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC), LINE_SPEC)


def load_history(spark, sf_dir):
    return load.file_stats(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC), LINE_SPEC)


def load_history_skip_file(spark, sf_dir):
    return load.file_stats(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC_SKIP),
                           LINE_SPEC_SKIP)


def load_rows_skip_file(spark, sf_dir):
    parsed = load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC_SKIP)
    return load.loaded_rows(parsed, LINE_SPEC_SKIP)


def load_history_json(spark, sf_dir):
    return load.file_stats(load.parse_lines(fx.json_lines(spark, sf_dir), JSON_SPEC), JSON_SPEC)


def load_rows_json(spark, sf_dir):
    return load.loaded_rows(load.parse_lines(fx.json_lines(spark, sf_dir), JSON_SPEC), JSON_SPEC)


def await_two_rounds(spark, sf_dir):
    out = reconcile.await_rounds(fx.pending(spark, sf_dir), fx.history(spark, sf_dir),
                                 fx.MAX_AGE_MINUTES, [fx.ROUND1_NOW, fx.NOW])
    return out.select("arrival_seq", "route", "round", "queued_ms", "error")


def await_routes_bad_stamps(spark, sf_dir):
    """Invalid stamps and missing order numbers change no other row."""
    out = reconcile.await_results(fx.pending_bad_stamps(spark, sf_dir), fx.history(spark, sf_dir),
                                  fx.MAX_AGE_MINUTES, fx.NOW)
    return out.select("request_id", "pipe", "file", "route", "queued_ms", "error", "age_minutes",
                      "status")


def first_wins_bad_stamps(spark, sf_dir):
    return reconcile.first_wins_age(fx.pending_bad_stamps(spark, sf_dir), fx.NOW)


def await_rounds_late(spark, sf_dir):
    """Two early rounds: most requests arrive after the last one and are reported as waiting."""
    out = reconcile.await_rounds(fx.pending(spark, sf_dir), fx.history(spark, sf_dir),
                                 fx.MAX_AGE_MINUTES, list(fx.EARLY_ROUNDS))
    return out.select("arrival_seq", "route", "round", "queued_ms", "error")


def wildcard_match_skewed(spark, sf_dir):
    """A hot directory and a hot pattern, repeated and missing request ids, hot paths forced on."""
    req = fx.wildcard_requests_skewed(spark, sf_dir)
    files = fx.source_files(spark, sf_dir).select("dir", "name", "size")
    return staging.expand_wildcards(req, files, dir_col="dir", pattern_col="pattern", salt_buckets=4,
                                    min_hot_rows=0, max_hot_keys=10).select(
        "request_id", "dir", "pattern", "name", "size")


def detect_compression_q(spark, sf_dir):
    f = fx.header_files(spark, sf_dir)
    source = detect_compression("declared", "header")
    return f.select("file", source.alias("source_compression"),
                    target_compression(source, "auto_compress").alias("target_compression"))


def stage_results_named(spark, sf_dir):
    """All nine result columns, the duration and the transmission of every routed result."""
    req = staging.validate_requests(fx.stage_requests_all(spark, sf_dir))
    out = staging.route_stage(req, fx.stage_results(spark, sf_dir))
    elapsed = F.col("end_ms") - F.col("start_ms")
    return out.select("request_id", "source_filename", "target_filename", "source_size", "target_size",
                      F.col("source_compression").alias("source_compression"), "target_compression",
                      "status", "encryption", "message", "route",
                      elapsed.alias("transmission_ms"), int_div(elapsed, 1000).alias("duration_s"))


def stage_requests_q(spark, sf_dir):
    """Stage requests resolved from events' attributes, which go along."""
    step = StageFiles("/home/account/${segment}", "c_${key}_*.csv", "database.schema.stage_${nation}",
                      auto_compress="${zip}", parallel="${absent}9")
    return staging.validate_requests(step.requests(fx.stage_events(spark, sf_dir))).select(
        "request_id", "input_directory", "file_name", "internal_stage", "auto_compress",
        "source_compression", "parallel", "invalid_reason",
        F.col("attributes")["segment"].alias("segment"))


def stage_step_tables(spark, sf_dir):
    """The stage step's tables joined: all results with their event's attributes, and the sent ones' audit."""
    step = StageFiles("/home/account/${segment}", "c_${key}_*.csv", "database.schema.stage_${nation}")
    req = staging.validate_requests(step.requests(fx.stage_events(spark, sf_dir)))
    res = fx.stage_results(spark, sf_dir)
    sent = audit.audit_events(res.where(F.col("status") != "FAILED")) \
        .withColumnRenamed("source_filename", "sent_file").drop("request_id")
    routed = staging.route_stage(req, res)
    return routed.join(sent, F.col("source_filename") == F.col("sent_file"), "left").select(
        "request_id", "source_filename", "route", "target_url", "transmission_ms", "duration_s",
        F.col("attributes")["nation"].alias("nation"), "stage_command")


def load_history_reload(spark, sf_dir):
    """The same files loaded in two runs; the later run's entry of a file wins."""
    first = load.file_stats(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC_SKIP), LINE_SPEC_SKIP)
    again = load.file_stats(load.parse_lines(fx.lines_mended(spark, sf_dir), LINE_SPEC_SKIP), LINE_SPEC_SKIP)
    # The second run's clock is behind: runs count, not clocks.
    entries = load.as_history(first, fx.NOW, run=1).unionByName(
        load.as_history(again, fx.ROUND1_NOW, run=2))
    return hist.latest_per_file(entries).select(
        "pipe", "path", "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error", "seq")


def load_history_missing(spark, sf_dir):
    """Every wanted file has an outcome: read, empty, not there, or not readable."""
    stats = load.file_stats(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC), LINE_SPEC)
    return load.file_outcomes(fx.listed_files(spark, sf_dir), stats, LINE_SPEC)


def load_history_two_pipes(spark, sf_dir):
    """Files of two pipes and formats; the same load request names its pipe."""
    csv = load.file_stats(load.parse_lines(fx.lines(spark, sf_dir), LINE_SPEC_SKIP), LINE_SPEC_SKIP)
    jsn = load.file_stats(load.parse_lines(fx.json_lines(spark, sf_dir), JSON_SPEC), JSON_SPEC)
    return csv.unionByName(jsn).groupBy("pipe", "status").agg(
        F.count("*").alias("files"), F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("errors_seen").alias("errors_seen"))


def await_routes_extreme(spark, sf_dir):
    """Stamps and lineage starts at the ends of a long abort nothing and change no other row."""
    out = reconcile.await_results(fx.pending_extreme(spark, sf_dir), fx.history(spark, sf_dir),
                                  fx.MAX_AGE_MINUTES, fx.NOW)
    return out.select("request_id", "pipe", "file", "route", "queued_ms", "age_minutes", "status")


def submit_rounds_unanswered(spark, sf_dir):
    """Round 2 has no outcome for a third of the requests; round 3 answers a part of those."""
    second = fx.outcomes(spark, sf_dir, 2)
    key = F.col("request_id").cast("long")
    return submit.submit_rounds([
        fx.outcomes(spark, sf_dir, 1), second.where(key % 3 != 0), second.where(key % 6 == 0)]).select(
        "request_id", "route", "round", "response_code", "error_message")


def history_store_multi_pipe(spark, sf_dir):
    """The pending pipes' history from a store kept by pipe and day, pruned while it is read."""
    entries = fx.history(spark, sf_dir)
    path = f"{shared_dir(spark).rstrip('/')}/ingestflow/history-{uuid.uuid4().hex}"
    history_store.append_history(entries.where(F.col("seq") % 2 == 0), path)
    history_store.append_history(entries.where(F.col("seq") % 2 == 1), path)
    store = history_store.read_history(spark, path, entries.schema)
    return history_store.history_multi_pipe(store, path, fx.pending(spark, sf_dir), fx.NOW).select(
        "seq", "pipe", "path", "status")


def latest_upkeep(spark, sf_dir):
    """Latest entries kept up over three appended runs of history."""
    path = f"{shared_dir(spark).rstrip('/')}/ingestflow/latest-{uuid.uuid4().hex}"
    entries = fx.history(spark, sf_dir)
    for run in range(3):
        hist.update_latest(entries.where(F.col("seq") % 3 == run), path, buckets=16)
    return hist.read_latest(spark, path).select(
        "pipe", "path", "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error", "seq")


def _staged_requests(spark, root):
    """(pipe, path) of every staged file, each through its own pipe, and through one that is not defined."""
    files = load.list_staged(spark, root, "part-*")
    own = F.when(F.col("path").contains("/csv/"), LINE_SPEC_SKIP.name).otherwise(JSON_SPEC.name)
    return files.select(F.explode(F.array(own, F.lit("no.such.pipe"))).alias("pipe"), "path")


def load_pipes(spark, sf_dir):
    """Files of two formats loaded through the pipe that each request names, every file read once."""
    root = fx.staged_files(spark, sf_dir)
    rows, stats = load.load_through_pipes(spark, [LINE_SPEC_SKIP, JSON_SPEC], _staged_requests(spark, root), root)
    loaded = None
    for pipe, r in rows.items():
        part = r.groupBy("path").agg(F.count(F.lit(1)).alias("target_rows")).withColumn("pipe", F.lit(pipe))
        loaded = part if loaded is None else loaded.unionByName(part)
    return stats.join(loaded, ["pipe", "path"], "left").select(
        "pipe", fx.staged_name().alias("path"), "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error",
        F.coalesce("target_rows", F.lit(0).cast("long")).alias("target_rows"))


def flow_two_batches(spark, sf_dir):
    """The whole pipeline over two micro-batches of staged files: submitted, loaded, awaited."""
    root = fx.staged_files(spark, sf_dir)
    out = f"{shared_dir(spark).rstrip('/')}/ingestflow/flow-{uuid.uuid4().hex}"
    prefix = F.lit(load.normalise_root(spark, root) + "/")
    requests = _staged_requests(spark, root).select(
        F.concat_ws("|", fx.staged_name(), "pipe").alias("request_id"), "pipe",
        F.replace(F.col("path"), prefix, F.lit("")).alias("file"),
        F.create_map().cast("map<string,string>").alias("attributes"))
    json = F.col("request_id").startswith("ev_")
    flow = flow_stream.FlowBatches([LINE_SPEC_SKIP, JSON_SPEC], root, fx.MAX_AGE_MINUTES, out,
                                   lambda batch, i: fx.NOW + i * _dt.timedelta(hours=1))
    flow(requests.where(~json), 0)
    flow(requests.where(json), 1)
    return await_stream.read_routes(spark, f"{out}/await").select(
        "request_id", "pipe", "route", "status", "error", "error_count", F.col("batch").cast("int").alias("batch"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "await_routes": await_routes,
    "route_counts": route_counts,
    "queue_age": queue_age_q,
    "queue_stamp": queue_stamp,
    "result_payload": result_payload,
    "lookback": lookback,
    "distinct_pipes": distinct_pipes,
    "first_wins_age": first_wins_age,
    "latest_per_file": latest_per_file,
    "history_for_pending": history_for_pending,
    "history_multi_pipe": history_multi_pipe,
    "pipe_history": pipe_history,
    "history_document": history_document,
    "submit_routes": submit_routes,
    "submit_two_rounds": submit_two_rounds,
    "response_code": response_code_q,
    "load_requests": load_requests,
    "resolve_template": resolve_template_q,
    "stage_command": stage_command,
    "validate_requests": validate_requests,
    "wildcard_match": wildcard_match,
    "stage_plan": stage_plan,
    "stage_routes": stage_routes,
    "stage_no_results": stage_no_results,
    "audit_events": audit_events,
    "load_rows": load_rows,
    "load_history": load_history,
    "load_rows_skip_file": load_rows_skip_file,
    "load_history_skip_file": load_history_skip_file,
    "await_two_rounds": await_two_rounds,
    "await_routes_skewed": await_routes_skewed,
    "load_history_json": load_history_json,
    "load_rows_json": load_rows_json,
    "stage_routes_skewed": stage_routes_skewed,
    "stage_route_counts": stage_route_counts,
    "submit_route_counts": submit_route_counts,
    "history_for_pending_skewed": history_for_pending_skewed,
    "await_routes_bad_stamps": await_routes_bad_stamps,
    "first_wins_bad_stamps": first_wins_bad_stamps,
    "await_rounds_late": await_rounds_late,
    "wildcard_match_skewed": wildcard_match_skewed,
    "detect_compression": detect_compression_q,
    "stage_results_named": stage_results_named,
    "stage_requests": stage_requests_q,
    "stage_step_tables": stage_step_tables,
    "load_history_reload": load_history_reload,
    "load_history_missing": load_history_missing,
    "load_history_two_pipes": load_history_two_pipes,
    "await_routes_extreme": await_routes_extreme,
    "submit_rounds_unanswered": submit_rounds_unanswered,
    "history_store_multi_pipe": history_store_multi_pipe,
    "latest_upkeep": latest_upkeep,
    "load_pipes": load_pipes,
    "flow_two_batches": flow_two_batches,
}
