"""Engine inputs derived from the given test tables (the FX-* derivations).

Each function reads one of the parquet tables and projects it into the shape
an operator consumes.  Everything is a narrow projection or filter of the
scan, so the derived inputs grow with the tables and keep their pushdown.
The matching DuckDB derivations live in ``ingestflow.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestflow.functions.timing import col_epoch_ms, epoch_ms, ts_literal
from ingestflow.session import shared_dir
from ingestflow.sources.tables import read_table

# Fixed parameters of the test scenario.
NOW = _dt.datetime(2024, 1, 31)
NOW_MS = epoch_ms(NOW)
MAX_AGE_MINUTES = 14400
LINEAGE_FLOOR = _dt.datetime(2024, 1, 11)
ROUND1_NOW = _dt.datetime(2024, 1, 21)
EARLY_ROUNDS = (_dt.datetime(2024, 1, 6), _dt.datetime(2024, 1, 12))
REPORT_PIPE = "pipe_2"
REPORT_TRAIL_MINUTES = -2880
DOC_STAGE = "database.schema.docs"
LOAD_PIPE = "database.schema.lineitem_pipe"
WILDCARD_PATTERNS = ("d1*.txt", "d?.txt", "d??.txt", "none*", "d1*.txt")
ABSENT_NAME = "absent.txt"
ATTR_TEMPLATES = ("${filename}", "in/${k}/${filename}", "${absent}x")


def _pipe_of(n):
    return F.concat(F.lit("pipe_"), F.pmod(n, F.lit(5)).cast("string"))


def pending(spark: SparkSession, sf_dir: str, blank_stamps: bool = False) -> DataFrame:
    """FX-PENDING: one queued load request per ``view`` event."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    grp = F.expr("event_id div 3")
    stamp = col_epoch_ms(F.col("ts")).cast("string")
    if blank_stamps:
        stamp = (F.when(F.col("event_id") % 34 == 0, F.lit(None).cast("string"))
                 .when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(stamp))
    file_name = F.concat(F.lit("f_"), grp.cast("string"), F.lit(".csv"))
    floor = ts_literal(LINEAGE_FLOOR, ev.schema["ts"].dataType)
    return ev.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.when(F.col("props") == '{"k": 0}', F.lit(None).cast("string"))
         .otherwise(_pipe_of(grp)).alias("pipe"),
        F.when(F.col("props") == '{"k": 1}', F.lit(None).cast("string"))
         .otherwise(file_name).alias("file"),
        F.map_concat(F.from_json("props", "map<string,string>"),
                     F.create_map(F.lit("filename"), file_name)).alias("attributes"),
        stamp.alias("queued_ms"),
        col_epoch_ms(F.greatest(F.col("ts"), floor)).alias("lineage_ms"),
        F.col("event_id").alias("arrival_seq"),
    )


def pending_bad_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-PENDING over all events, every fifth stamp invalid, every seventh order number missing."""
    ev = read_table(spark, sf_dir, "events")
    eid, grp = F.col("event_id"), F.expr("event_id div 3")
    ms = col_epoch_ms(F.col("ts")).cast("string")
    stamp = (F.when(eid % 5 == 1, F.concat(F.lit(" "), ms)).when(eid % 10 == 6, F.lit("soon"))
             .otherwise(ms))
    return ev.select(
        F.concat(F.lit("r"), eid.cast("string")).alias("request_id"),
        _pipe_of(grp).alias("pipe"),
        F.concat(F.lit("f_"), grp.cast("string"), F.lit(".csv")).alias("file"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        stamp.alias("queued_ms"), col_epoch_ms(F.col("ts")).alias("lineage_ms"),
        F.when(eid % 7 != 0, eid).alias("arrival_seq"))


def pending_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-PENDING over all events, some stamps and lineage starts at the ends of what a long holds."""
    p = pending_bad_stamps(spark, sf_dir)
    eid = F.regexp_extract("request_id", "[0-9]+", 0).cast("long")
    return p.withColumns({
        "queued_ms": F.when(eid % 11 == 3, str(-2 ** 63)).when(eid % 11 == 5, str(2 ** 63 - 1))
                      .otherwise((eid * 60000).cast("string")),
        "lineage_ms": F.when(eid % 13 == 4, F.lit(-10 ** 17)).when(eid % 13 == 6, F.lit(-2 ** 63))
                       .when(eid % 13 == 8, F.lit(2 ** 63 - 1)).otherwise(F.col("lineage_ms"))})


def pending_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-PENDING with every third request moved onto one (pipe, file) key."""
    p = pending(spark, sf_dir)
    hot = (F.col("arrival_seq") % 3 == 0)
    return (p.withColumn("pipe", F.when(hot & F.col("pipe").isNotNull(), F.lit("pipe_0"))
                         .otherwise(F.col("pipe")))
             .withColumn("file", F.when(hot & F.col("file").isNotNull(), F.lit("f_0.csv"))
                         .otherwise(F.col("file"))))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-lines record per event, some malformed, spread over 50 files."""
    ev = read_table(spark, sf_dir, "events")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    s = lambda c: c.cast("string")
    value = (F.when(eid % 50 == 13, F.concat(F.lit("["), s(eid), F.lit("]")))
             .when((et == "error") & (eid % 3 == 0), F.concat(F.lit("{broken "), s(eid)))
             .when((et == "signup") & (eid % 4 == 0),
                   F.concat(F.lit('{"id": "x'), s(eid), F.lit('", "user": '), s(uid), F.lit("}")))
             .when((et == "click") & (eid % 5 == 0),
                   F.concat(F.lit('{"id": '), s(eid), F.lit("}")))
             .otherwise(F.concat(F.lit('{"id": '), s(eid), F.lit(', "user": '), s(uid),
                                 F.lit(', "kind": "'), et, F.lit('"}'))))
    return ev.select(F.concat(F.lit("ev_"), s(eid % 50), F.lit(".json")).alias("path"),
                     value.alias("value"), eid.alias("pos"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-HISTORY: one load-history entry per non-``view`` event."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") != "view")
    grp = F.expr("event_id div 3")
    status = (F.when(F.col("event_type") == "purchase", "LOADED")
              .when(F.col("event_type") == "signup", "PARTIALLY_LOADED")
              .when(F.col("event_type") == "error", "LOAD_FAILED")
              .otherwise("LOAD_IN_PROGRESS"))
    erroneous = F.col("event_type").isin("signup", "error")
    errors = F.when(erroneous, F.col("event_id") % 7 + 1)
    parsed = F.when(F.col("event_type") != "click", F.col("event_id") % 50 + 10)
    loaded = (F.when(F.col("event_type") == "purchase", parsed)
              .when(F.col("event_type") == "signup", parsed - errors)
              .when(F.col("event_type") == "error", F.lit(0).cast("long")))
    return ev.select(
        _pipe_of(grp).alias("pipe"),
        F.concat(F.lit("f_"), grp.cast("string"), F.lit(".csv")).alias("path"),
        status.alias("status"),
        parsed.cast("long").alias("rows_parsed"),
        loaded.cast("long").alias("rows_loaded"),
        errors.cast("long").alias("errors_seen"),
        F.when(erroneous, F.concat(F.lit("err "), F.col("event_id").cast("string")))
         .alias("first_error"),
        F.col("ts").alias("event_ts"),
        F.col("event_id").alias("seq"),
    )


def history_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-HISTORY with every third entry moved onto the key (pipe_0, f_0.csv)."""
    h = history(spark, sf_dir)
    hot = F.col("seq") % 3 == 0
    return (h.withColumn("pipe", F.when(hot, F.lit("pipe_0")).otherwise(F.col("pipe")))
             .withColumn("path", F.when(hot, F.lit("f_0.csv")).otherwise(F.col("path"))))


def outcomes(spark: SparkSession, sf_dir: str, round_no: int = 1) -> DataFrame:
    """FX-OUTCOME: one submission outcome per order.

    Round 2 (the resubmission of retried rows) succeeds for even order keys
    and is throttled again for odd ones.
    """
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderkey") % 10
    if round_no == 1:
        kind = (F.when(d == 0, "backoff").when(d.isin(1, 2, 3, 4, 5, 6), "response")
                .when(d == 7, "other"))
        message = (F.when(d == 0, "slow down")
                   .when(d == 1, "HTTP Status: 400").when(d == 2, "HTTP Status: 404")
                   .when(d == 3, "HTTP Status: 429").when(d == 4, "HTTP Status: 500")
                   .when(d == 5, "HTTP Status: 503").when(d == 6, "connection reset")
                   .when(d == 7, "boom"))
    else:
        odd = F.col("o_orderkey") % 2 == 1
        kind = F.when(odd, "backoff")
        message = F.when(odd, "slow down again")
    return o.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        _pipe_of(F.col("o_custkey")).alias("pipe"),
        F.concat(F.lit("f_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file"),
        kind.alias("kind"), message.alias("message"))


def error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error texts for response-code extraction, one per order (several shapes)."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = k % 6
    msg = (F.when(d == 0, F.concat(F.lit("HTTP Status: "), (k % 200 + 400).cast("string")))
           .when(d == 1, F.lit("x HTTP Status: 429 y HTTP Status: 1500"))
           .when(d == 2, F.lit("no status here"))
           .when(d == 3, F.concat(F.lit("first line\nHTTP Status: "),
                                  (k % 7 + 500).cast("string"), F.lit(" tail")))
           .when(d == 4, F.lit("HTTP Status: abc")))
    return o.select(k.alias("id"), msg.alias("message"))


def stage_requests_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage requests of customers and of suppliers; the latter have no orders, so no results."""
    key = F.col("s_suppkey").cast("string")
    return stage_requests(spark, sf_dir).unionByName(read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), key).alias("request_id"), F.lit("/home/supplier").alias("input_directory"),
        F.concat(F.lit("s_"), key, F.lit("_*.csv")).alias("file_name"),
        F.concat(F.lit("database.schema.stage_"), (F.col("s_nationkey") % 5).cast("string"))
         .alias("internal_stage"),
        F.lit("default").alias("auto_compress"), F.lit("NONE").alias("source_compression"),
        F.lit("4").alias("parallel")))


def stage_requests(spark: SparkSession, sf_dir: str, with_invalid: bool = False) -> DataFrame:
    """Stage requests, one per customer (all fields as received, strings)."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ac = F.when(key % 3 == 0, "default").when(key % 3 == 1, "true").otherwise("false")
    sc_vals = ["default", "AUTO_DETECT", "GZIP", "BZ2", "BROTLI", "ZSTD", "DEFLATE",
               "RAW_DEFLATE", "NONE"]
    sc = F.element_at(F.array(*[F.lit(v) for v in sc_vals]), (key % 9 + 1).cast("int"))
    par = (F.when(key % 4 == 0, "4").when(key % 4 == 1, "10").when(key % 4 == 2, "1")
           .otherwise("99"))
    directory = F.concat(F.lit("/home/account/"), F.lower("c_mktsegment"))
    name = F.concat(F.lit("c_"), key.cast("string"), F.lit("_*.csv"))
    if with_invalid:
        ac = F.when(key % 13 == 0, "maybe").otherwise(ac)
        par = F.when(key % 11 == 0, "x4").otherwise(par)
        directory = F.when(key % 17 == 0, "").otherwise(directory)
        sc = F.when(key % 19 == 0, "LZO").otherwise(sc)
        name = F.when(key % 23 == 0, F.lit(None).cast("string")).otherwise(name)
    return c.select(
        key.cast("string").alias("request_id"),
        directory.alias("input_directory"),
        name.alias("file_name"),
        F.concat(F.lit("database.schema.stage_"), (F.col("c_nationkey") % 5).cast("string"))
         .alias("internal_stage"),
        ac.alias("auto_compress"), sc.alias("source_compression"), par.alias("parallel"))


def stage_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-STAGE-RESULT: one copy result per order."""
    o = read_table(spark, sf_dir, "orders")
    src = F.concat(F.lit("c_"), F.col("o_custkey").cast("string"), F.lit("_"),
                   F.col("o_orderkey").cast("string"), F.lit(".csv"))
    status = (F.when(F.col("o_orderstatus") == "F", "UPLOADED")
              .when(F.col("o_orderstatus") == "P", "SKIPPED").otherwise("FAILED"))
    size = F.floor("o_totalprice").cast("long")
    return o.select(
        F.col("o_custkey").cast("string").alias("request_id"),
        src.alias("source_filename"),
        F.concat(src, F.lit(".gz")).alias("target_filename"),
        size.alias("source_size"),
        F.call_function("div", size, F.lit(3).cast("long")).alias("target_size"),
        F.lit("NONE").alias("source_compression"),
        F.lit("GZIP").alias("target_compression"),
        status.alias("status"),
        F.lit("ENCRYPTED").alias("encryption"),
        F.when(status == "FAILED", F.concat(F.lit("upload failed for "), src))
         .otherwise(F.lit("")).alias("message"),
        F.col("o_orderkey").alias("result_seq"),
        (col_epoch_ms(F.col("o_orderdate"))).alias("start_ms"),
        (col_epoch_ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 5000) * 7)
        .alias("end_ms"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("jdbc:warehouse://acct"),
                             (F.col("o_custkey") % 3).cast("string"),
                             F.lit(".example.com"))).alias("url"),
    )


def stage_results_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-STAGE-RESULT with every third result reported for request ``1``."""
    r = stage_results(spark, sf_dir)
    return r.withColumn("request_id", F.when(F.col("result_seq") % 3 == 0, F.lit("1"))
                        .otherwise(F.col("request_id")))


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-FILES: one listed source file per document (md5 over the whole text)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.lit(DOC_STAGE).alias("stage"),
        F.concat(F.lit("/src/"), F.col("source")).alias("dir"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        F.col("n_chars").alias("size"),
        F.md5(F.col("text")).alias("md5"))


def stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-MANIFEST: what the stage already holds (a third of the files, half changed)."""
    d = read_table(spark, sf_dir, "documents").where(F.col("doc_id") % 3 == 0)
    changed = F.col("doc_id") % 6 == 0
    return d.select(
        F.lit(DOC_STAGE).alias("stage"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("target_name"),
        F.when(changed, F.md5(F.concat(F.col("text"), F.lit("x"))))
         .otherwise(F.md5(F.col("text"))).alias("md5"))


def wildcard_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source directory: patterns (one twice) and a plain name that is absent; per file: its name."""
    d = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/src/"), F.col("source")).alias("dir"), "doc_id")
    pats = F.array(*[F.lit(p) for p in (*WILDCARD_PATTERNS, ABSENT_NAME)])
    asked = d.select("dir").distinct().select("dir", F.posexplode(pats).alias("n", "pattern"))
    named = d.select("dir", F.lit(-1).alias("n"),
                     F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("pattern"))
    return asked.unionByName(named).select(
        F.concat_ws("|", "dir", F.col("n").cast("string"), "pattern").alias("request_id"), "dir", "pattern")


def wildcard_requests_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per document, a third of them the same pattern of one directory; ids repeat."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    hot = k % 3 == 0
    return d.select(
        F.when(k % 11 != 0, (k % 100).cast("string")).alias("request_id"),
        F.when(hot, F.lit("/src/src0")).otherwise(F.concat(F.lit("/src/"), F.col("source"))).alias("dir"),
        F.when(hot, F.lit("d1?.txt")).when(k % 3 == 1, F.lit(ABSENT_NAME))
         .otherwise(F.concat(F.lit("d"), (k % 10).cast("string"), F.lit("?.txt"))).alias("pattern"))


def header_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per page and document with its first bytes, declared and wished compression."""
    p = read_table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("file"), F.col("page_id").alias("k"),
        F.encode(F.substring("html", 1, 16), "UTF-8").alias("text"))
    d = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file"), F.col("doc_id").alias("k"),
        F.encode(F.substring("text", 1, 16), "UTF-8").alias("text"))
    kinds = ["1F8B0800", "425A6839", "28B52FFD04", "789C4B4C", "78014B04", "785E4B4C80"]
    magic = F.element_at(F.array(*[F.lit(x) for x in kinds]), (F.col("k") % 6 + 1).cast("int"))
    header = (F.when(F.col("k") % 8 < 6, F.unhex(magic))
              .when(F.col("k") % 8 == 6, F.encode(F.lit("x^2 + y^2 = z^2"), "UTF-8")).otherwise(F.col("text")))
    declared = F.element_at(F.array(*[F.lit(v) for v in ("AUTO_DETECT", "default", "NONE", "BROTLI", "GZIP")]),
                            (F.col("k") % 5 + 1).cast("int"))
    wish = F.element_at(F.array(*[F.lit(v) for v in ("default", "true", "false")]), (F.col("k") % 3 + 1).cast("int"))
    return p.unionByName(d).select("file", header.alias("header"), declared.alias("declared"),
                                   F.when(F.col("k") % 4 != 3, wish).alias("auto_compress"))


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per customer whose attributes name what to stage."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    return c.select(key.alias("request_id"), F.create_map(
        F.lit("segment"), F.lower("c_mktsegment"), F.lit("key"), key,
        F.lit("nation"), F.col("c_nationkey").cast("string"),
        F.lit("zip"), F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false")).alias("attributes"))


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of FX-LINES and others: a size where there is a file, 0 where it is empty, else null."""
    li = read_table(spark, sf_dir, "lineitem")
    n = F.col("l_orderkey") % 200
    there = li.groupBy(n.alias("n")).agg(F.count("*").alias("size")).select(
        F.concat(F.lit("part_"), F.col("n").cast("string"), F.lit(".csv")).alias("path"), "size")
    others = read_table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 30).alias("m")).distinct().select(
        F.concat(F.lit("other_"), F.col("m").cast("string"), F.lit(".csv")).alias("path"),
        F.when(F.col("m") % 3 == 0, 0).when(F.col("m") % 3 == 1, 7).cast("long").alias("size"))
    return there.unionByName(others)


def lines_mended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-LINES as a second run finds them: the bad quantities of even files are mended."""
    even = F.regexp_extract("path", "part_([0-9]+)", 1).cast("int") % 2 == 0
    return lines(spark, sf_dir).withColumn("value", F.when(
        even, F.regexp_replace("value", "bad$", "1")).otherwise(F.col("value")))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-LINES: one CSV text line per lineitem row, some with a bad quantity."""
    li = read_table(spark, sf_dir, "lineitem")
    bad = (((F.col("l_partkey") % 97 == 0) & (F.col("l_orderkey") % 4 != 0))
           | (F.col("l_orderkey") % 40 == 7))
    qty = F.when(bad, F.lit("bad")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    return li.select(
        F.concat(F.lit("part_"), (F.col("l_orderkey") % 200).cast("string"),
                 F.lit(".csv")).alias("path"),
        F.concat_ws(",", F.col("l_orderkey").cast("string"),
                    F.col("l_partkey").cast("string"), qty).alias("value"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_shipdate").alias("pos"))


def staged_files(spark: SparkSession, sf_dir: str) -> str:
    """FX-LINES and the JSON lines written as files of a stage; returns the stage's folder.

    Each file is a folder ``path=<name>`` with one text file, its lines in order.
    """
    root = f"{shared_dir(spark).rstrip('/')}/ingestflow/stage-{uuid.uuid4().hex}"
    for kind, rows in (("csv", lines(spark, sf_dir)), ("json", json_lines(spark, sf_dir))):
        rows.repartition("path").sortWithinPartitions("path", "pos").select("value", "path") \
            .write.partitionBy("path").text(f"{root}/{kind}")
    return root


def staged_name(path="path"):
    """The name in FX-LINES of a staged file."""
    return F.regexp_extract(path, "path=([^/]+)/", 1)


def attribute_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-ATTR: events with an attribute map (props plus a file name)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.map_concat(F.from_json("props", "map<string,string>"),
                     F.create_map(F.lit("filename"),
                                  F.concat(F.lit("f_"), F.col("event_id").cast("string"),
                                           F.lit(".csv")))).alias("attributes"))
