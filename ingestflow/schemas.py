"""Row shapes of the engine's inputs and outputs.

A queued event is a row; its free-form attributes are one ``map<string,string>``
column and everything the engine reads from it is a typed column.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ATTRIBUTES = T.MapType(_S, _S)

# Request to copy files into a stage (raw: every field still a string).
STAGE_REQUEST_RAW = _struct(
    ("request_id", _S), ("input_directory", _S), ("file_name", _S),
    ("internal_stage", _S), ("auto_compress", _S), ("source_compression", _S),
    ("parallel", _S))

# A queued load request waiting for its result.
PENDING = _struct(
    ("request_id", _S), ("pipe", _S), ("file", _S), ("attributes", ATTRIBUTES),
    ("queued_ms", _S), ("lineage_ms", _L), ("arrival_seq", _L))

# One load-history entry (one file load attempt or status update of a pipe).
HISTORY = T.StructType([
    T.StructField("pipe", _S), T.StructField("path", _S), T.StructField("status", _S),
    T.StructField("rows_parsed", _L), T.StructField("rows_loaded", _L),
    T.StructField("errors_seen", _L), T.StructField("first_error", _S),
    T.StructField("event_ts", T.TimestampType()), T.StructField("seq", _L)])

# The outcome of one load submission (kind null = accepted).
OUTCOME = _struct(("request_id", _S), ("pipe", _S), ("file", _S),
                  ("kind", _S), ("message", _S))

# A listed source file.
FILES = _struct(("dir", _S), ("name", _S), ("size", _L), ("mtime_ms", _L),
                ("md5", _S), ("header", T.BinaryType()))

# What a stage already holds.
MANIFEST = _struct(("stage", _S), ("target_name", _S), ("md5", _S))

# Load-history entry fields carried as the matched result of a pending row.
ENTRY_FIELDS = ("path", "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error")

# Fixed values (must match the reference's vocabulary).
AUTO_COMPRESS_VALUES = ("true", "false", "default")
SOURCE_COMPRESSION_VALUES = ("AUTO_DETECT", "GZIP", "BZ2", "BROTLI", "ZSTD", "DEFLATE",
                             "RAW_DEFLATE", "NONE", "default")
PARALLEL_DEFAULT = 4

# Route names (one output relationship per name).
STAGE_ROUTES = ("uploaded", "skipped", "failure")
SUBMIT_ROUTES = ("success", "retry", "failure")
AWAIT_ROUTES = ("loaded", "partially_loaded", "load_failure", "waiting", "unmatched")
