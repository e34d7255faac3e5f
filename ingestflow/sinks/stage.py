"""Copying planned files into a stage folder (the upload step).

Each executor task copies its share of the plan: the content is streamed in
chunks (gzip-compressed on the way when the target compression asks for it)
to a temporary name next to the target, then renamed into place.  A retried
or speculative task therefore never leaves a partial file under the target
name, and the target name depends only on the input row, so a retry writes
the same file again.  A failure is reported on that file's row (status
``FAILED`` with the error text); it does not stop the other files.
"""

from __future__ import annotations

import gzip
import hashlib
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.sources.files import CHUNK_BYTES, _filesystem

RESULT_FIELDS = ("source_filename string, target_filename string, source_size bigint, "
                 "target_size bigint, source_compression string, target_compression string, "
                 "status string, encryption string, message string")
TIMING_FIELDS = "url string, start_ms bigint, end_ms bigint"


def target_name(name_col: str = "name", target_compression: str = "target_compression",
                source_compression: str = "source_compression"):
    """Staged file name: ``.gz`` appended when the copy compresses the file."""
    compress = (F.col(target_compression) == "GZIP") & (F.col(source_compression) == "NONE")
    return F.when(compress, F.concat(F.col(name_col), F.lit(".gz"))).otherwise(F.col(name_col))


def _copy_one(src_dir, name, stage_dir, target, compress):
    src_fs, src_base = _filesystem(src_dir)
    dst_fs, dst_base = _filesystem(stage_dir)
    src = f"{src_base.rstrip('/')}/{name}"
    dst = f"{dst_base.rstrip('/')}/{target}"
    tmp = f"{dst_base.rstrip('/')}/.{target}.{uuid.uuid4().hex}.tmp"
    dst_fs.create_dir(dst_base.rstrip("/"), recursive=True)
    h = hashlib.md5()
    with src_fs.open_input_stream(src, compression=None) as fin, \
            dst_fs.open_output_stream(tmp, compression=None) as raw:
        out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if compress else raw
        try:
            while True:
                chunk = fin.read(CHUNK_BYTES)
                if not chunk:
                    break
                h.update(chunk)
                out.write(chunk)
        finally:
            if compress:
                out.close()
    dst_fs.move(tmp, dst)
    return dst_fs.get_file_info(dst).size, h.hexdigest()


def copy_to_stage(plan: DataFrame, stage_root: str, parallel: int | None = None) -> DataFrame:
    """Copy ``UPLOADED``-planned rows into ``stage_root/<stage>/``; returns stage results.

    ``plan`` needs request_id, dir, name, size, stage, target_name,
    source_compression, target_compression and status (``UPLOADED`` or
    ``SKIPPED``); ``md5`` (when present) is passed through, and for copied
    files it is the MD5 of the source bytes, computed during the copy.  ``parallel`` is the
    number of copy tasks (files are spread over them by hash of their target).
    Each result says where the file went and from when to when it was copied
    (``url, start_ms, end_ms``).  A row of another status (``message`` says
    why) is passed through.  The copies happen when the result is computed:
    write it once (as ``stage_step`` does) and use the written rows.
    """
    cols = ["request_id", "dir", "name", "size", "stage", "target_name", "source_compression",
            "target_compression", "status"]
    optional = [F.col(c) if c in plan.columns else F.lit(None).cast("string").alias(c)
                for c in ("md5", "message")]
    p = plan.select(*cols, *optional)
    n = parallel or p.sparkSession.sparkContext.defaultParallelism
    root = stage_root.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                status, message, tsize, md5 = r.status, r.message or "", None, r.md5
                started = time.time_ns() // 1_000_000
                compress = r.target_compression == "GZIP" and r.source_compression == "NONE"
                if status == "UPLOADED":
                    try:
                        tsize, md5 = _copy_one(r.dir, r.name, f"{root}/{r.stage}",
                                               r.target_name, compress)
                    except Exception as e:  # per-file failure, reported on its row
                        status, message = "FAILED", f"{type(e).__name__}: {e}"
                rows.append((r.request_id, f"{r.dir.rstrip('/')}/{r.name}", r.target_name,
                             r.size, tsize, r.source_compression, r.target_compression,
                             status, "NONE", message, md5, f"{root}/{r.stage}", started,
                             time.time_ns() // 1_000_000))
            yield pd.DataFrame(rows, columns=[
                "request_id", "source_filename", "target_filename", "source_size",
                "target_size", "source_compression", "target_compression", "status",
                "encryption", "message", "md5", "url", "start_ms", "end_ms"])

    return p.repartition(n, "stage", "target_name").mapInPandas(
        run, f"request_id string, {RESULT_FIELDS}, md5 string, {TIMING_FIELDS}")
