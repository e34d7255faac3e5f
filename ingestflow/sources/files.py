"""Listing source directories and fingerprinting files.

Both steps run inside executors with ``mapInPandas`` over a filesystem
handle from ``pyarrow.fs`` (local paths, or any URI scheme pyarrow supports),
so neither the directory list nor the file list passes through the driver.

* ``list_files`` — one task per distinct directory (spread by hash), one row
  per regular file, zero-length files included; a missing directory yields
  no rows.  Rows are emitted in bounded chunks, so a directory with millions
  of entries never becomes one large frame.
* ``file_header`` — only the first bytes (for compression sniffing);
* ``file_digest`` — MD5 of the whole content plus its first bytes, read in
  fixed-size chunks.
  Both spread files over tasks by hash of their path, so one large directory
  is read by many tasks.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LISTING_SCHEMA = "dir string, name string, size bigint, mtime_ms bigint"
DIGEST_FIELDS = "md5 string, header binary"
HEADER_BYTES = 16
CHUNK_BYTES = 8 << 20
ROWS_PER_CHUNK = 10_000


def _filesystem(path: str):
    from pyarrow import fs as pafs
    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub("^file:(//)?", "", path)


def _list_dirs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs
    out: list[tuple] = []
    for pdf in batches:
        for d in pdf["dir"]:
            filesystem, path = _filesystem(d)
            sel = pafs.FileSelector(path, recursive=False, allow_not_found=True)
            for info in filesystem.get_file_info(sel):
                if info.type != pafs.FileType.File:
                    continue
                mtime = info.mtime_ns // 1_000_000 if info.mtime_ns is not None else None
                out.append((d, info.base_name, info.size, mtime))
                if len(out) >= ROWS_PER_CHUNK:
                    yield pd.DataFrame(out, columns=["dir", "name", "size", "mtime_ms"])
                    out = []
    if out:
        yield pd.DataFrame(out, columns=["dir", "name", "size", "mtime_ms"])


def list_files(dirs: DataFrame, dir_col: str = "dir", partitions: int | None = None) -> DataFrame:
    """Files directly inside each distinct directory of ``dirs[dir_col]``."""
    d = dirs.select(F.col(dir_col).alias("dir")).where(F.col("dir").isNotNull()).distinct()
    n = partitions or d.sparkSession.sparkContext.defaultParallelism
    return d.repartition(n, "dir").mapInPandas(_list_dirs, LISTING_SCHEMA)


def _digest_one(dir_: str, name: str) -> tuple[str | None, bytes | None]:
    filesystem, base = _filesystem(dir_)
    path = f"{base.rstrip('/')}/{name}"
    h = hashlib.md5()
    header = b""
    try:
        with filesystem.open_input_stream(path, compression=None) as f:
            while True:
                chunk = f.read(CHUNK_BYTES)
                if not chunk:
                    break
                if len(header) < HEADER_BYTES:
                    header += chunk[:HEADER_BYTES - len(header)]
                h.update(chunk)
    except (FileNotFoundError, OSError):
        return None, None
    return h.hexdigest(), header


def _header_one(dir_: str, name: str) -> bytes | None:
    filesystem, base = _filesystem(dir_)
    try:
        with filesystem.open_input_stream(f"{base.rstrip('/')}/{name}", compression=None) as f:
            return f.read(HEADER_BYTES)
    except (FileNotFoundError, OSError):
        return None


def _with_columns(files: DataFrame, fields: str, fn, partitions: int | None) -> DataFrame:
    cols = files.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = [fn(d, n) for d, n in zip(pdf["dir"], pdf["name"])]
            pdf = pdf.copy()
            for i, c in enumerate(names):
                pdf[c] = [r[i] for r in res]
            yield pdf[cols + names]

    n = partitions or files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(n, "dir", "name").mapInPandas(run, f"{schema}, {fields}")


def file_header(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """Add ``header`` (the first bytes of each file) to (dir, name) rows."""
    return _with_columns(files, "header binary", lambda d, n: (_header_one(d, n),), partitions)


def file_digest(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """Add ``md5`` (hex, whole content) and ``header`` (first bytes) to (dir, name) rows."""
    return _with_columns(files, DIGEST_FIELDS, _digest_one, partitions)


def file_sizes(paths: DataFrame, partitions: int | None = None) -> DataFrame:
    """``path, size`` of single files; the size is null where there is no such file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs
        for pdf in batches:
            sizes = []
            for p in pdf["path"]:
                filesystem, base = _filesystem(p)
                info = filesystem.get_file_info(base)
                sizes.append(info.size if info.type == pafs.FileType.File else None)
            yield pd.DataFrame({"path": pdf["path"], "size": pd.array(sizes, dtype="Int64")})

    n = partitions or paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(n, "path").mapInPandas(run, "path string, size bigint")


# Suffixes of compressed streams whose end can be checked.
CHECKED_SUFFIXES = (".gz", ".bz2", ".deflate", ".zst")


def _stream_error(path: str) -> str | None:
    """Why a compressed stream cannot be read to its end; null where it can, or for other files."""
    import bz2
    import zlib
    if path.endswith(".zst"):
        try:
            import zstandard
        except ImportError:
            return None
        make, failures = (lambda: zstandard.ZstdDecompressor().decompressobj()), (zstandard.ZstdError,)
    elif path.endswith(".bz2"):
        make, failures = bz2.BZ2Decompressor, (OSError, ValueError)
    else:
        make, failures = (lambda: zlib.decompressobj(31 if path.endswith(".gz") else 15)), (zlib.error,)
    filesystem, base = _filesystem(path)
    try:
        with filesystem.open_input_stream(base, compression=None) as f:
            stream, left, fresh = make(), b"", True
            while chunk := left + f.read(CHUNK_BYTES >> 3):
                stream.decompress(chunk)
                fresh, left = False, b""
                if stream.eof:  # another member may follow
                    left, stream, fresh = stream.unused_data, make(), True
        return None if fresh else "the stream ends too early"
    except failures as e:
        return str(e) or type(e).__name__
    except OSError as e:
        return str(e)


def _rows_promised(path: str, fmt: str) -> int | None:
    """The rows that a columnar file's footer promises; null where there is none to read."""
    filesystem, base = _filesystem(path)
    try:
        with filesystem.open_input_file(base) as f:
            if fmt == "parquet":
                import pyarrow.parquet as pq
                return pq.read_metadata(f).num_rows
            import pyarrow.orc as orc
            return orc.ORCFile(f).nrows
    except Exception:  # whatever the library says of a damaged footer: the file is judged by what was read
        return None


def file_damage(paths: DataFrame, fmt: str, partitions: int | None = None) -> DataFrame:
    """``path, damage, promised``: why a compressed stream breaks off, and a footer's rows.

    Streams are read in chunks, spread over tasks by hash of their path.
    """
    columnar = fmt in ("parquet", "orc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "path": pdf["path"],
                "damage": pd.Series([_stream_error(p) if p.endswith(CHECKED_SUFFIXES) and not columnar else None
                                     for p in pdf["path"]], dtype=object),
                "promised": pd.array([_rows_promised(p, fmt) if columnar else None for p in pdf["path"]],
                                     dtype="Int64")})

    n = partitions or paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(n, "path").mapInPandas(
        run, "path string, damage string, promised bigint")


def visible_copies(paths: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """``path, raw``: copies below ``folder`` of files that Spark's readers pass over for their names.

    A copy's name is the path's digest and the suffixes that name its format; it
    is written under a temporary name first, so a retry leaves nothing in part.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, out_base = _filesystem(folder)
        for pdf in batches:
            raws = []
            for p in pdf["path"]:
                filesystem, base = _filesystem(p)
                name = base.rsplit("/", 1)[-1].lstrip("._")
                suffix = name[name.index("."):] if "." in name else ""
                target = f"{out_base.rstrip('/')}/{hashlib.sha1(p.encode()).hexdigest()}{suffix}"
                out_fs.create_dir(out_base, recursive=True)
                part = f"{target}.{uuid.uuid4().hex}._COPYING_"
                with filesystem.open_input_stream(base, compression=None) as f, \
                        out_fs.open_output_stream(part, compression=None) as g:
                    while chunk := f.read(CHUNK_BYTES):
                        g.write(chunk)
                out_fs.move(part, target)
                raws.append(f"{folder.rstrip('/')}/{target.rsplit('/', 1)[-1]}")
            yield pd.DataFrame({"path": pdf["path"], "raw": raws})

    n = partitions or paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(n, "path").mapInPandas(run, "path string, raw string")
