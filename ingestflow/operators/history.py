"""Load-history scans, windows, latest entry per file and report documents."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.functions.timing import MS_PER_MINUTE, epoch_ms, minutes_between, to_datetime, ts_literal

# The widest look-back, some 4,000 years: minutes are counted as a 32-bit integer.
MAX_LOOKBACK_MINUTES = (1 << 31) - 1


def _ts_col(history: DataFrame, ts_col: str):
    return history.schema[ts_col].dataType


def in_window(history: DataFrame, start, end, ts_col: str = "event_ts") -> DataFrame:
    """Entries with ``start <= ts <= end``; bounds are datetimes or Columns.

    Literal bounds are typed like the column so the predicate reaches the
    Parquet scan as ``PushedFilters``.
    """
    dtype = _ts_col(history, ts_col)
    lo = start if isinstance(start, Column) else ts_literal(start, dtype)
    hi = end if isinstance(end, Column) else ts_literal(end, dtype)
    return history.where((F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))


def pipe_history(history: DataFrame, pipe: str, trailing_minutes: int, now,
                 ts_col: str = "event_ts") -> DataFrame:
    """History of one pipe over ``[now - |trailing_minutes|, now]``.

    A negative width is accepted and means the same window (absolute value).
    The pipe is a literal, as in a report definition.
    """
    now_dt = to_datetime(now)
    start = now_dt - _dt.timedelta(minutes=abs(int(trailing_minutes)))
    return in_window(history.where(F.col("pipe") == F.lit(pipe)), start, now_dt, ts_col)


def keyed(pending: DataFrame) -> DataFrame:
    """Pending rows that carry both a pipe and a file name."""
    return pending.where(F.col("pipe").isNotNull() & F.col("file").isNotNull())


def lookback_minutes(pending: DataFrame, now) -> DataFrame:
    """One row: ``max(1, max over keyed rows of whole minutes since lineage start)``.

    Ages beyond a long take no part.
    """
    now_ms = epoch_ms(now)
    age = minutes_between(now_ms, F.col("lineage_ms"))
    return keyed(pending).agg(
        F.greatest(F.lit(1).cast("long"), F.coalesce(F.max(age), F.lit(1).cast("long")))
        .alias("lookback_minutes"))


def distinct_pipes(pending: DataFrame) -> DataFrame:
    """Distinct pipe names of keyed pending rows."""
    return keyed(pending).select("pipe").distinct()


def history_for_pending(history: DataFrame, pending: DataFrame, salts: int = 1) -> DataFrame:
    """History entries whose (pipe, path) is a key of some keyed pending row.

    A plain semi-join: one scan of each side, and where the pending side is
    small next to the history Spark tests its keys' Bloom filter at the history
    scan, before any shuffle.  Spark splits the partition of a key with much of
    the history; with ``salts`` every key is split over that many tasks from
    the start (the distinct pending keys are repeated, no entry is).
    """
    keys = keyed(pending).select("pipe", F.col("file").alias("path"))
    if salts <= 1:
        return history.join(keys, ["pipe", "path"], "left_semi").select(*history.columns)
    spread = [c for c in ("seq", "event_ts", "status") if c in history.columns]
    salted = history.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    every = keys.distinct().withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, ["pipe", "path", "__salt"], "left_semi").select(*history.columns)


def window_start(pending: DataFrame, now, dtype: T.DataType) -> Column:
    """Where the look-back window begins, as a scalar subquery over the pending rows.

    The subquery runs with the query that reads the history, and its value is
    a plain bound to the scan; nothing runs while the plan is built.
    """
    now_ms = epoch_ms(now)
    age = minutes_between(now_ms, F.col("lineage_ms"))
    minutes = F.least(F.lit(MAX_LOOKBACK_MINUTES).cast("long"), F.greatest(
        F.lit(1).cast("long"), F.coalesce(F.max(age), F.lit(1).cast("long"))))
    start = F.timestamp_millis(F.lit(now_ms).cast("long") - minutes * MS_PER_MINUTE)
    return keyed(pending).agg(start.cast(dtype).alias("start")).scalar()


def history_multi_pipe(history: DataFrame, pending: DataFrame, now,
                       ts_col: str = "event_ts", prune_pipes: bool = True) -> DataFrame:
    """History of every pending pipe over the window set by the oldest pending row.

    The window bounds reach the Parquet scan, the lower one as the value of a
    scalar subquery; the pipes are a semi-join with the distinct pending ones,
    whose build side Spark broadcasts only when it measures it as small, and
    whose skewed partitions (a pipe with most of the history) it splits
    otherwise.  A history kept by ``sources.history_store`` is pruned by pipe and day.
    """
    h = in_window(history, window_start(pending, now, _ts_col(history, ts_col)), to_datetime(now), ts_col)
    return h.join(distinct_pipes(pending), "pipe", "left_semi").select(*history.columns) \
        if prune_pipes else h


def latest_per_file(history: DataFrame, keys: Sequence[str] = ("pipe", "path"),
                    order: str = "seq") -> DataFrame:
    """The entry with the highest ``order`` per key (a later entry overwrites).

    ``max_by`` aggregates partially on the map side, so a file with many
    status updates costs one row per map task in the shuffle.
    """
    keys = list(keys)
    rest = [c for c in history.columns if c not in keys]
    agg = history.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col(order)).alias("__e"))
    return agg.select(*keys, *[F.col("__e")[c].alias(c) for c in rest])


def history_document(entries: DataFrame, order: str = "seq") -> DataFrame:
    """The report as JSON, one element per row (ordered by ``order`` when written).

    Null fields are omitted, as the original report serialiser does.  The
    elements are not gathered into one value: writing them as JSON lines
    keeps the report distributed however long the window is.
    """
    cols = [c for c in entries.columns]
    return entries.select(F.col(order), F.to_json(F.struct(*cols)).alias("json"))


def write_history_document(entries: DataFrame, path: str, order: str = "seq") -> bool:
    """Write the report (JSON lines) only when the window holds any entry.

    The parts are ranges of ``order``, sorted: read in the order of their names
    they are the report in order, however many tasks wrote it.
    """
    if entries.isEmpty():
        return False
    by = [F.col(order).asc_nulls_first(), F.col("json")]
    (history_document(entries, order).repartitionByRange(*by).sortWithinPartitions(*by).select("json")
     .write.mode("overwrite").text(path))
    return True


LATEST_BUCKETS = 64


def update_latest(entries: DataFrame, path: str, buckets: int = LATEST_BUCKETS) -> None:
    """Bring the table of latest entries at ``path`` up to date with newly appended ``entries``.

    The table has one row per (pipe, path), in ``buckets`` partitions by a hash
    of the key.  Only buckets that the new entries touch are read and written
    again (dynamic partition overwrite); the files of the others stay.  Merging
    entries that were merged before changes nothing, so a run that was cut
    short is simply repeated.  A table keeps its number of buckets: pass the same.
    """
    from ingestflow.session import drop_table, materialize

    spark = entries.sparkSession
    new = materialize(entries.withColumn("bucket", F.pmod(F.xxhash64("pipe", "path"), F.lit(buckets)).cast("int")),
                      "latest-new")
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
    if touched:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        held = new
        if hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
            held = held.unionByName(spark.read.schema(new.schema).parquet(path)
                                    .where(F.col("bucket").isin(touched)))
        merged = materialize(latest_per_file(held, ("pipe", "path", "bucket")), "latest-merged")
        (merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(path))
        drop_table(merged)
    drop_table(new)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of every (pipe, path)."""
    return spark.read.parquet(path).drop("bucket")
