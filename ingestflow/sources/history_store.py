"""Load history kept by pipe and day, read with partition pruning.

Entries are written below ``pipe_key=<pipe>/day=<date>``.  The data columns
keep the pipe and the time as they are; the two partition columns only say
where an entry lies (an empty or missing pipe name has a folder name of its
own, which Spark's partition values could not tell from null).

A trailing window of one pipe is pruned while planning.  For the pending pipes
the store is joined with their distinct names, and Spark prunes the folders at
run time by the names that the join's other side really holds (dynamic
partition pruning); the window's days are pruned by the look-back's scalar
subquery.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.functions.timing import to_datetime
from ingestflow.operators.history import distinct_pipes, in_window, window_start

PARTITIONS = [T.StructField("pipe_key", T.StringType()), T.StructField("day", T.DateType())]
NO_NAME = "__no_name__"
# Above this many pipe folders the pending pipes are joined by a shuffle, without a broadcast.
MAX_BROADCAST_PIPES = 100_000


def pipe_key(pipe: Column | str) -> Column:
    p = F.col(pipe) if isinstance(pipe, str) else pipe
    return F.when(F.coalesce(p, F.lit("")) == "", NO_NAME).otherwise(p)


def append_history(entries: DataFrame, path: str, ts_col: str = "event_ts") -> None:
    """Add entries to the store; Spark splits the folders of a pipe with much of the history."""
    placed = entries.withColumns({"pipe_key": pipe_key("pipe"), "day": F.to_date(ts_col)})
    (placed.hint("rebalance", "pipe_key", "day").sortWithinPartitions("pipe_key", "day", ts_col)
     .write.mode("append").partitionBy("pipe_key", "day").parquet(path))


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The store with its partition columns; ``schema`` is that of the entries."""
    return spark.read.schema(T.StructType([*schema.fields, *PARTITIONS])).parquet(path)


def _pipe_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the pipe folders: what the scan's own listing begins with."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = (s.getPath().getName() for s in fs.listStatus(root))
    return [unescape(n.split("=", 1)[1]) for n in names if n.startswith("pipe_key=")]


def _within(store: DataFrame, start, end, ts_col: str) -> DataFrame:
    first = start.cast("date") if isinstance(start, Column) else F.lit(start.date())
    days = F.col("day").isNull() | F.col("day").between(first, F.lit(to_datetime(end).date()))
    return in_window(store.where(days), start, end, ts_col)


def pipe_history(store: DataFrame, pipe: str, trailing_minutes: int, now, ts_col: str = "event_ts") -> DataFrame:
    """As ``operators.history.pipe_history``; reads the pipe's folders of the window's days alone."""
    end = to_datetime(now)
    start = end - _dt.timedelta(minutes=abs(int(trailing_minutes)))
    mine = store.where((F.col("pipe_key") == (pipe or NO_NAME)) & (F.col("pipe") == F.lit(pipe)))
    return _within(mine, start, end, ts_col).drop("pipe_key", "day")


def history_multi_pipe(store: DataFrame, path: str, pending: DataFrame, now,
                       ts_col: str = "event_ts") -> DataFrame:
    """As ``operators.history.history_multi_pipe``; reads the pending pipes' folders alone.

    The names of the pipe folders bound the distinct pending pipes that can
    match, so that side is broadcast while there are at most
    ``MAX_BROADCAST_PIPES`` folders.
    """
    folders = _pipe_folders(store.sparkSession, path)
    start = window_start(pending, now, store.schema[ts_col].dataType)
    held = _within(store, start, now, ts_col)
    pipes = distinct_pipes(pending).withColumn("pipe_key", pipe_key("pipe"))
    if len(folders) <= MAX_BROADCAST_PIPES:
        pipes = F.broadcast(pipes.where(F.col("pipe_key").isin(folders)))
    return held.join(pipes, ["pipe_key", "pipe"], "left_semi").select(
        *[c for c in store.columns if c not in ("pipe_key", "day")])
