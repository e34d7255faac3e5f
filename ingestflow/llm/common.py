"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ingestflow.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local sessions without one get their own."""
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if spark.conf.get("spark.checkpoint.dir", None) or not local:
        return ensure_checkpoint_dir(spark)
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="ingestflow-"))


class Workspace:
    """Written intermediate tables of one job, in the shared folder.

    Writing a table cuts the lineage: a lost executor costs a re-run of its
    tasks, never of the stages before the table.  ``drop`` removes tables
    that nothing will read again.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/ingestflow-llm/{name}-{uuid.uuid4().hex}"
        self._paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


Held = TypeVar("Held")
_held: list = []


def worker_state(kind: str, key, make: Callable[[], Held]) -> Held:
    """The model or cache that a Python worker holds between batches and tasks.

    A worker holds one at a time: workers are used again by later stages, and
    what an earlier operator left there would add to every later one's.
    """
    if not _held or _held[:2] != [kind, key]:
        _held.clear()
        gc.collect()
        try:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)  # give freed memory back, where the C library can
        except (AttributeError, OSError):
            pass
        _held.extend((kind, key, make()))
    return _held[2]


BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Let Arrow batches hold ``rows`` rows and ``size`` bytes at most; smaller limits of the session stay.

    Rows of texts are wide, those of an index wider, and a batch is held by the
    JVM and by Python, on its way in and on its way out.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(name).rstrip("bB")
        # A size with a unit was set by hand.
        if held.lstrip("-").isdigit() and not 0 < int(held) <= most:
            spark.conf.set(name, str(most))


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """A written table of narrow keys, to be broadcast if it has ``BROADCAST_ROWS`` at most.

    Beyond that it is joined like any other table, by a shuffle.
    """
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def hash_sample(rows: DataFrame, group: str, size: int, hash_col: str) -> list[Row]:
    """Of each ``group``, the rows with the ``size`` smallest hashes, one row a hash.

    Different hashes are counted first; then only rows below a hash that lets
    about four times ``size`` of them through leave their tasks, one row a hash
    and task, so what is shuffled does not grow with the table, whatever its
    copies.  A group of which too few came through is drawn again below a
    higher hash.  ``group`` must have few values (one count of each comes to
    the driver); hashes must be spread over all 64-bit integers.
    """
    counts = rows.groupBy(group).agg(F.approx_count_distinct(hash_col)).collect()
    shares = {value: min(1.0, 4 * size / max(1, n)) for value, n in counts}
    others = [c for c in rows.columns if c not in (group, hash_col)]
    first = Window.partitionBy(group).orderBy(hash_col)
    out: list[Row] = []
    while shares:
        below = F.lit(False)
        for value, share in shares.items():
            limit = min(2 ** 63 - 1, -2 ** 63 + int(2 ** 64 * share))
            # The hash first: the group may be costly to tell.
            below = below | ((F.col(hash_col) <= F.lit(limit)) & F.col(group).eqNullSafe(F.lit(value)))
        kept = rows.where(below).groupBy(group, hash_col).agg(F.min(F.struct(*others)).alias("__row")) \
            .withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= size) \
            .select(group, hash_col, "__row.*").collect()
        found = Counter(r[group] for r in kept)
        shares = {value: min(1.0, 8 * share) for value, share in shares.items()
                  if share < 1 and found[value] < size}
        out += [r for r in kept if r[group] not in shares]
    return out
