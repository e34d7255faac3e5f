"""Structured Streaming form of the await step (timer polling with loop-back).

Each micro-batch routes the newly arrived load requests *together with* the
rows still waiting after the previous batch, against the load-history table,
with the batch await operator (``operators.reconcile.await_results``).  So
the streaming path keeps every scale property of the batch one (balanced
joins under key skew, pushed-down history window).

What waits is kept in two kinds of folder below ``<out>``:

* ``waiting/batch=<id>/`` — the rows that batch ``id`` was the first to leave
  waiting, each with an identity of its own (``wait_id``);
* ``routes/batch=<id>/route=<route>/`` — the rows that batch ``id`` decided,
  with their identities.

The rows still waiting are those of the first kind without those of the
second, so a poll writes the rows whose state changed and nothing else,
however many rows wait.  ``COMPACT_EVERY`` batches after the last time, the rows
still waiting are written as one folder that replaces the older ones, and
decided identities before it are not read again; that bounds what a poll reads.
A mark below ``compacted/`` says which folders do; it is written after the
folder, so readers need not know how often a stream compacts, and the number
may change from one start to the next.

* exactly-once: a replayed batch overwrites its own folders;
* lineage-bounded: every batch starts from files in the shared output folder;
* skew-safe: no per-key state object ever holds a key's waiting rows.

Rows whose key never gets a terminal status keep waiting (no age test when an
entry is in progress), exactly as in the batch rules.

A timer is part of the stream: an empty tick row per poll period makes batches
run when no request arrives, so rows age (``ticks=False`` leaves it out, for
``availableNow`` runs over files).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ingestflow.operators.reconcile import await_results
from ingestflow.schemas import AWAIT_ROUTES, PENDING
from ingestflow.session import drop_table, materialize

DEFAULT_POLL = "10 seconds"
COMPACT_EVERY = 50
TICK = "__tick"


def processing_clock(batch: DataFrame, batch_id: int) -> _dt.datetime:
    """``now`` of a micro-batch: the wall clock (as the original poller uses)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def with_ticks(pending_stream: DataFrame, every_seconds: int = 10) -> DataFrame:
    """Union a timer stream (one empty tick row per period) into the request stream."""
    spark = pending_stream.sparkSession
    ticks = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
             .where(F.col("value") % every_seconds == 0))
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in pending_stream.schema.fields]
    ticks = ticks.select(*cols, F.lit(True).alias(TICK))
    return pending_stream.withColumn(TICK, F.lit(False)).unionByName(ticks)


WAIT_ID = T.StructField("wait_id", T.StringType())
STATE_SCHEMA = T.StructType([*PENDING.fields, WAIT_ID])
STATE = STATE_SCHEMA.names


class AwaitBatches:
    """``foreachBatch`` function routing each micro-batch plus the rows that still wait."""

    def __init__(self, history: Callable[[SparkSession], DataFrame], max_age_minutes: int,
                 out_dir: str, clock: Callable[[DataFrame, int], _dt.datetime] = processing_clock,
                 compact_every: int = COMPACT_EVERY, **await_kw):
        self.history = history
        self.max_age_minutes = max_age_minutes
        self.out_dir = out_dir.rstrip("/")
        self.clock = clock
        self.compact_every = compact_every
        self.await_kw = await_kw

    def _marks(self, spark: SparkSession):
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.out_dir}/compacted")
        return root, root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _base(self, spark: SparkSession, batch_id: int) -> int:
        """The last batch before ``batch_id`` whose waiting folder holds everything that waited."""
        root, fs = self._marks(spark)
        if not fs.exists(root):
            return 0
        marked = (int(s.getPath().getName().split("-")[1]) for s in fs.listStatus(root))
        return max((m for m in marked if m < batch_id), default=0)

    def _mark(self, spark: SparkSession, batch_id: int) -> None:
        root, fs = self._marks(spark)
        fs.mkdirs(root)
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, f"batch-{batch_id}"), True).close()

    def _since(self, spark: SparkSession, kind: str, first: int, upto: int,
               schema: T.StructType) -> DataFrame | None:
        """Rows of the folders of batches ``first`` to ``upto - 1``."""
        paths = [p for p in (f"{self.out_dir}/{kind}/batch={i}" for i in range(first, upto))
                 if _path_exists(spark, p)]
        reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(*paths) if paths else None

    def still_waiting(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The rows that wait when batch ``batch_id`` begins."""
        base = self._base(spark, batch_id)
        waiting = self._since(spark, "waiting", base, batch_id, STATE_SCHEMA)
        if waiting is None:
            return None
        # What a compacting batch decided is not in its own waiting folder.
        decided = self._since(spark, "routes", base + 1, batch_id, T.StructType([WAIT_ID]))
        return waiting if decided is None else waiting.join(decided, "wait_id", "left_anti")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if TICK in batch.columns:
            batch = batch.where(~F.col(TICK))
        arrivals = batch.select(*[F.col(f.name).cast(f.dataType) for f in PENDING.fields]).withColumn(
            "wait_id", F.concat(F.lit(f"{batch_id}-"), F.monotonically_increasing_id().cast("string")))
        before = self.still_waiting(spark, batch_id)
        new = F.lit(True).alias("__new")
        pending = arrivals.select(*STATE, new)
        if before is not None:
            pending = before.select(*STATE, F.lit(False).alias("__new")).unionByName(pending)
        now = self.clock(batch, batch_id)
        # The batch's input is used by several jobs: it is computed once.
        pending = materialize(pending, "await-batch")
        routed = materialize(await_results(pending, self.history(spark), self.max_age_minutes, now,
                                           **self.await_kw), "await-routed")
        compact = batch_id - self._base(spark, batch_id) >= self.compact_every
        waits = routed.where(F.col("route") == "waiting")
        (waits if compact else waits.where(F.col("__new"))).select(*STATE).write.mode("overwrite") \
            .parquet(f"{self.out_dir}/waiting/batch={batch_id}")
        if compact:
            self._mark(spark, batch_id)
        (routed.where(F.col("route") != "waiting").drop("__new")
         .withColumn("batch_now", F.lit(now.isoformat()))
         .write.mode("overwrite").partitionBy("route")
         .parquet(f"{self.out_dir}/routes/batch={batch_id}"))
        drop_table(pending)
        drop_table(routed)


def start_await_stream(pending_stream: DataFrame, history: Callable[[SparkSession], DataFrame],
                       max_age_minutes: int, out_dir: str, checkpoint: str,
                       trigger: dict | None = None, clock=processing_clock, ticks: bool = True,
                       every_seconds: int = 10, **await_kw) -> StreamingQuery:
    """Start the await stream; it polls every 10 seconds unless ``trigger`` says otherwise.

    The stream carries its own timer of ``every_seconds``; an ``availableNow``
    run over files ends by itself only with ``ticks=False``.
    """
    if ticks and TICK not in pending_stream.columns:
        pending_stream = with_ticks(pending_stream, every_seconds)
    fn = AwaitBatches(history, max_age_minutes, out_dir, clock, **await_kw)
    w = pending_stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": DEFAULT_POLL}))
    return w.start()


def read_decided(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every row that a batch decided, with its route and batch."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/routes")


def read_routes(spark: SparkSession, out_dir: str, compact_every: int | None = None) -> DataFrame:
    """Final routes: the decided rows of every batch, and the rows that still wait.

    The latter carry the pending columns alone, with route ``waiting``.
    ``compact_every`` is not needed: the compacted folders are marked.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/routes")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max((int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)
                if s.getPath().getName().startswith("batch=")), default=-1)
    reader = AwaitBatches(lambda s: None, 0, out_dir)
    waiting = reader.still_waiting(spark, last + 1)
    parts = []
    if any(_path_exists(spark, f"{out_dir.rstrip('/')}/routes/batch={i}/route={r}")
           for i in range(last + 1) for r in AWAIT_ROUTES):
        parts.append(read_decided(spark, out_dir))
    if waiting is not None:
        parts.append(waiting.withColumns({"route": F.lit("waiting"), "batch": F.lit(last)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
