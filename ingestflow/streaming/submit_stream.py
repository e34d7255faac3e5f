"""Structured Streaming form of the submission step: retried requests come back.

Each micro-batch submits the new load requests together with those that the
batch before sent to ``retry``, and classifies the outcomes.  Below ``<out>``

* ``decided/batch=<id>/route=<route>/`` holds the requests that batch ``id``
  decided (``success`` or ``failure``), with the number of their attempt;
* ``retry/batch=<id>/`` holds every request that is still to be retried after
  batch ``id``, with the number of its next attempt.

A request is in exactly one of them, so none is lost: one that the submission
returned no outcome for is retried.  A batch reads its predecessor's retry
folder and overwrites its own, so a replayed batch gives the same files for the
same outcomes; folders that no replay can need any more are deleted.
Submitting is repeated by a replay, as it is by every retry.

A timer (empty tick rows) lets batches run when no request arrives, so retries
go on; ``ticks=False`` leaves it out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ingestflow.operators.submit import classify_submission
from ingestflow.session import drop_table, materialize
from ingestflow.streaming.await_stream import DEFAULT_POLL, TICK, _path_exists, with_ticks

# Fixed value: the message of a request that the submission returned no outcome for.
NO_OUTCOME_TEXT = "no outcome"
STATE = [T.StructField("submit_id", T.StringType()), T.StructField("attempt", T.IntegerType())]


class SubmitBatches:
    """``foreachBatch`` function submitting each micro-batch plus the retried requests.

    ``submit`` takes the requests, with ``submit_id`` and ``attempt``, and
    returns ``submit_id, kind, message`` (one row a request at most).
    """

    def __init__(self, submit: Callable[[DataFrame], DataFrame], schema: T.StructType, out_dir: str):
        self.submit, self.schema, self.out_dir = submit, schema, out_dir.rstrip("/")

    def _retry(self, batch_id: int) -> str:
        return f"{self.out_dir}/retry/batch={batch_id}"

    def retried(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The requests that are to be retried when batch ``batch_id`` begins."""
        path = self._retry(batch_id - 1)
        schema = T.StructType([*self.schema.fields, *STATE])
        return spark.read.schema(schema).parquet(path) if _path_exists(spark, path) else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if TICK in batch.columns:
            batch = batch.where(~F.col(TICK))
        todo = batch.select(*self.schema.names).withColumns({
            "submit_id": F.concat(F.lit(f"{batch_id}-"), F.monotonically_increasing_id().cast("string")),
            "attempt": F.lit(1)})
        before = self.retried(spark, batch_id)
        todo = materialize(todo if before is None else todo.unionByName(before), "submit-batch")
        outcomes = self.submit(todo).select("submit_id", "kind", "message", F.lit(True).alias("__answered"))
        joined = todo.join(outcomes, "submit_id", "left")
        silent = F.col("__answered").isNull()
        joined = joined.withColumns({"kind": F.when(silent, "backoff").otherwise(F.col("kind")),
                                     "message": F.when(silent, NO_OUTCOME_TEXT).otherwise(F.col("message"))})
        routed = materialize(classify_submission(joined.drop("__answered")), "submit-routed")
        again = F.col("route") == "retry"
        (routed.where(again).withColumn("attempt", F.col("attempt") + 1).select(*todo.columns)
         .write.mode("overwrite").parquet(self._retry(batch_id)))
        (routed.where(~again).write.mode("overwrite").partitionBy("route")
         .parquet(f"{self.out_dir}/decided/batch={batch_id}"))
        drop_table(todo)
        drop_table(routed)
        # A replay of this batch reads the folder before; the one before that is done with.
        old = spark._jvm.org.apache.hadoop.fs.Path(self._retry(batch_id - 2))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def start_submit_stream(requests: DataFrame, submit: Callable[[DataFrame], DataFrame], out_dir: str,
                        checkpoint: str, trigger: dict | None = None, ticks: bool = True,
                        every_seconds: int = 10) -> StreamingQuery:
    """Start the submission stream; it polls every 10 seconds unless ``trigger`` says otherwise."""
    fn = SubmitBatches(submit, requests.schema, out_dir)
    if ticks:
        requests = with_ticks(requests, every_seconds)
    w = requests.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": DEFAULT_POLL})).start()


def read_submitted(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """Every request once: the decided ones, and on route ``retry`` those that are still retried.

    ``attempt`` is the number of the deciding, or of the next, attempt.
    """
    root = out_dir.rstrip("/")
    fields = [*schema.fields, *STATE]
    decided = spark.read.schema(T.StructType([
        *fields, *(T.StructField(c, T.StringType()) for c in ("kind", "message", "response_code", "error_message")),
        T.StructField("route", T.StringType()), T.StructField("batch", T.IntegerType())])).parquet(f"{root}/decided")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/retry")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max((int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path)), default=None)
    if last is None:
        return decided
    retried = spark.read.schema(T.StructType(fields)).parquet(f"{root}/retry/batch={last}")
    return decided.unionByName(retried.withColumn("route", F.lit("retry")), allowMissingColumns=True)
