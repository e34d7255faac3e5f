"""The whole pipeline as one stream: stage results are submitted, loaded and awaited.

One micro-batch job chains the steps.  For batch ``id``, below ``<out>``:

* ``submitted/batch=<id>/`` — the uploaded files of the batch, classified (a
  file for a pipe that is not defined fails);
* ``rows/<pipe>/batch=<id>/`` — target rows of the files that the batch loads
  (files that an earlier batch loaded are not loaded again);
* ``history/batch=<id>/`` — their load-history entries, numbered by the batch;
* ``await/`` — the waiting and decided requests, kept as ``AwaitBatches`` does.

Every step reads what earlier batches wrote and overwrites the batch's own
folders, and the batch's time is written before anything else and read by a
replay, so a replayed batch leaves the same outputs, wherever it was cut short.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ingestflow.functions.timing import epoch_ms, to_datetime
from ingestflow.operators import submit
from ingestflow.operators.load import PipeSpec
from ingestflow.plans.flow import load_step
from ingestflow.schemas import ATTRIBUTES, HISTORY
from ingestflow.streaming.await_stream import (DEFAULT_POLL, TICK, AwaitBatches, _path_exists, processing_clock,
                                               with_ticks)

_S = T.StringType()
# An uploaded file of a stage step: which pipe is to load it.
RESULT = T.StructType([T.StructField("request_id", _S), T.StructField("pipe", _S), T.StructField("file", _S),
                       T.StructField("attributes", ATTRIBUTES)])


class FlowBatches:
    """``foreachBatch`` function running submit, load and await over each micro-batch."""

    def __init__(self, specs: list[PipeSpec], stage_root: str, max_age_minutes: int, out_dir: str,
                 clock: Callable[[DataFrame, int], _dt.datetime] = processing_clock, **await_kw):
        self.specs, self.stage_root, self.out_dir, self.clock = specs, stage_root, out_dir.rstrip("/"), clock
        self.max_age_minutes, self.await_kw = max_age_minutes, await_kw

    def _now(self, batch: DataFrame, batch_id: int) -> _dt.datetime:
        """The time of the batch: that of its first run."""
        spark, path = batch.sparkSession, f"{self.out_dir}/clock/batch={batch_id}"
        if not _path_exists(spark, f"{path}/_SUCCESS"):
            spark.range(1).select(F.lit(epoch_ms(self.clock(batch, batch_id))).cast("long").alias("now_ms")) \
                .write.mode("overwrite").parquet(path)
        return to_datetime(spark.read.parquet(path).first().now_ms)

    def _history(self, spark: SparkSession, upto: int) -> DataFrame:
        """Entries of the batches before ``upto``."""
        if not _path_exists(spark, f"{self.out_dir}/history"):
            return spark.createDataFrame([], HISTORY)
        schema = T.StructType([*HISTORY.fields, T.StructField("batch", T.LongType())])
        return spark.read.schema(schema).parquet(f"{self.out_dir}/history").where(F.col("batch") < upto).drop("batch")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, self.out_dir
        if TICK in batch.columns:
            batch = batch.where(~F.col(TICK))
        now = self._now(batch, batch_id)
        defined = F.coalesce(F.col("pipe").isin([s.name for s in self.specs]), F.lit(False))
        submit.classify_submission(batch.select(*RESULT.names).withColumns({
            "kind": F.when(~defined, "other"),
            "message": F.when(~defined, F.concat(F.lit("pipe is not defined: "), F.coalesce("pipe", F.lit(""))))})) \
            .withColumn("arrival_seq", F.monotonically_increasing_id()) \
            .write.mode("overwrite").parquet(f"{out}/submitted/batch={batch_id}")
        accepted = spark.read.parquet(f"{out}/submitted/batch={batch_id}").where(F.col("route") == "success")
        earlier = self._history(spark, batch_id)
        rows, entries = load_step(spark, self.specs, self.stage_root, now,
                                  accepted.select("pipe", "file").distinct(), earlier, run=batch_id + 1)
        for pipe, loaded in rows.items():
            loaded.write.mode("overwrite").parquet(f"{out}/rows/{pipe}/batch={batch_id}")
        entries.select(*[F.col(f.name).cast(f.dataType) for f in HISTORY.fields]) \
            .write.mode("overwrite").parquet(f"{out}/history/batch={batch_id}")
        pending = accepted.select(
            "request_id", "pipe", "file", "attributes", F.lit(str(epoch_ms(now))).alias("queued_ms"),
            F.lit(epoch_ms(now)).cast("long").alias("lineage_ms"),
            (F.lit(batch_id).cast("long") * F.lit(1 << 40) + F.col("arrival_seq") % F.lit(1 << 40)).alias("arrival_seq"))
        AwaitBatches(lambda s: self._history(s, batch_id + 1), self.max_age_minutes, f"{out}/await",
                     lambda b, i: now, **self.await_kw)(pending, batch_id)


def start_flow_stream(results: DataFrame, specs: list[PipeSpec], stage_root: str, max_age_minutes: int,
                      out_dir: str, checkpoint: str, trigger: dict | None = None, ticks: bool = True,
                      every_seconds: int = 10, clock=processing_clock, **await_kw) -> StreamingQuery:
    """Start the pipeline over a stream of uploaded files (``RESULT``).

    A timer lets batches run when nothing arrives, so waiting requests age;
    ``ticks=False`` leaves it out.
    """
    if ticks:
        results = with_ticks(results, every_seconds)
    fn = FlowBatches(specs, stage_root, max_age_minutes, out_dir, clock, **await_kw)
    w = results.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": DEFAULT_POLL})).start()
