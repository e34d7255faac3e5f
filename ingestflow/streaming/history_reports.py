"""Scheduled history reports: one report per timer tick (every 5 minutes by default).

The report step has no input of its own; a rate source is the timer.  Each
micro-batch computes the pipe's history over the trailing window ending at
the batch's clock and writes it as JSON lines to ``<out>/batch=<id>/`` only
when the window holds any entry (a replayed batch overwrites its own folder).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ingestflow.operators.history import pipe_history, write_history_document
from ingestflow.streaming.await_stream import processing_clock

DEFAULT_REPORT_PERIOD = "5 minutes"


class ReportBatches:
    """``foreachBatch`` function writing one report per tick."""

    def __init__(self, history: Callable[[SparkSession], DataFrame], pipe: str,
                 trailing_minutes: int, out_dir: str,
                 clock: Callable[[DataFrame, int], _dt.datetime] = processing_clock):
        self.history, self.pipe, self.trailing = history, pipe, trailing_minutes
        self.out_dir, self.clock = out_dir.rstrip("/"), clock

    def __call__(self, ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        now = self.clock(ticks, batch_id)
        entries = pipe_history(self.history(spark), self.pipe, self.trailing, now)
        write_history_document(entries, f"{self.out_dir}/batch={batch_id}")


def start_history_reports(spark: SparkSession, history: Callable[[SparkSession], DataFrame],
                          pipe: str, trailing_minutes: int, out_dir: str, checkpoint: str,
                          period: str = DEFAULT_REPORT_PERIOD,
                          clock=processing_clock) -> StreamingQuery:
    """Start the timer-driven report stream (one rate row per period drives a batch)."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    fn = ReportBatches(history, pipe, trailing_minutes, out_dir, clock)
    return (ticks.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(processingTime=period).start())
