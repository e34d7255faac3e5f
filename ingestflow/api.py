"""Step configurations in the shape users of a processor-based flow know.

Each class holds the step's properties.  A property may reference an event's
attributes with ``${name}`` and is resolved per row from the ``attributes``
map column.  ``run`` hands the resolved rows to the engine's DataFrame
operators.  Nothing here computes anything itself.

    StageFiles    input directory, file name (``*``/``?``), stage, auto-compress,
                  source compression, parallel          → stage_step
    SubmitLoads   pipe, file (default ``${filename}``)  → load requests + outcome routes
    HistoryReport pipe, trailing minutes                → report entries / JSON lines
    AwaitResults  pipe, file name, max file age          → five routes
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.functions.template import resolve_template
from ingestflow.operators import history as hist
from ingestflow.operators import reconcile, submit
from ingestflow.plans import flow

# Attribute under which a waiting event keeps its first-queued time (epoch ms).
QUEUED_ATTRIBUTE = "queued_timestamp"


def _prop(template: str | None, attributes: str = "attributes"):
    return resolve_template(template, attributes)


@dataclasses.dataclass(frozen=True)
class StageFiles:
    input_directory: str
    file_name: str
    internal_stage: str
    auto_compress: str = "default"
    source_compression: str = "default"
    parallel: str = "4"

    def requests(self, events: DataFrame, id_col: str = "request_id") -> DataFrame:
        """One raw stage request per event, every property resolved from its attributes.

        The attributes go along: every result of the step inherits them.
        """
        return events.select(
            "attributes",
            F.col(id_col).cast("string").alias("request_id"),
            _prop(self.input_directory).alias("input_directory"),
            _prop(self.file_name).alias("file_name"),
            _prop(self.internal_stage).alias("internal_stage"),
            _prop(self.auto_compress).alias("auto_compress"),
            _prop(self.source_compression).alias("source_compression"),
            _prop(self.parallel).alias("parallel"))

    def run(self, events: DataFrame, manifest: DataFrame, stage_root: str,
            parallel: int | None = None) -> DataFrame:
        """Routed stage results; the files are copied when this is called."""
        return flow.stage_step(self.requests(events), manifest, stage_root, parallel)


@dataclasses.dataclass(frozen=True)
class SubmitLoads:
    pipe: str
    file: str = submit.DEFAULT_FILE_TEMPLATE

    def requests(self, events: DataFrame) -> DataFrame:
        return submit.load_requests(events, self.pipe, self.file)

    def classify(self, outcomes: DataFrame) -> DataFrame:
        return submit.classify_submission(outcomes)


@dataclasses.dataclass(frozen=True)
class HistoryReport:
    pipe: str                      # a literal name (not resolved per event)
    trailing_minutes: int = 60

    def run(self, history: DataFrame, now) -> DataFrame:
        return hist.pipe_history(history, self.pipe, self.trailing_minutes, now)

    def write(self, history: DataFrame, now, path: str) -> bool:
        """Write the report as JSON lines; nothing is written for an empty window."""
        return hist.write_history_document(self.run(history, now), path)


@dataclasses.dataclass(frozen=True)
class AwaitResults:
    pipe: str | None = "${pipe}"
    file_name: str | None = "${filename}"
    max_file_age_minutes: int = 60

    def pending(self, events: DataFrame, id_col: str = "request_id",
                lineage_col: str = "lineage_ms", order_col: str = "arrival_seq") -> DataFrame:
        """Pending rows from events: keys resolved, stamp taken from the attributes.

        An unset property gives a null key (routed to ``load_failure``); a
        template naming a missing attribute gives an empty string, as an
        attribute expression would.
        """
        return events.select(
            F.col(id_col).cast("string").alias("request_id"),
            _prop(self.pipe).alias("pipe"),
            _prop(self.file_name).alias("file"),
            F.col("attributes"),
            F.col("attributes").getItem(QUEUED_ATTRIBUTE).alias("queued_ms"),
            F.col(lineage_col).cast("long").alias("lineage_ms"),
            F.col(order_col).cast("long").alias("arrival_seq"))

    def run(self, events: DataFrame, history: DataFrame, now, **kw) -> DataFrame:
        """Route every event; the stamp goes back into the attributes for the next poll."""
        routed = reconcile.await_results(self.pending(events), history,
                                         self.max_file_age_minutes, now, **kw)
        stamped = F.map_filter("attributes", lambda k, v: k != QUEUED_ATTRIBUTE)
        stamped = F.when(F.col("queued_ms").isNull(), stamped).otherwise(
            F.map_concat(stamped, F.create_map(F.lit(QUEUED_ATTRIBUTE), F.col("queued_ms"))))
        return routed.withColumn("attributes", stamped)
