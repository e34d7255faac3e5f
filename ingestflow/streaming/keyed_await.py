"""The await step as keyed state: rows wait in per-key state, timers end the wait.

Requests and history entries are two streams; both are keyed by (pipe, file)
and meet in one ``transformWithState`` operator.  Each key holds

* ``rows`` — the waiting requests, a list that is appended to and never
  rewritten while they wait;
* ``first`` and ``oldest`` — the order and stamp of the first of them, and the
  oldest lineage start;
* ``entry`` — the latest history entry, kept after its rows are decided since a
  result may come before its request; with ``entry_ttl_minutes`` it expires.

A key's rows are decided together, by the rules of ``operators.reconcile``:
when an entry says so, or when a processing-time timer finds the first of them
older than ``max_age_minutes`` (strictly, in whole minutes).  An entry in
progress stops the timer.  Timers fire without any arrival: Spark runs the
operator's batches as long as the query runs.

**Hot keys.**  A key's state lives in one task.  ``salts`` splits the rows of
keys that ``hot`` marks: each request waits in the state of one salt, and every
salt learns the entries and, as narrow rows, the stamps of all the key's
requests, so all salts take the same decision at the same batch.

Where this differs from the polling form: an entry counts if it is not older
than the oldest lineage start of the *key's* waiting rows (and one minute at
least), not of all pending rows; the start is not floored to whole minutes,
which in the polling form only delays a match.  Rows that fail for their stamp
carry neither an age nor a status nor a payload.

Needs the RocksDB state store (``STATE_CONF``).  With
``spark.python.unix.domain.socket.enabled`` the state calls use a socket file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ingestflow.functions.timing import MS_PER_MINUTE, col_epoch_ms, queue_age, stamp_is_valid
from ingestflow.operators.reconcile import (ERROR_STATUSES, INVALID_STAMP_TEXT, MISSING_ATTRIBUTE_TEXT,
                                            OUTPUT_EXTRA)
from ingestflow.schemas import ENTRY_FIELDS, PENDING

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
DEFAULT_POLL = "10 seconds"
ROWS_PER_FRAME = 10_000

# Long values travel as text: frames would turn nullable ones into doubles.
_REQUEST = ("request_id", "attributes", "queued_ms", "lineage_ms", "arrival_seq")
_ENTRY = ("status", "first_error", "errors_seen", "payload", "seq", "event_ms")
_OUT = T.StructType([T.StructField(c, T.StringType()) for c in (
    "request_id", "pipe", "file", "attributes", "queued_ms", "lineage_ms", "arrival_seq", "age_minutes",
    "route", "status", "error", "error_count", "payload")])


def _text(names) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


class KeyedAwait(StatefulProcessor):
    """State and timers of one (pipe, file, salt)."""

    def __init__(self, max_age_minutes: int, entry_ttl_minutes: int | None = None):
        self.max_age_minutes = max_age_minutes
        self.entry_ttl_ms = entry_ttl_minutes * MS_PER_MINUTE if entry_ttl_minutes else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", _text(_REQUEST))
        self.first = handle.getValueState("first", "no_seq boolean, seq long, queued_ms long")
        self.oldest = handle.getValueState("oldest", "lineage_ms long")
        self.entry = handle.getValueState("entry", _text(_ENTRY), self.entry_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        first = self.first.get() if self.first.exists() else None
        oldest = self.oldest.get()[0] if self.oldest.exists() else None
        entry = self.entry.get() if self.entry.exists() else None
        new_entry = False
        for frame in rows:
            frame = frame.astype(object).where(frame.notna(), None)
            waits: list[tuple] = []
            for r in frame.itertuples(index=False):
                if r.is_entry:
                    got = tuple(getattr(r, c) for c in _ENTRY)
                    if entry is None or _order(got) >= _order(entry):
                        entry, new_entry = got, True
                    continue
                stamp = int(r.queued_ms) if r.queued_ms else now
                seq = None if r.arrival_seq is None else int(r.arrival_seq)
                mine = (seq is None, seq or 0, stamp)
                if first is None or mine[:2] < tuple(first[:2]):
                    first = mine
                if r.lineage_ms is not None:
                    oldest = int(r.lineage_ms) if oldest is None else min(oldest, int(r.lineage_ms))
                if r.own:
                    waits.append((r.request_id, r.attributes, str(stamp), r.lineage_ms, r.arrival_seq))
            if waits:
                self.rows.appendList(waits)
        if first is not None:
            self.first.update(first)
        if oldest is not None:
            self.oldest.update((oldest,))
        if new_entry:
            self.entry.update(entry)
        yield from self._decide(key, now, first, oldest, entry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first = self.first.get() if self.first.exists() else None
        oldest = self.oldest.get()[0] if self.oldest.exists() else None
        entry = self.entry.get() if self.entry.exists() else None
        yield from self._decide(key, timerValues.getCurrentProcessingTimeInMs(), first, oldest, entry)

    def _decide(self, key, now: int, first, oldest, entry) -> Iterator[pd.DataFrame]:
        """Emit the key's rows if they are decided, else see to it that a timer looks again."""
        if first is None:
            return
        age = int((now - first[2]) / MS_PER_MINUTE)
        upcoming = None
        if entry is not None:
            event = int(entry[_ENTRY.index("event_ms")])
            start = now - MS_PER_MINUTE if oldest is None else min(oldest, now - MS_PER_MINUTE)
            if event > now:
                upcoming, entry = event, None
            elif event < start:
                entry = None
        status = entry[0] if entry is not None else None
        if entry is not None:
            route = {"LOADED": "loaded", "PARTIALLY_LOADED": "partially_loaded",
                     "LOAD_FAILED": "load_failure"}.get(status)
        else:
            route = "unmatched" if age > self.max_age_minutes else None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if route is None:
            if entry is None:
                due = first[2] + (self.max_age_minutes + 1) * MS_PER_MINUTE
                self.handle.registerTimer(max(now + 1, min(due, upcoming or due)))
            return
        failed = status in ERROR_STATUSES
        out: list[tuple] = []
        for r in self.rows.get():
            out.append((r[0], key[0], key[1], r[1], None if route == "unmatched" else r[2], r[3], r[4], str(age),
                        route, status, entry[1] if failed else None, entry[2] if failed else None,
                        entry[3] if entry is not None else None))
            if len(out) >= ROWS_PER_FRAME:
                yield pd.DataFrame(out, columns=_OUT.names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=_OUT.names)
        self.rows.clear()
        self.first.clear()
        self.oldest.clear()

    def close(self) -> None:
        pass


def _order(entry: tuple) -> tuple:
    seq = entry[_ENTRY.index("seq")]
    return (seq is not None, int(seq) if seq is not None else 0)


def keyed_await(requests: DataFrame, entries: DataFrame, max_age_minutes: int,
                entry_ttl_minutes: int | None = None, salts: int = 1, hot: Column | None = None,
                ts_col: str = "event_ts") -> DataFrame:
    """The stream of decided requests: the columns of ``PENDING`` and of ``OUTPUT_EXTRA``.

    ``requests`` and ``entries`` are streams of the shapes ``PENDING`` and
    ``HISTORY``.  Rows without a key or with an invalid stamp fail at once and
    touch no state.  ``hot`` marks, by ``pipe`` and ``file``, the keys that are
    split over ``salts`` states (all keys, without it).
    """
    has_key = F.col("pipe").isNotNull() & F.col("file").isNotNull()
    valid = stamp_is_valid("queued_ms")
    requests = requests.select(*[F.col(f.name).cast(f.dataType) for f in PENDING.fields])
    split = F.lit(salts) if hot is None else F.when(F.coalesce(hot, F.lit(False)), F.lit(salts)).otherwise(F.lit(1))
    every = F.explode(F.sequence(F.lit(0), split - 1))
    place = F.pmod(F.xxhash64("request_id", "arrival_seq", "queued_ms"), split.cast("long")).cast("int")
    none = F.lit(None).cast("string")
    mine = F.col("own")
    asked = requests.where(has_key & valid).select("*", every.alias("salt"), place.alias("place")) \
        .withColumn("own", F.col("salt") == F.col("place")).select(
            "pipe", "file", "salt", F.lit(False).alias("is_entry"), "own",
            F.when(mine, F.col("request_id")).alias("request_id"),
            F.when(mine, F.to_json("attributes")).alias("attributes"), "queued_ms",
            F.col("lineage_ms").cast("string").alias("lineage_ms"),
            F.col("arrival_seq").cast("string").alias("arrival_seq"), *(none.alias(c) for c in _ENTRY))
    known = entries.withColumnRenamed("path", "file").where(has_key).select(
        "pipe", "file", every.alias("salt"), F.lit(True).alias("is_entry"), F.lit(False).alias("own"),
        *(none.alias(c) for c in _REQUEST), "status", "first_error",
        F.col("errors_seen").cast("string").alias("errors_seen"),
        F.to_json(F.struct(*[F.col("file" if c == "path" else c).alias(c) for c in ENTRY_FIELDS])).alias("payload"),
        F.col("seq").cast("string").alias("seq"), col_epoch_ms(F.col(ts_col)).cast("string").alias("event_ms"))
    decided = asked.unionByName(known).groupBy("pipe", "file", "salt").transformWithStateInPandas(
        KeyedAwait(max_age_minutes, entry_ttl_minutes), _OUT, "Append", "ProcessingTime")
    decided = decided.select(
        "request_id", "pipe", "file", F.from_json("attributes", "map<string,string>").alias("attributes"),
        "queued_ms", *(F.col(c).cast("long").alias(c) for c in ("lineage_ms", "arrival_seq", "age_minutes")),
        "route", "status", "error", "error_count", "payload").select(*PENDING.names, *OUTPUT_EXTRA)
    now_ms = F.unix_millis(F.current_timestamp())
    error = F.when(~valid, INVALID_STAMP_TEXT).when(F.col("pipe").isNull(), MISSING_ATTRIBUTE_TEXT + "pipe") \
        .otherwise(MISSING_ATTRIBUTE_TEXT + "file")
    blank = F.coalesce("queued_ms", F.lit("")) == ""
    failed = requests.where(~(has_key & valid)).select(
        *[F.when(blank, now_ms.cast("string")).otherwise(F.col(c)).alias(c) if c == "queued_ms" else F.col(c)
          for c in PENDING.names],
        F.when(valid, queue_age("queued_ms", now_ms)).alias("age_minutes"), F.lit("load_failure").alias("route"),
        none.alias("status"), error.alias("error"), none.alias("error_count"), none.alias("payload"))
    return decided.unionByName(failed)


def start_keyed_await(requests: DataFrame, entries: DataFrame, max_age_minutes: int, out_dir: str,
                      checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    """Write the decided rows to ``out_dir`` (Parquet, one folder a route), exactly once."""
    w = keyed_await(requests, entries, max_age_minutes, **kw).writeStream.format("parquet") \
        .option("path", out_dir).option("checkpointLocation", checkpoint).partitionBy("route")
    return w.trigger(**(trigger or {"processingTime": DEFAULT_POLL})).start()


def waiting_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The requests that wait in the state below ``checkpoint``: the columns of ``PENDING``."""
    rows = spark.read.format("statestore").option("stateVarName", "rows").load(checkpoint)
    r = F.col("list_element")
    return rows.select(
        r["request_id"].alias("request_id"), F.col("key")["pipe"].alias("pipe"), F.col("key")["file"].alias("file"),
        F.from_json(r["attributes"], "map<string,string>").alias("attributes"), r["queued_ms"].alias("queued_ms"),
        r["lineage_ms"].cast("long").alias("lineage_ms"), r["arrival_seq"].cast("long").alias("arrival_seq"))
