"""Reconcile pending load requests with load history (the await step).

Every pending row is routed to exactly one of ``loaded``, ``partially_loaded``,
``load_failure``, ``waiting`` or ``unmatched``:

0. a queued stamp that is present but not a whole number of ms →
   ``load_failure`` (``invalid queued timestamp``; the original aborts the
   whole run instead);
1. no pipe, or no file name → ``load_failure`` with an explanatory error;
2. a history entry for (pipe, file) inside the look-back window:
   ``LOADED`` → ``loaded``; ``PARTIALLY_LOADED`` → ``partially_loaded`` and
   ``LOAD_FAILED`` → ``load_failure`` (both with first error and error
   count); any other status → ``waiting`` (no age test);
3. no entry: older than ``max_age_minutes`` (strictly) → ``unmatched`` and the
   queued stamp is cleared; otherwise ``waiting``.

All rows sharing (pipe, file) use the age of the first of them (lowest
``arrival_seq``; rows without one come last, rows with an invalid stamp take no
part); when several entries exist for a file the latest (highest ``seq``, a
null one lowest) wins.  The look-back window is ``[now - max(1, oldest lineage age in
minutes), now]`` and only pipes that are pending are scanned.

Plan shape: the pending rows are counted; one small aggregate over them, a scalar
subquery of the plan, yields the look-back (the window bounds reach the Parquet scan as pushed
filters); history is restricted to pending pipes by a semi-join; one
partially-aggregated pass over (pending keys ∪ windowed history) builds a
per-key summary; one balanced lookup join attaches it to every pending row
(see ``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestflow.functions.timing import epoch_ms, queue_age, stamp_is_valid, stamp_or_now
from ingestflow.operators.history import history_multi_pipe, keyed
from ingestflow.operators.skew import lookup_join
from ingestflow.schemas import ENTRY_FIELDS

# Error texts written on the failure route.
MISSING_ATTRIBUTE_TEXT = "Flow file does not contained configured attribute: "
INVALID_STAMP_TEXT = "invalid queued timestamp"
ERROR_STATUSES = ("PARTIALLY_LOADED", "LOAD_FAILED")

OUTPUT_EXTRA = ("age_minutes", "route", "status", "error", "error_count", "payload")


def _entry_type(history: DataFrame) -> T.StructType:
    return T.StructType([history.schema[c] for c in ENTRY_FIELDS])


def per_key_summary(pending: DataFrame, history_window: DataFrame, now_ms: int) -> DataFrame:
    """(pipe, file) → pending row count, first-wins age, latest history entry.

    Pending keys and windowed history go through one aggregate: ``min_by`` and
    ``max_by`` ignore rows whose ordering value is null, so each side only
    feeds its own result, and keys never pending drop out at the end.
    """
    etype = _entry_type(history_window)
    entry = F.struct(*[F.col(c) for c in ENTRY_FIELDS])
    first = _first_order().alias("first")
    last = F.struct(F.col("seq").isNotNull().alias("has"), F.col("seq").cast("long").alias("seq"))
    pend = keyed(pending).select(
        "pipe", "file", F.lit(1).alias("is_pending"),
        queue_age("queued_ms", now_ms).alias("age"), first)
    hist = history_window.select(
        "pipe", F.col("path").alias("file"), F.lit(0).alias("is_pending"), entry.alias("entry"),
        last.alias("last"))
    both = pend.withColumns({"entry": F.lit(None).cast(etype),
                             "last": F.lit(None).cast(hist.schema["last"].dataType)}).unionByName(
        hist.withColumns({"age": F.lit(None).cast("long"),
                          "first": F.lit(None).cast(pend.schema["first"].dataType)}))
    return (both.groupBy("pipe", "file")
            .agg(F.sum("is_pending").alias("n_pending"),
                 F.min_by("age", "first").alias("first_age"),
                 F.max_by("entry", "last").alias("entry"))
            .where(F.col("n_pending") > 0))


def _first_order():
    """Order of pending rows for first-wins; null (takes no part) with an invalid stamp."""
    seq = F.col("arrival_seq").cast("long")
    return F.when(stamp_is_valid("queued_ms"),
                  F.struct(seq.isNull().alias("none"), seq.alias("seq")))


def first_wins_age(pending: DataFrame, now) -> DataFrame:
    """(pipe, file) → number of pending rows and the age of the first with a valid stamp."""
    now_ms = epoch_ms(now)
    return keyed(pending).groupBy("pipe", "file").agg(
        F.count(F.lit(1)).alias("n_pending"),
        F.min_by(queue_age("queued_ms", now_ms), _first_order()).alias("first_age"))


def await_results(pending: DataFrame, history: DataFrame, max_age_minutes: int, now,
                  ts_col: str = "event_ts", prune_pipes: bool = True,
                  **skew_kw) -> DataFrame:
    """Route every pending row; returns the pending columns plus ``OUTPUT_EXTRA``.

    ``queued_ms`` comes back stamped with ``now`` where it was absent, and
    cleared on the ``unmatched`` route so the row may wait again later.
    ``payload`` is the matched history entry as JSON (null fields omitted).
    ``arrival_seq`` (pending) and ``seq`` (history) decide first-wins and
    last-wins, so they should differ within a (pipe, file).
    """
    if pending.isStreaming:
        raise ValueError("await_results reads the pending rows several times; "
                         "for a stream use streaming.await_stream.start_await_stream")
    now_ms = epoch_ms(now)
    window = history_multi_pipe(history, pending, now, ts_col, prune_pipes)
    summary = per_key_summary(pending, window, now_ms)
    spread = ["arrival_seq"] if "arrival_seq" in pending.columns else None
    # The number of rows decides whether any key can be hot; counting them reads no wide column.
    j = lookup_join(pending, summary, ["pipe", "file"], "n_pending", spread=spread,
                    total=pending.count(), **skew_kw)

    pipe, file, entry = F.col("pipe"), F.col("file"), F.col("entry")
    status = entry.getField("status")
    has = entry.isNotNull()
    valid = stamp_is_valid("queued_ms")
    route = (F.when(~valid, "load_failure")
             .when(pipe.isNull(), "load_failure")
             .when(file.isNull(), "load_failure")
             .when(has & (status == "LOADED"), "loaded")
             .when(has & (status == "PARTIALLY_LOADED"), "partially_loaded")
             .when(has & (status == "LOAD_FAILED"), "load_failure")
             .when(has, "waiting")
             .when(F.col("first_age") > F.lit(max_age_minutes), "unmatched")
             .otherwise("waiting"))
    with_errors = has & status.isin(*ERROR_STATUSES)
    error = (F.when(~valid, F.lit(INVALID_STAMP_TEXT))
             .when(pipe.isNull(), F.lit(MISSING_ATTRIBUTE_TEXT + "pipe"))
             .when(file.isNull(), F.lit(MISSING_ATTRIBUTE_TEXT + "file"))
             .when(with_errors, entry.getField("first_error")))
    stamped = (F.when(route == "unmatched", F.lit(None).cast("string"))
               .when(valid, stamp_or_now("queued_ms", now_ms))
               .otherwise(F.col("queued_ms")))
    extra = {
        "age_minutes": F.coalesce(F.col("first_age"), queue_age("queued_ms", now_ms)),
        "route": route,
        "status": status,
        "error": error,
        "error_count": F.when(with_errors, entry.getField("errors_seen").cast("string")),
        "payload": F.when(has, F.to_json(entry)),
    }
    cols = [stamped.alias(c) if c == "queued_ms" else F.col(c) for c in pending.columns]
    return j.select(*cols, *[extra[c].alias(c) for c in OUTPUT_EXTRA])


def waiting_rows(routed: DataFrame, pending_columns) -> DataFrame:
    """Rows on the ``waiting`` route, back in pending shape (stamps kept)."""
    return routed.where(F.col("route") == "waiting").select(*pending_columns)


def await_rounds(pending: DataFrame, history: DataFrame, max_age_minutes: int, nows,
                 arrival_ms_col: str = "queued_ms", **kw) -> DataFrame:
    """Run the await step at each time in ``nows``; waiting rows loop back.

    A pending row enters the first round whose ``now`` is at or after its
    arrival (``arrival_ms_col``, epoch ms); rows still waiting after a round
    are pending again in the next one, with their stamps.  Returns every
    row's final route with the round number that decided it; rows still
    waiting after the last round are reported with that round, and so are rows
    that arrive after it (``waiting``, with neither an age nor an entry).

    Each round's routed rows feed three consumers (its decided rows, the
    next round's input and that round's look-back), so every round but the
    last is written once (``session.materialize``), which also keeps the plan
    of a long loop from growing round by round.
    """
    from ingestflow.session import materialize

    cols = pending.columns
    arrival = F.col(arrival_ms_col).try_cast("long")
    carried = None
    decided = []
    prev_ms = None
    for i, now in enumerate(nows, start=1):
        now_ms = epoch_ms(now)
        cond = arrival <= now_ms if prev_ms is None else (arrival > prev_ms) & (arrival <= now_ms)
        if prev_ms is None:
            cond = cond | arrival.isNull()
        arrivals = pending.where(cond)
        batch = arrivals if carried is None else carried.unionByName(arrivals)
        routed = await_results(batch, history, max_age_minutes, now, **kw)
        last = i == len(nows)
        if not last:
            routed = materialize(routed, f"await-round-{i}")
        done = routed if last else routed.where(F.col("route") != "waiting")
        decided.append(done.withColumn("round", F.lit(i)))
        carried = waiting_rows(routed, cols)
        prev_ms = now_ms
    late = pending.where(arrival > prev_ms).select(
        *cols, *[(F.lit("waiting") if c == "route" else F.lit(None).cast(routed.schema[c].dataType))
                 .alias(c) for c in OUTPUT_EXTRA]).withColumn("round", F.lit(len(nows)))
    out = late
    for d in decided:
        out = out.unionByName(d)
    return out
