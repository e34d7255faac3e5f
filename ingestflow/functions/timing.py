"""Epoch-millisecond arithmetic: queue age, look-back and stamps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_MINUTE = 60000


def epoch_ms(ts) -> int:
    """Epoch milliseconds of a naive-UTC datetime, an ISO string, or ms already."""
    if isinstance(ts, int):
        return ts
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts)
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    return int(ts.timestamp() * 1000)


def to_datetime(ts) -> _dt.datetime:
    """Naive-UTC datetime of a datetime, ISO string or epoch ms."""
    if isinstance(ts, (int, str)):
        ts = _dt.datetime.fromtimestamp(epoch_ms(ts) / 1000, _dt.timezone.utc)
    if ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return ts


def ts_literal(ts, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal typed like the column it is compared with.

    Comparing a ``timestamp_ntz`` column with a literal of the same type keeps
    the predicate a plain column-vs-literal filter, which Parquet pushdown
    understands; a cast on the column would not be pushed.
    """
    name = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.expr(f"{name}'{to_datetime(ts).isoformat(sep=' ')}'")


def col_epoch_ms(c: Column) -> Column:
    """Epoch ms of a timestamp column of either timestamp type (session zone UTC)."""
    return F.unix_millis(c.cast("timestamp"))


def int_div(num: Column, d: int) -> Column:
    """``num div d``: truncates toward zero like Java long division."""
    return F.call_function("div", num.cast("long"), F.lit(d).cast("long"))


def minutes_between(now_ms: int | Column, ms: Column) -> Column:
    """Whole minutes from ``ms`` to ``now_ms``, truncated toward zero; null beyond a long."""
    now = F.lit(now_ms).cast("long") if isinstance(now_ms, int) else now_ms
    return int_div(F.try_subtract(now, ms.cast("long")), MS_PER_MINUTE)


def stamp_is_valid(queued_ms: Column | str) -> Column:
    """True when the queued stamp is absent/blank or a whole number of ms."""
    q = F.col(queued_ms) if isinstance(queued_ms, str) else queued_ms
    # Digits alone: a cast would also accept surrounding blanks.
    whole = F.when(q.rlike(r"^[+-]?[0-9]+$"), q.try_cast("long")).isNotNull()
    return (F.coalesce(q, F.lit("")) == "") | whole


def queue_age(queued_ms: Column | str, now_ms: int | Column) -> Column:
    """Minutes since first queued; null/blank stamp gives 0, a bad stamp null."""
    q = F.col(queued_ms) if isinstance(queued_ms, str) else queued_ms
    return F.when(F.coalesce(q, F.lit("")) == "", F.lit(0).cast("long")).otherwise(
        minutes_between(now_ms, q.try_cast("long")))


def stamp_or_now(queued_ms: Column | str, now_ms: int) -> Column:
    """Keep a present stamp, else stamp the row with ``now`` (as text)."""
    q = F.col(queued_ms) if isinstance(queued_ms, str) else queued_ms
    return F.coalesce(F.nullif(q, F.lit("")), F.lit(str(now_ms)))
