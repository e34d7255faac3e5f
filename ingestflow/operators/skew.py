"""Joins that stay balanced when one key carries a large share of the rows.

The engine's lookups all have the same shape: many rows on one side, one row
per key on the other (a per-key summary such as "latest history entry" or
"first queued age").  A plain shuffle join sends every row of a key to one
task, so a key holding a third of the rows would make one task do a third of
the work.  ``lookup_join`` splits the keys in two:

* **hot keys** — keys whose row count exceeds ``max(min_hot_rows, total /
  max_hot_keys)``.  Because the counts add up to ``total``, fewer than
  ``max_hot_keys`` keys can exceed it, so this slice of the summary has a
  proven size bound and is broadcast; hot rows are served map-side.
* **everything else** — an ordinary shuffle join on ``keys + salt``.  Cold
  rows carry salt 0 (as does the summary); hot rows and rows with a null key
  (which can never match) carry a 64-bit hash instead, so they spread evenly
  over all shuffle partitions rather than piling into the one their key
  hashes to.  No row is replicated and none is dropped.

When the caller knows the total, rows with null keys included, and it is at
most ``min_hot_rows``, no key can exceed the threshold and no task can receive
more than that many rows of one key (or of the null keys), so a plain join is
used.  AQE may still turn the cold join into
a broadcast when it measures the summary as small at runtime; that decision
is made on observed sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MIN_HOT_ROWS = 1_000_000
DEFAULT_MAX_HOT_KEYS = 1000


def hot_threshold(per_key: DataFrame, weight: str, min_hot_rows: int,
                  max_hot_keys: int, total: int | None = None) -> Column:
    """``max(min_hot_rows, sum(weight) / max_hot_keys)``.

    With ``total`` known (the caller already counted the rows) it is a
    literal; otherwise a scalar subquery over ``per_key``.
    """
    if total is not None:
        return F.lit(float(max(min_hot_rows, total / max_hot_keys)))
    t = per_key.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("t")).scalar()
    return F.greatest(F.lit(min_hot_rows).cast("double"), t.cast("double") / max_hot_keys)


def _hashable(t: T.DataType) -> bool:
    """Spark's hash functions reject map types (also when nested)."""
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return True


def lookup_join(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], weight: str,
                spread: Sequence[str] | None = None,
                min_hot_rows: int = DEFAULT_MIN_HOT_ROWS,
                max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
                total: int | None = None) -> DataFrame:
    """Left-join ``rows`` to ``per_key`` (unique on ``keys``), balanced under key skew.

    ``per_key[weight]`` is the number of ``rows`` (or of the larger input)
    carrying the key; keys absent from ``per_key`` are treated as cold.
    ``total`` (the number of all ``rows``, those with null keys included),
    when the caller knows it, saves the scalar subquery that would otherwise
    sum the weights.
    ``spread`` names row columns that vary within a key (default: all row
    columns Spark can hash, i.e. not maps) and seed the salt of hot and
    null-key rows.  The result has the
    columns of ``rows`` followed by the value columns of ``per_key``.
    """
    keys = list(keys)
    values = [c for c in per_key.columns if c not in keys]
    if total is not None and total <= min_hot_rows:
        # No key can exceed the threshold, and no task can receive more than
        # ``min_hot_rows`` rows of one key: a plain join has the same bound.
        return rows.join(per_key, on=keys, how="left").select(*rows.columns, *values)
    threshold = hot_threshold(per_key, weight, min_hot_rows, max_hot_keys, total)
    hot = per_key.where(F.col(weight) > threshold)
    cold = per_key.where(~(F.col(weight) > threshold) | F.col(weight).isNull())

    hk = {k: f"__hot_key_{i}" for i, k in enumerate(keys)}
    hv = {v: f"__hot_val_{i}" for i, v in enumerate(values)}
    hot_side = hot.select(*[F.col(k).alias(hk[k]) for k in keys],
                          *[F.col(v).alias(hv[v]) for v in values],
                          F.lit(True).alias("__is_hot"))
    cond = [rows[k] == hot_side[hk[k]] for k in keys]
    # Size bound: fewer than max_hot_keys rows (see module docstring).
    step = rows.join(F.broadcast(hot_side), on=cond, how="left").drop(*hk.values())

    seed_cols = list(spread) if spread else [
        c for c in rows.columns if _hashable(rows.schema[c].dataType)]
    any_null_key = F.lit(False)
    for k in keys:
        any_null_key = any_null_key | F.col(k).isNull()
    salt = F.when(F.col("__is_hot") | any_null_key,
                  F.xxhash64(*[F.col(c) for c in seed_cols])).otherwise(F.lit(0).cast("long"))
    step = step.withColumn("__salt", salt)
    # Always 0, but not a literal: that would be folded out of the join's keys into a condition,
    # and the rows of a hot key would meet in one task again.
    cold_side = cold.withColumn("__salt", F.pmod(F.xxhash64(*keys), F.lit(1).cast("long")))
    joined = step.join(cold_side, on=keys + ["__salt"], how="left")
    merged = [F.coalesce(F.col(hv[v]), F.col(v)).alias(v) for v in values]
    return joined.select(*rows.columns, *merged)


def semi_join(big: DataFrame, small_keys: DataFrame, keys: Sequence[str],
              anti: bool = False, **kw) -> DataFrame:
    """Rows of ``big`` whose key is (``anti``: is not) in ``small_keys``, skew-safe.

    Key counts of ``big`` come from one partially-aggregated pass, so a hot
    key of ``big`` is detected and served by broadcast instead of landing in
    a single task of the shuffle.
    """
    keys = list(keys)
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    marks = small_keys.select(*keys).distinct().withColumn("__hit", F.lit(True))
    per_key = counts.join(marks, on=keys, how="left")
    out = lookup_join(big, per_key, keys, "__n", **kw)
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return out.where(~hit if anti else hit).drop("__n", "__hit")
