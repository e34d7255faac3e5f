"""Send/audit events and route counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.functions.timing import int_div

# Fixed value: target recorded when the connection reports no URL.
UNKNOWN_URL = "jdbc://unknown-host"


def audit_events(staged: DataFrame, url: str = "url", start_ms: str = "start_ms",
                 end_ms: str = "end_ms") -> DataFrame:
    """One send event per staged file: target URL, transmission ms, whole seconds."""
    elapsed = F.col(end_ms) - F.col(start_ms)
    return staged.select(
        "request_id", "source_filename",
        F.coalesce(F.col(url), F.lit(UNKNOWN_URL)).alias("target_url"),
        elapsed.cast("long").alias("transmission_ms"),
        int_div(elapsed, 1000).alias("duration_s"))


def route_counts(routed: DataFrame, route: str = "route") -> DataFrame:
    """Rows per route (a partial aggregate: one row per route per map task shuffles)."""
    return routed.groupBy(route).agg(F.count(F.lit(1)).alias("n"))
