"""Route fan-out: every row lands in exactly one named output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_routes(routed: DataFrame, path: str, route: str = "route", fmt: str = "parquet",
                 mode: str = "append") -> None:
    """Write rows partitioned by route (``<path>/route=<name>/``), one output per route."""
    routed.write.mode(mode).partitionBy(route).format(fmt).save(path)
