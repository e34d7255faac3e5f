"""Column-level functions (all built from JVM-side ``pyspark.sql.functions``)."""

from ingestflow.functions.codes import implied_code, response_code
from ingestflow.functions.command import stage_command
from ingestflow.functions.compression import detect_compression, target_compression
from ingestflow.functions.glob import glob_regex, has_wildcard
from ingestflow.functions.template import resolve_template
from ingestflow.functions.timing import (epoch_ms, minutes_between, queue_age, stamp_is_valid,
                                         stamp_or_now, ts_literal)

__all__ = [
    "implied_code", "response_code", "stage_command", "detect_compression",
    "target_compression", "glob_regex", "has_wildcard", "resolve_template", "epoch_ms",
    "minutes_between", "queue_age", "stamp_is_valid", "stamp_or_now", "ts_literal",
]
