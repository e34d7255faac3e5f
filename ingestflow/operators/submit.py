"""Load-request intake and classification of submission outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.functions.codes import implied_code, response_code
from ingestflow.functions.template import resolve_template

# Codes whose presence anywhere in the extracted code means
# "try again later" (a substring test, so e.g. 1500 also retries).
RETRY_CODE_MARKERS = ("429", "500")
DEFAULT_FILE_TEMPLATE = "${filename}"


def load_requests(events: DataFrame, pipe_template: str,
                  file_template: str = DEFAULT_FILE_TEMPLATE,
                  attributes: str = "attributes") -> DataFrame:
    """One (pipe, file) load request per event, both resolved from its attributes."""
    return (events.withColumn("pipe", resolve_template(pipe_template, attributes))
                  .withColumn("file", resolve_template(file_template, attributes)))


def classify_submission(outcomes: DataFrame, kind: str = "kind",
                        message: str = "message") -> DataFrame:
    """Add ``response_code``, ``error_message`` and ``route`` to submission outcomes.

    ``kind`` null means the submission was accepted → ``success`` with code
    200.  ``backoff`` (throttled) → ``retry``, message kept, no code.
    ``response`` → code extracted from the message; ``retry`` when it contains
    429 or 500, else ``failure``.  Any other kind → ``failure``, no code.
    """
    k, m = F.col(kind), F.col(message)
    code = (F.when(k.isNull(), implied_code())
            .when(k == "response", response_code(m)))
    retry_code = F.lit(False)
    for marker in RETRY_CODE_MARKERS:
        retry_code = retry_code | F.col("response_code").contains(marker)
    route = (F.when(k.isNull(), "success")
             .when(k == "backoff", "retry")
             .when((k == "response") & retry_code, "retry")
             .otherwise("failure"))
    return (outcomes.withColumn("response_code", code)
                    .withColumn("error_message", F.when(k.isNotNull(), m))
                    .withColumn("route", route))


def submit_rounds(outcome_rounds: Sequence[DataFrame], key: str = "request_id") -> DataFrame:
    """Resubmit ``retry`` rows: a later round only sees the requests that are still retried.

    Each round's outcomes are keyed by ``key`` (unique per round).  The result
    is every first-round request's deciding outcome with its ``round``: the
    earliest one that is not ``retry``, else its last ``retry``.  A retried
    request that a round has no outcome for is not lost; a later round may
    answer it.  One aggregate decides all rounds.  Rows without a key cannot be
    told apart later: their first outcome stands.
    """
    routed = [classify_submission(o).withColumn("round", F.lit(i)) for i, o in enumerate(outcome_rounds, 1)]
    together = routed[0]
    for r in routed[1:]:
        together = together.unionByName(r)
    columns = together.columns
    rest = F.struct(*[c for c in columns if c != key])
    final = F.col("route") != "retry"
    decided = together.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("round").alias("__first"),
        F.coalesce(F.min_by(rest, F.when(final, F.col("round"))), F.max_by(rest, "round")).alias("__out")) \
        .where(F.col("__first") == 1).select(key, "__out.*").select(*columns)
    return decided.unionByName(routed[0].where(F.col(key).isNull()))
