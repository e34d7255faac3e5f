"""Response-code handling for load submissions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pattern that pulls an HTTP status out of an error text, the
# code used when none is found, and the code implied when no error was raised.
RESPONSE_CODE_PATTERN = r".*HTTP Status: (\d+)"
NO_CODE = "0"
ACCEPTED_CODE = "200"


def response_code(message: Column | str) -> Column:
    """HTTP status found in ``message`` (first matching line, last code on it), else ``'0'``.

    ``regexp_extract`` searches (it does not need a whole-string match) and
    yields ``''`` when nothing matches, hence the ``nullif``.
    """
    msg = F.col(message) if isinstance(message, str) else message
    found = F.regexp_extract(msg, RESPONSE_CODE_PATTERN, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(NO_CODE))


def implied_code() -> Column:
    """Code recorded for a submission that raised no error."""
    return F.lit(ACCEPTED_CODE)
