"""Text of the stage (copy) command for one request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ingestflow.schemas import PARALLEL_DEFAULT

# Command template and its optional clauses, in this order.
COMMAND_TEMPLATE = "PUT file://%s/%s @%s"
AUTO_COMPRESS_CLAUSE = " AUTO_COMPRESS = %s"
SOURCE_COMPRESSION_CLAUSE = " SOURCE_COMPRESSION = %s"
PARALLEL_CLAUSE = " PARALLEL = %d"
DEFAULT_VALUE = "default"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stage_command(input_directory: Column | str = "input_directory",
                  file_name: Column | str = "file_name",
                  internal_stage: Column | str = "internal_stage",
                  auto_compress: Column | str = "auto_compress",
                  source_compression: Column | str = "source_compression",
                  parallel: Column | str = "parallel") -> Column:
    """Render the stage command; a clause is left out when its value is the default.

    ``format_string`` renders a null argument as ``null`` exactly like the
    Java formatter, so the text stays total on incomplete requests.
    """
    ac, sc, par = _c(auto_compress), _c(source_compression), _c(parallel)
    base = F.format_string(COMMAND_TEMPLATE, _c(input_directory), _c(file_name),
                           _c(internal_stage))
    ac_part = F.when(F.coalesce(ac, F.lit(DEFAULT_VALUE)) != DEFAULT_VALUE,
                     F.format_string(AUTO_COMPRESS_CLAUSE, ac)).otherwise(F.lit(""))
    sc_part = F.when(F.coalesce(sc, F.lit(DEFAULT_VALUE)) != DEFAULT_VALUE,
                     F.format_string(SOURCE_COMPRESSION_CLAUSE, sc)).otherwise(F.lit(""))
    par_int = par.cast("int")
    par_part = F.when(F.coalesce(par_int, F.lit(PARALLEL_DEFAULT)) != PARALLEL_DEFAULT,
                      F.format_string(PARALLEL_CLAUSE, par_int)).otherwise(F.lit(""))
    return F.concat(base, ac_part, sc_part, par_part)
