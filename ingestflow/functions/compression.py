"""Compression tagging of source files from their first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magic-number prefixes (hex) of the formats that can be detected.
# Brotli and raw deflate carry no signature, so they are only ever declared.
GZIP_MAGIC = "1F8B"
BZ2_MAGIC = "425A68"
ZSTD_MAGIC = "28B52FFD"
ZLIB_FIRST_BYTE = "78"
ZLIB_SECOND_BYTES = ("01", "5E", "9C", "DA")

DETECT_VALUES = ("AUTO_DETECT", "default")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _is_text(header: Column) -> Column:
    """Leading bytes that are all printable ASCII or blanks: a text that starts like zlib data."""
    return ~F.hex(header).rlike("^(..)*(0[0-8BCEF]|1.|[89A-F].|7F)")


def sniff_compression(header: Column | str) -> Column:
    """Compression recognised from a file's leading bytes (``NONE`` if none)."""
    h = F.hex(F.substring(_c(header), 1, 4))
    return (F.when(h.startswith(GZIP_MAGIC), F.lit("GZIP"))
            .when(h.startswith(BZ2_MAGIC), F.lit("BZ2"))
            .when(h.startswith(ZSTD_MAGIC), F.lit("ZSTD"))
            .when(h.startswith(ZLIB_FIRST_BYTE)
                  & F.substring(h, 3, 2).isin(*ZLIB_SECOND_BYTES) & ~_is_text(_c(header)),
                  F.lit("DEFLATE"))
            .otherwise(F.lit("NONE")))


def detect_compression(declared: Column | str, header: Column | str) -> Column:
    """Source compression: the declared value wins unless it asks for detection."""
    d = _c(declared)
    return F.when(d.isNull() | d.isin(*DETECT_VALUES), sniff_compression(header)).otherwise(d)


def target_compression(source: Column | str, auto_compress: Column | str) -> Column:
    """Compression of the staged copy: gzip when compressing an uncompressed file."""
    s, ac = _c(source), F.coalesce(_c(auto_compress), F.lit("default"))
    return F.when((s == "NONE") & ac.isin("true", "default"), F.lit("GZIP")).otherwise(s)
