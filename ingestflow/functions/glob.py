"""File-name wildcards (``*`` and ``?``) as anchored regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of the inner literal that patterns without a literal start or end are found by.
GRAM = 3

# Regex metacharacters escaped before the two wildcards are translated.
_META = r"([\\.^$|()\[\]{}+])"


def glob_regex(pattern: Column | str) -> Column:
    """Translate a file-name pattern to an anchored regex, entirely JVM-side.

    ``*`` matches any run of characters except ``/``, ``?`` exactly one
    such character; every other character matches itself.
    """
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    escaped = F.regexp_replace(p, _META, r"\\$1")
    star = F.regexp_replace(escaped, r"\*", "[^/]*")
    quest = F.regexp_replace(star, r"\?", "[^/]")
    return F.concat(F.lit("^"), quest, F.lit("$"))


def pattern_anchor(pattern: Column | str) -> Column:
    """The literal that finds a pattern's candidates: ``struct(kind, len, text)``.

    Of the literal start (``p``) and end (``s``) of the pattern the longer one;
    without either, the first ``GRAM`` characters of its longest literal
    (``g``).  Every name that the pattern matches has the anchor.  A pattern
    without literals has the empty start, which every name has.
    """
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    literals = F.split(p, "[*?]")
    start, end = F.element_at(literals, 1), F.element_at(literals, -1)
    longest = F.array_max(F.transform(literals, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]

    def anchor(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.length(text).alias("len"), text.alias("text"))

    return (F.when(F.length(start) + F.length(end) == 0, F.when(
        F.length(longest) > 0, anchor("g", F.substring(longest, 1, GRAM))).otherwise(anchor("p", start)))
        .when(F.length(start) >= F.length(end), anchor("p", start)).otherwise(anchor("s", end)))


def name_anchors(name: Column | str, shapes: Column) -> Column:
    """All anchors of a name of the given ``shapes``, an array of ``struct(kind, len)``."""
    n = F.col(name) if isinstance(name, str) else name
    size = F.length(n)

    def of(shape: Column) -> Column:
        kind, k = shape["kind"], shape["len"]
        texts = (F.when(size < k, F.array().cast("array<string>"))
                 .when(kind == "p", F.array(F.substr(n, F.lit(1), k)))
                 .when(kind == "s", F.array(F.substr(n, size - k + 1, k)))
                 .otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - k + 1, F.lit(1))),
                                                         lambda i: F.substr(n, i, k)))))
        return F.transform(texts, lambda t: F.struct(kind.alias("kind"), k.alias("len"), t.alias("text")))

    return F.flatten(F.transform(shapes, of))


def has_wildcard(pattern: Column | str) -> Column:
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    return p.contains("*") | p.contains("?")
