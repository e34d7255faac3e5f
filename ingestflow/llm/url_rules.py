"""URL filters by pattern rules under their rarest literal token (operator 7).

A rule is an action and a regular expression over ``host + path``; it is
indexed under one of the literal tokens that every match must hold, the one
found in fewest URLs of the input.  A URL's own tokens fetch the candidate
rules, and only those run their expression; rules without a literal token run
on every URL.  The number of expressions run on a URL so depends on how many
rules share its rare tokens, not on the number of rules.

Two kinds of rule:

* ``host_rule``: a host (with all its subdomains) and a path prefix.  Of those
  that fit, the longest wins, whatever the pattern rules say.
* ``pattern_rule``: an expression with the tokens it needs; it decides where no
  host rule fits.  Any ``block`` wins over ``allow``; without a rule the
  verdict is ``allow``.

Rules are configuration: ``MAX_RULES`` bounds what is sent to the executors.
Token frequencies are counted over all URLs, for the rules' tokens alone.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; the path goes on up to ``?``, ``#`` or the
end.  A null URL, or one without ``://``, has an empty host and path and is
allowed.  Every row gives one result row, repeated rows and null ids included;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
TOKEN = re.compile(r"[a-z0-9]+")
SQL_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    host: bool  # a host rule, which goes before pattern rules


def host_rule(action: str, rule: str) -> Rule:
    """``host/path``: the host and its subdomains, under a path that starts with ``/path``."""
    host, slash, path = rule.partition("/")
    prefix = slash + path
    tokens = TOKEN.findall(host)
    # The path's last token may go on in the URL's; it is literal only if the prefix ends it.
    inner = TOKEN.findall(prefix.lower())
    tokens += inner if not prefix or not TOKEN.match(prefix[-1].lower()) else inner[:-1]
    return Rule(rule, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(prefix)}",
                tuple(tokens), True)


def pattern_rule(action: str, name: str, pattern: str, tokens: tuple[str, ...]) -> Rule:
    """``pattern`` over ``host + path``; ``tokens`` are whole tokens that every match holds."""
    return Rule(name, action, pattern, tokens, False)


# The method's own rules: hosts that sell or promise by their name.
SPAM_RULES = [
    pattern_rule("block", f"spam:{word}", rf"^([^/]*[.:-])?{word}([.:-][^/]*)?(/|$)", (word,))
    for word in ("casino", "pills", "spam", "porn", "viagra", "warez", "betting", "lottery")
]


def host_of(url: Column) -> Column:
    """The lower-cased host, "" where there is none."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_frequencies(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs (tokens of no URL are left out)."""
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    listed = spark.createDataFrame([(t,) for t in wanted], "token string")
    found = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower("site"), F.lit(f"({SQL_TOKEN})"), 1))).alias("token"))
    # At most MAX_RULES rules: the list is bounded, and so is the result.
    return {r.token: r.n for r in found.join(F.broadcast(listed), "token", "left_semi")
            .groupBy("token").agg(F.count("*").alias("n")).collect()}


class Index:
    """Rules under their rarest token."""

    def __init__(self, rules: list[Rule], frequencies: dict[str, int]):
        self.rules, self.by_token, self.always = rules, {}, []
        for i, r in enumerate(rules):
            if r.tokens:
                rarest = min(r.tokens, key=lambda t: (frequencies.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(i)
            else:
                self.always.append(i)
        self.compiled: dict[int, re.Pattern] = {}

    def __getstate__(self):
        return {**self.__dict__, "compiled": {}}  # expressions are compiled where they run

    def fits(self, site: str) -> list[Rule]:
        """The rules that fit ``host + path``."""
        candidates = list(self.always)
        for token in set(TOKEN.findall(site.lower())):
            candidates += self.by_token.get(token, ())
        out = []
        for i in candidates:
            pattern = self.compiled.get(i)
            if pattern is None:
                pattern = self.compiled[i] = re.compile(self.rules[i].pattern)
            if pattern.search(site):
                out.append(self.rules[i])
        return out

    def judge(self, site: str) -> tuple[str | None, str, str | None]:
        """(host rule, verdict, pattern rule) of a site."""
        found = self.fits(site) if site else []
        hosts = [r for r in found if r.host]
        if hosts:
            best = max(hosts, key=lambda r: (len(r.name), r.name))
            return best.name, best.action, None
        others = sorted((r.action != "block", r.name) for r in found)
        if others:
            return None, "allow" if others[0][0] else "block", others[0][1]
        return None, "allow", None


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict, pattern`` for every row of ``pages``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are sent to the executors")
    url = F.col(url_col).cast("string")
    sites = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    site = F.concat("host", "path")
    index = Index(rules, token_frequencies(sites.select(site.alias("site")), rules))

    @F.pandas_udf("rule string, verdict string, pattern string")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([index.judge(s) for s in part], columns=["rule", "verdict", "pattern"])

    return sites.withColumn("j", judged(site)).select(
        id_col, "host", "path", "j.rule", "j.verdict", "j.pattern")
