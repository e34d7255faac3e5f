import re

from ingestflow.llm import url_rules as ur

ROW = "page_id long, url string, host string, verdict string"
RULES = [ur.host_rule(a, r) for a, r in
         [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
          ("block", "net/es/"), ("block", "net/fr/")]] + ur.SPAM_RULES

URLS = {
    1: ("https://example.com/en/1", "example.com/en/", "block"),
    2: ("http://WWW.Example.com/en/x?q#f", "www.example.com/en/", "allow"),
    3: ("http://a.www.example.com/en/", "www.example.com/en/", "allow"),
    4: ("http://notexample.com/en/1", "com/", "allow"),
    5: ("http://x.example.com", None, "allow"),
    6: ("http://a.net/es/2", "net/es/", "block"),
    7: ("http://a.net/es", None, "allow"),
    8: ("http://www.casino-win.example.org/en/1", None, "block"),
    9: ("http://casino.example.com/x", "com/", "allow"),
    10: (None, None, "allow"),
    11: ("no scheme/net/es/", None, "allow"),
    12: ("", None, "allow"),
    13: ("http://a.net/fr/" + "x" * 100000, "net/fr/", "block"),
    14: ("http://net/es/", "net/es/", "block"),
    15: ("http:///en/", None, "allow"),
    16: ("http://a.net/ES/", None, "allow"),
    17: ("http://occasinos.example.org/", None, "allow"),
}


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in rows], ROW)


def test_rules_hosts_and_edge_cases(spark):
    got = {r.page_id: r for r in ur.judge(frame(spark, [(i, u[0]) for i, u in URLS.items()]), RULES).collect()}
    assert {i: (r.rule, r.verdict) for i, r in got.items()} == {i: u[1:] for i, u in URLS.items()}
    assert (got[2].host, got[2].path) == ("www.example.com", "/en/x")
    assert (got[10].host, got[10].path) == ("", "") == (got[11].host, got[11].path)
    assert got[15].path == "/en/"


def test_index_equals_trying_every_rule():
    sites = [f"{h}{p}" for h in ("a.com", "example.com", "b.net", "spam-farm.net", "www.example.com", "x.org")
             for p in ("", "/", "/en/1", "/es/", "/fr", "/fr/2")]
    for freq in ({}, {"com": 9, "net": 9, "en": 1, "es": 1}):
        index = ur.Index(RULES, freq)
        for s in sites:
            assert {r.name for r in index.fits(s)} == {r.name for r in RULES if re.search(r.pattern, s)}


def test_only_candidates_run():
    index = ur.Index(RULES, {"com": 1000, "example": 900, "en": 10, "net": 500, "es": 5, "fr": 5})
    index.fits("a.b.net/de/1")
    assert not index.compiled
    index.fits("b.net/es/1")
    assert [RULES[i].name for i in index.compiled] == ["net/es/"]


def test_rare_tokens_are_counted_over_the_urls(spark):
    df = spark.createDataFrame([("a.com/en/en",), ("b.com/es/",), (None,)], "site string")
    assert ur.token_frequencies(df, RULES) == {"com": 2, "en": 1, "es": 1}


def test_rules_without_tokens_and_repeated_rows(spark):
    rules = [ur.pattern_rule("block", "long", r"^.{20}", ())]
    got = ur.judge(frame(spark, [(1, "http://a.de/")] * 2 + [(None, "http://a.de/" + "y" * 30)]), rules).collect()
    assert sorted((r.page_id is None, r.verdict) for r in got) == [(False, "allow")] * 2 + [(True, "block")]
    assert ur.judge(frame(spark, []), RULES).collect() == []
