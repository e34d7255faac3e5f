import hashlib
import itertools
import re

import numpy as np
import pytest

from ingestflow.llm import secrets as sc
from ingestflow.llm.common import read_table
from tests.conftest import SF_MID

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def base_by_hand(text):
    out = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    for m in re.finditer(rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(1)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for order, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_base_spans_of_documents(spark):
    from ingestflow.llm.queries import op10_secrets
    docs = {r.doc_id: r.text or "" for r in read_table(spark, SF_MID, "documents").collect()}
    got = op10_secrets(spark, SF_MID).collect()
    assert len(got) == len(docs)
    found = 0
    for r in got:
        want = base_by_hand(docs[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want)
                                                     for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}
        found += len(want)
    assert found > 20
    # clean documents stay clean
    assert sum("crf" in r.spans for r in got if r.n_assign + r.n_access + r.n_hex == 0) <= 0.01 * len(got)


@pytest.mark.parametrize("text", [
    'tOkEn = "abc" secret:abcdef', "password=a=b=c=d", f"x{HEX}y {HEX}", "AKIA" + "A" * 16, "AKIA" + "B" * 15,
    "tokentoken: abcdef", "apikey:'abc.def'", "é" * 5 + " passwd : hunter22 é", "abcdef0123" * 4, "toKen= x",
    "ſecret=abcdefgh toKen=abcdefgh", ""])
def test_base_spans(text):
    got = [f"{k}:{a}:{b}" for a, k, b in sorted(sc.base_spans(text), key=lambda s: (s[0], sc.KINDS.index(s[1])))]
    assert got == base_by_hand(text)


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(7)
    words = ["the", "rend", "ation", "of", "was", "thing", "over", "stone."]

    def prose(n):
        return " ".join(rng.choice(words, n))

    def digits():
        return "".join(rng.choice(list("0123456789abcdef"), 40))

    texts = [f'{prose(20)} token = "{digits()}" {prose(20)}' for _ in range(60)] + \
            [prose(60) + " 152.143.123.131 4785380592391139 us.17@mail3.example.com" for _ in range(60)]
    return sc.fit(texts)


def test_the_field_finds_what_the_patterns_miss(field):
    text = 'the stone. key = "zK4mQ8xT1pV7nB3cR9dL2sWf" over'
    assert sc.base_spans(text) == []
    spans = sc.scan_text(text, field)
    assert spans and text[spans[0][0]:spans[0][2]].strip('"') == "zK4mQ8xT1pV7nB3cR9dL2sWf"
    assert sc.scan_text("the rend was over the stone. 152.143.123.131 thing", field) == []


def test_field_recalls_the_patterns_on_unseen_values(field):
    rng = np.random.default_rng(11)
    hits = 0
    for _ in range(50):
        value = "".join(rng.choice(list("0123456789abcdef"), 40))
        text = f'of was token = "{value}" thing over'
        tokens = sc.Tokens(text)
        begin = np.flatnonzero(field.tags(tokens) == sc.BEGIN)
        hits += any(tokens.start[t] <= text.index(value) < tokens.end[t] for t in begin)
    assert hits >= 45


def test_viterbi_with_islands_equals_all_paths(field):
    rng = np.random.default_rng(3)
    for _ in range(20):
        e, step = rng.normal(size=(7, 3)) * 4, rng.normal(size=(3, 3))
        e[:, 0] += 3
        best = max((p for p in itertools.product(range(3), repeat=7)
                    if p[0] != 2 and all((a, b) != (0, 2) for a, b in zip(p, p[1:]))),
                   key=lambda p: sum(e[t, y] for t, y in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:])))
        got = np.zeros(7, int)
        doubt = sc._doubtful(e, step)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], doubt, [0]]).astype(int)))
        for a, b in edges.reshape(-1, 2):
            got[a:b] = sc._viterbi(e[a:b], step, a > 0, b < 7)
        assert tuple(got) == best


def test_tokens():
    t = sc.Tokens('a key="Zz9" !x  é')
    text = 'a key="Zz9" !x  é'
    assert [text[a:b] for a, b in zip(t.start, t.end)] == ["a", "key=", '"', "Zz9", '"', "!", "x", "é"]
    assert sc.Tokens(" \n").start.size == 0


def test_edge_cases(spark, field):
    rows = [(1, None, "a"), (2, "", "a"), (3, f"t {HEX}", "a"), (3, f"t {HEX}", "a"), (None, "plain", "a"),
            (4, "word " * 50000 + HEX, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sc.scan(df, field).collect()
    assert [len(r.spans) for r in got] == [0, 0, 1, 1, 0, 1]
    masked = [r.text for r in sc.mask(df, field).collect()]
    assert masked[:5] == [None, "", "t [SECRET]", "t [SECRET]", "plain"]
    assert masked[5].endswith("word [SECRET]")
    assert sc.scan(df.limit(0), field).collect() == []
    assert not sc.learn(df.limit(0)).trained
    assert sc.mask_text("abcdef", [(0, "hex", 4), (2, "crf", 5)]) == "[SECRET]f"


def test_untrained_field_adds_nothing(spark):
    df = spark.createDataFrame([(1, "only clean words here")], "doc_id long, text string")
    plain = sc.learn(df)
    assert not plain.trained
    assert sc.scan_text(f"x {HEX}", plain) == [(2, "hex", 42)]


def test_further_tokens_of_a_value_are_inside():
    text = "of token = 'abcdef12==' was"
    tokens = sc.Tokens(text)
    y = tokens.labels(sc.values(text, sc.base_spans(text)))
    assert [text[a:b] for a, b in zip(tokens.start[y == sc.BEGIN], tokens.end[y == sc.BEGIN])] == ["abcdef12="]
    assert [text[a:b] for a, b in zip(tokens.start[y == sc.INSIDE], tokens.end[y == sc.INSIDE])] == ["="]


def test_the_field_finds_values_of_several_tokens_whole(field):
    rng = np.random.default_rng(5)
    hits, masked = 0, 0
    for n in range(50):
        part = ["".join(rng.choice(list("abcdefghijKLMNOPQRSTUVWXYZ0123456789"), rng.integers(5, 10))) for _ in range(3)]
        value = part[0] + "$:@!"[n % 4] + part[1] + "@!:$"[n % 4] + part[2] + ("", "==")[n % 2]
        text = f'the stone. key = "{value}" over the thing'
        hits += [text[a:b] for a, _, b in sc.scan_text(text, field)] == [value]
        # the pattern takes the first part, the field the rest
        text = f'the stone. token = "{value}" over the thing'
        left = sc.mask_text(text, sc.scan_text(text, field))
        masked += not any(p in left for p in part)
        assert left.endswith(" over the thing")
    assert hits >= 40 and masked >= 45


def test_samples_are_of_different_texts_whatever_their_copies(spark):
    from pyspark.sql import functions as F

    from ingestflow.llm.common import hash_sample
    rows = spark.range(20000).select((F.col("id") % 2).alias("g"), F.xxhash64(F.col("id") % 40).alias("h"),
                                     (F.col("id") % 40).alias("v"))
    want = {g: sorted((r.h, r.v) for r in rows.distinct().collect() if r.g == g)[:5] for g in (0, 1)}
    got = hash_sample(rows, "g", 5, "h")
    assert {g: sorted((r.h, r.v) for r in got if r.g == g) for g in (0, 1)} == want
    # so few hashes lie low that a first draw misses them
    high = rows.where("h > 0")
    assert len(hash_sample(high.where("g = 0"), "g", 3, "h")) == 3


def test_a_field_is_trained_on_copies(spark):
    from pyspark.sql import functions as F
    text = F.format_string("the stone was token = \"%040x\" over the thing", F.col("id") % 3)
    docs = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, text).otherwise("the thing").alias("text"))
    assert sc.learn(docs).trained
