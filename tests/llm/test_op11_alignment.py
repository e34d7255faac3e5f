"""Cross-tokenizer alignment against a plain version over whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ingestflow.llm import token_alignment as ta
from ingestflow.llm.bpe import byte_symbols
from ingestflow.llm.common import Workspace
from ingestflow.llm.queries import op11_token_alignment
from tests.conftest import SF_SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), whole texts at once."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    symbols = {s: k for k, s in enumerate(byte_symbols())}
    vocabulary = {k: s for s, k in a.get_vocab().items()}

    def piece_b(k):
        piece = b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

    grouped = []
    for t in texts:
        groups = []
        if t:
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            parts_a = [bytes(symbols[c] for c in vocabulary[k]) for k in ids_a]
            parts_b = [piece_b(k) for k in ids_b]
            if b"".join(parts_a) == b"".join(parts_b) == (" " + t).encode():
                ends_a, ends_b, n = [], [], 0
                for p in parts_a:
                    ends_a.append(n := n + len(p))
                n = 0
                for p in parts_b:
                    ends_b.append(n := n + len(p))
                at = 0
                for cut in sorted(set(ends_a) & set(ends_b)):
                    groups.append(([k for k, e in zip(ids_a, ends_a, strict=True) if at < e <= cut],
                                   [k for k, e in zip(ids_b, ends_b, strict=True) if at < e <= cut]))
                    at = cut
        grouped.append(groups)
    counts = Counter()
    links = []
    for groups in grouped:
        of = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        links.append(of)
        counts.update(of.keys())
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for groups, of in zip(grouped, links, strict=True):
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups),
                    sum(of.values()), sum(m for p, m in of.items() if counts[p] == most[p[0]]),
                    sum(m * counts[p] for p, m in of.items()),
                    ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)))
    return out, counts, most


HARD = [None, "", " ", "   ", "a", " a", "a ", "  a  b ", "a\tb c\n d", "<|endoftext|> <s> </s> <0x41>",
        "▁x", "x ▁ y", "日本 語の text", "é é ﬁ ſ", "a b　c d", "naïve😀 😀😀 x", "\x00 \x07 a",
        "x" * 5000, "ab" * 300 + " " + "1234567890" * 50, "the " * 400, "a  \n\n  b", "he said 'it's' can't",
        "é n", "ünïcödé wörds hère", "repeated", "repeated", "repeated"]


def rows_of(df):
    return sorted((r["doc_id"], *(r[c] for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"))) for r in df.collect())


def test_hard_texts(spark):
    docs = spark.createDataFrame([(k, t, "z", 1) for k, t in enumerate(HARD)],
                                 "doc_id long, text string, radix string, run int").repartition(3)
    expected, counts, most = brute(HARD)
    ws = Workspace(spark, "t11")
    assert rows_of(ta.align(docs, A, B, ws)) == sorted((k, *r) for k, r in enumerate(expected))
    assert any(r[0] == 0 and t for t, r in zip(HARD, expected, strict=True))  # one is not given back
    spilled = ta.spill(docs, A, B, Workspace(spark, "t11"))
    shift = ta.vocabulary_shift(B)
    pairs = ta.pair_counts(ta.count_pairs(spilled, Workspace(spark, "t11"), shift), shift).collect()
    assert {(r[0], r[1]): r[2] for r in pairs} == dict(counts) and len(pairs) == len(counts)
    assert all(r["best"] == (r["n_docs"] == most[r["a_id"]]) for r in pairs)


@pytest.mark.parametrize("links,target,radixes", [(2_000, 2_000, 4), (50, 600, 2), (3_000_000, 1 << 24, 64)])
def test_many_runs_and_merges(spark, monkeypatch, links, target, radixes):
    """Small runs, salted radixes and several rounds of merging give the same rows."""
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
             .select("text").limit(60).collect()] + ["the same text"] * 80 + HARD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    monkeypatch.setattr(ta, "TARGET_BYTES", target)
    monkeypatch.setattr(ta, "FAN_IN", 3)
    default = ta.Spill.full
    monkeypatch.setattr(ta.Spill, "full", lambda self: self.links >= links or default(self))
    table = ta.align(docs, A, B, Workspace(spark, "t11"), radixes=radixes)
    expected = sorted((k, *r) for k, r in enumerate(brute(texts)[0]))
    assert rows_of(table) == expected


def test_wide_groups(spark, monkeypatch):
    """Groups beyond the limit pair distinct ids; results stay the same."""
    texts = ["internationalization misspelt", "antidisestablishmentarianism zzzqqq"] + HARD
    plain, wide = ta.Aligner(A, B), ta.Aligner(A, B)
    narrow = list(plain.align(texts))
    monkeypatch.setattr(ta, "WIDE_GROUP", 0)
    for (g0, c0, w0, s0), (g1, c1, w1, s1) in zip(narrow, wide.align(texts), strict=True):
        assert (g0, s0) == (g1, s1) and not w0 and not len(c1)
        a, b = ta.Spill(plain, 8), ta.Spill(wide, 8)
        a.add(c0, w0)
        b.add(c1, w1)
        assert [(r, *map(bytes, x)) for r, *x in a.runs()] == [(r, *map(bytes, x)) for r, *x in b.runs()]


def test_pieces_are_kept_within_bounds():
    aligner = ta.Aligner(A, B)
    words = [f"w{k}x{k * 7}" for k in range(400)]
    first = [x[0] for x in aligner.align([" ".join(words)])]
    aligner.kept_bytes = ta.CACHE_BYTES  # the next new piece lets a generation go
    list(aligner.align(["onemorenewpiece"]))
    assert not aligner.newer and aligner.older
    assert [x[0] for x in aligner.align([" ".join(words)])] == first


def test_empty_table_null_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align(empty, A, B, Workspace(spark, "t11")).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a"), (1, None)], "doc_id int, text string")
    got = ta.align(docs, A, B, Workspace(spark, "t11")).collect()
    assert sorted((r["doc_id"] or -1, r["n_a"], r["count_sum"]) for r in got) == \
        [(-1, 2, 5), (-1, 2, 5), (1, 0, 0), (1, 1, 3)]


def test_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_token_alignment(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    expected = brute([r["text"] for r in docs])[0]
    for r, e in zip(docs, expected, strict=True):
        digest = hashlib.sha256(e[-1].encode()).hexdigest() if e[0] else ""
        assert got[r["doc_id"]] == (*e[:-1], digest)
    assert len(got) == len(docs)
