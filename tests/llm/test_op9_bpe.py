import hashlib
import random
import unicodedata

import public_tokenizers
from tokenizers import Tokenizer

from ingestflow.llm import bpe
from ingestflow.llm.common import read_table
from tests.conftest import SF_MID

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


def test_documents_equal_the_library(spark):
    from ingestflow.llm.queries import op9_bpe
    lib = library()
    docs = {r.doc_id: r.text or "" for r in read_table(spark, SF_MID, "documents").collect()}
    ids = dict(zip(docs, (e.ids for e in lib.encode_batch(list(docs.values()), add_special_tokens=False)),
                   strict=True))
    got = op9_bpe(spark, SF_MID).collect()
    assert len(got) == len(docs)
    for r in got:
        want = ids[r.doc_id]
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        back = lib.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_odd_texts_equal_the_library():
    mine, lib, rng = bpe.load(PATH), library(), random.Random(1)
    chars = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    parts = ["<|endoftext|>", "'ll", "'S", " the", "  ", "\n\n", "\t", "\x85", "\xa0", "_", "1²", "½", "__a"]
    for _ in range(4000):
        text = "".join(rng.choice(chars) if rng.random() < 0.4 else rng.choice(parts)
                       for _ in range(rng.randint(0, 15)))
        want = lib.encode(text, add_special_tokens=False).ids
        assert mine.encode(text).tolist() == want, repr(text)
        assert mine.decode(want) == lib.decode(want, skip_special_tokens=False) == text


def test_latin_texts_take_the_same_cuts():
    mine, rng = bpe.load(PATH), random.Random(2)
    chars = [chr(c) for c in range(0x250)]
    for _ in range(3000):
        text = "".join(rng.choice(chars) for _ in range(12))
        if not mine.unusual.search(text):
            assert mine.split_latin.findall(text) == mine.split.findall(text), repr(text)


def test_merge_order_by_plain_rescanning():
    """The queue gives what taking the best-ranked, leftmost pair again and again gives."""
    mine, rng = bpe.load(PATH), random.Random(3)
    for _ in range(500):
        data = bytes(rng.choice(b"theranso ") for _ in range(rng.randint(1, 24)))
        ids = [mine.byte_ids[b] for b in data]
        while True:
            ranks = [(mine.merges.get(a << bpe.ID_BITS | b), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
            best = min((r for r in ranks if r[0] is not None), default=None)
            if best is None:
                break
            ids[best[1]:best[1] + 2] = [best[0] & (1 << bpe.ID_BITS) - 1]
        assert mine.merge(data) == ids


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    mine, lib = bpe.ByteBpe(PATH), library()
    text = " one two three four five one two six seven one"
    for _ in range(3):
        assert mine.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "hi hi", "a"), (3, "hi hi", "a"), (None, "hi", "a"),
            (4, "ab" * 100_000, "a"), (5, "word " * 50_000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert got == bpe.round_trip(df, PATH).collect()
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    assert [r.decoded for r in got] == [r[1] or "" for r in rows]
    assert got[0].ids == got[1].ids == []
    lib = library()
    assert got[5].ids == lib.encode("ab" * 100_000, add_special_tokens=False).ids
    empty = df.limit(0)
    assert bpe.digests(bpe.decode(bpe.encode(empty, PATH), PATH)).collect() == []
    assert bpe.round_trip(empty, PATH).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(nulls, PATH).collect()[0].decoded == ""
