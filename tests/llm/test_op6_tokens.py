import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ingestflow.llm import token_counts as tc
from ingestflow.llm.common import read_table
from tests.conftest import SF_MID

WORD = public_tokenizers.path("word_bpe_49k.json")


def whole(texts, path=WORD):
    return [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_documents_equal_whole_text_encoding(spark):
    from ingestflow.llm.queries import op6_token_counts
    docs = {r.doc_id: r.text or "" for r in read_table(spark, SF_MID, "documents").collect()}
    ids = sorted(docs)
    want = dict(zip(ids, whole([docs[i] for i in ids]), strict=True))
    got = op6_token_counts(spark, SF_MID).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.n_bytes) == (want[r.doc_id], len(docs[r.doc_id].encode()))
        assert r.over_limit == (r.n_tokens > 2048)


def test_pieces_equal_whole_texts_on_odd_texts():
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "it's", "'ll", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0",
             "é", "́", "ΑΣ", "İ", "ﬁ", "𝔘", "漢字", "1", "23", "!?", "a", "ß", " ", "‍", "가", "ᄀ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert tc.Counter(WORD).count(texts) == whole(texts)


def test_small_batches_and_caches(monkeypatch):
    monkeypatch.setattr(tc, "BATCH_BYTES", 8)
    monkeypatch.setattr(tc, "CACHE_ENTRIES", 5)
    c = tc.Counter(WORD)
    texts = ["one two three four five six seven", "x" * 50, "two three nine ten eleven twelve"]
    for _ in range(3):
        assert c.count(texts) == whole(texts)


def test_only_known_splitters_are_cut(tmp_path):
    assert tc.drops_blanks(WORD)
    assert not tc.drops_blanks(public_tokenizers.path("byte_bpe_50k.json"))
    spec = json.load(open(WORD))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] += "| x"
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    assert not tc.drops_blanks(str(other))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(name):
    path = public_tokenizers.path(name)
    texts = ["Hello  world <|endoftext|>", "", "ü 12"]
    got = tc.Counter(path).count(texts)
    if name.endswith(".json"):
        assert got == whole(texts, path)
    else:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert got == [len(model.encode(t)) for t in texts]


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "word " * 30000, "a"), (3, "word " * 30000, "a"),
            (None, "ü", "a"), (5, "z" * 100000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in tc.token_counts(df, WORD).collect()]
    assert got[:5] == [(1, 0, 0), (2, 0, 0), (3, 150000, 30000), (3, 150000, 30000), (None, 2, 1)]
    assert got[5][2] == whole(["z" * 100000])[0]
    assert tc.token_counts(df.limit(0), WORD).collect() == []
