import zlib

import numpy as np

from ingestflow.llm import lang_id
from ingestflow.llm.common import read_table
from tests.conftest import SF_MID

ROW = "doc_id long, text string, lang string, score string, lang_pred string"


def test_held_out_accuracy(spark):
    from ingestflow.llm.queries import op5_language
    docs = {r.doc_id: r for r in read_table(spark, SF_MID, "documents").collect()}
    got = op5_language(spark, SF_MID).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def phrases_by_hand(text, sample, block=lang_id.BLOCK):
    """Greedy longest phrases by plain substring search."""
    n = 0
    for a in range(0, len(text), block):
        part, i = text[a:a + block], 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in sample:
                j += 1
            n += 1
            i = max(i + 1, j - 1)
    return n


def test_tabulated_parsing_equals_substring_search():
    samples = (("a", ("the cat sat on the mat", "a dog barks")), ("b", ("el gato come pan", "un perro")))
    model = lang_id.Model(samples)
    texts = ["the dog sat", "el perro come", "zz top", "the cat sat on the mat", "q", "a" * 5000]
    rows = [model.symbols(t)[0] for t in texts]
    got = model.phrases(rows)
    for k, (_, parts) in enumerate(samples):
        whole = "#".join(parts)
        for t, row, n in zip(texts, rows, got[:, k], strict=True):
            # a phrase that fails at once is one character, so the counts are equal
            known = "".join(c if c in whole else "?" for c in lang_id._letters(t))
            assert n == phrases_by_hand(known, whole), t
            assert len(row) == len(known)


def test_suffix_automaton_knows_every_substring():
    text = [int(c) for c in np.random.default_rng(2).integers(1, 4, 60)]
    go = lang_id.suffix_automaton(text, 4)
    subs = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 6) + 1)}
    import itertools
    for n in (1, 2, 3, 4):
        for word in itertools.product((1, 2, 3), repeat=n):
            state = 0
            for c in word:
                state = go[state, c] if state >= 0 else -1
            assert (state >= 0) == (word in subs)


def run(spark, train, texts):
    samples = lang_id.learn(spark.createDataFrame(train, ROW))
    df = spark.createDataFrame([(i, t, None, "x", "y") for i, t in texts], ROW)
    return {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(df, samples).collect()}


TRAIN = [(1, "the quick brown fox jumps over the lazy dog and then the dog sleeps", "en", "", ""),
         (1, "the quick brown fox jumps over the lazy dog and then the dog sleeps", "en", "", ""),
         (2, "el zorro marrón salta sobre el perro perezoso y luego duerme la siesta", "es", "", ""),
         (3, None, "fr", "", ""), (4, "no language here", None, "", ""), (5, "123 456", "xx", "", "")]


def test_edge_cases(spark):
    got = run(spark, TRAIN, [(1, None), (2, ""), (3, "12 %% ?"), (4, "the dog"), (5, "el perro perezoso"),
                             (6, "the lazy dog " * 20000), (7, "漢字"), (None, "the fox")])
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[5][0] == "es" and got[6][0] == "en" and got[None][0] == "en"
    assert got[7][0] == "en"            # a tie: the language that sorts first
    assert 0 < got[7][1] <= 0.5 < got[4][1]


def test_no_labels_and_empty_tables(spark):
    assert run(spark, [(1, "text", None, "", "")], [(1, "text")]) == {1: ("und", 0.0)}
    assert run(spark, TRAIN, []) == {}


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "the dog", "zz", "s", "p")], ROW).withColumnRenamed("lang", "extra")
    got = lang_id.identify(df, lang_id.learn(spark.createDataFrame(TRAIN, ROW)))
    assert got.columns == ["doc_id", "text", "extra", "lang_pred", "score"]


def scripts():
    """Texts of five scripts, more letters than the table has, with the first language's letters the most."""
    rng = np.random.default_rng(9)
    starts = {"el": 0x3B1, "ja": 0x3042, "ko": 0xAC00, "ru": 0x430, "zh": 0x4E00}
    sizes = {"el": 17, "ja": 80, "ko": 400, "ru": 32, "zh": 600}
    words = {k: ["".join(chr(starts[k] + c) for c in rng.integers(0, sizes[k], 3)) for _ in range(60)] for k in starts}
    return {k: [" ".join(rng.choice(w, 40)) for _ in range(12)] for k, w in words.items()}


def test_every_script_is_told_apart_whatever_its_letters():
    texts = scripts()
    model = lang_id.Model(tuple((k, tuple(t[:8])) for k, t in sorted(texts.items())))
    assert model.rare > 300
    for k, parts in texts.items():
        langs, scores = model.predict(parts[8:])
        assert langs == [k] * 4 and min(scores) > 0.5


def test_rare_letters_are_parsed_as_by_substring_search():
    texts = scripts()
    samples = tuple((k, tuple(t[:8])) for k, t in sorted(texts.items()))
    model = lang_id.Model(samples)
    mixed = [t[9] + " " + u[10] for t in texts.values() for u in texts.values()] + ["漢 qq " + texts["zh"][9]]
    rows = [model.symbols(t)[0] for t in mixed]
    got = model.phrases(rows)
    for k, (_, parts) in enumerate(samples):
        whole = "#".join(parts)
        for t, n in zip(mixed, got[:, k], strict=True):
            assert n == phrases_by_hand("".join(c if c in whole else "?" for c in lang_id._letters(t)), whole)


def test_pipeline_stage_rejects_texts_of_no_learned_language(spark):
    import corpus_pipeline
    rows = [(n, t, k, "x", "y") for k, parts in scripts().items() for n, t in enumerate(parts)]
    rows += [(100, "the quick brown fox", None, "", ""), (101, "12 %", None, "", ""), (102, None, None, "", "")]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, ROW), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(n for n, *_ in rows if n < 100)
    assert kept[0].score == "x" and kept[0].lang_pred == "y"


def test_a_language_without_ids_or_of_copies_is_learned(spark):
    rows = [(None, f"the quick brown fox {chr(97 + n % 26)}{chr(97 + n // 26)} jumps", "en", "", "")
            for n in range(600)]
    rows += [(n, ("el zorro salta", "un perro duerme")[n == 0], "es", "", "") for n in range(3000)]
    samples = dict(lang_id.learn(spark.createDataFrame(rows, ROW)))
    assert len(samples["en"]) == lang_id.SAMPLE_DOCS
    assert sorted(samples["es"]) == ["el zorro salta", "un perro duerme"]
