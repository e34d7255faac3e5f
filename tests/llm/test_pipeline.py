import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ingestflow.llm import secrets as sc
from tests.llm.test_op4_minhash import brute as components
from tests.llm.test_op8_decontaminate import brute as contaminated

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def prose(rng, n):
    return " ".join(rng.choice(["stone", "river", "went", "over", "the", "and", "hill", "green", "blue", "song"])
                    + rng.choice(["", "s", "ed"]) for _ in range(n))


def rows():
    rng = random.Random(9)
    out = [(i, prose(rng, 40), "en", "s", None) for i in range(20)]
    base = prose(rng, 80)
    out += [(30 + i, base, "en", "hot", len(base)) for i in range(6)]
    out += [(40, base + " tail", None, "hot", 1)]
    out += [(50, prose(rng, 10) + " " + ITEM.upper() + " x", "en", "s", 1), (51, None, "en", "s", None),
            (52, "", "en", "s", 0), (53, "12 34 !!", "en", "s", 8), (54, f"{prose(rng, 9)} {HEX} end", "en", "s", 5),
            (54, f"{prose(rng, 9)} {HEX} end", "en", "s", 5), (None, prose(rng, 50), None, None, None)]
    return out


def write(spark, path, docs):
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_against_brute_force(spark, tmpdir_path):
    docs = rows()
    write(spark, tmpdir_path, docs)
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in cp.run(spark, tmpdir_path).collect())
    kept = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    kept = list(dict.fromkeys(kept))                              # rows repeated in full
    comp = {c[0]: c[2] for c in components([d[:2] for d in kept], 80)}
    kept = [d for d in kept if d[0] == comp[d[0]]]
    bad = {c[0] for c in contaminated([d[:2] for d in kept], [(1, ITEM)]) if c[5]}
    kept = [d for d in kept if d[0] not in bad]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d in kept:
        text = sc.mask_text(d[1], sorted(sc.base_spans(d[1])))
        ids = lib.encode(text, add_special_tokens=False).ids
        want.append((d[0] is None, d[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert {d[0] for d in kept} == {*range(20), 30, 54, None}


def test_stages_keep_the_columns(spark, tmpdir_path):
    write(spark, tmpdir_path, rows())
    docs = spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "encode"]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, tmpdir_path)
        assert out.dtypes == docs.dtypes, name
    masked = {r.doc_id: r for r in cp.masked(spark, docs, tmpdir_path).collect()}
    assert masked[54].text.endswith("[SECRET] end") and masked[54].n_chars == len(masked[54].text)
    assert masked[0].n_chars is None and masked[40].n_chars == 1


def test_empty_documents(spark, tmpdir_path):
    write(spark, tmpdir_path, [])
    assert cp.run(spark, tmpdir_path).collect() == []
