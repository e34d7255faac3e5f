"""The registered ``opN_*`` queries over the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestflow.llm import (ann, bpe, chat, decontaminate, hard_negatives, html_wrappers, lang_id, minhash,
                            quality_ranking, secrets, token_alignment, token_counts, url_rules)
from ingestflow.llm.common import Workspace, read_table, small_batches


def op1_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = ann.build_index(vectors, Workspace(spark, "op1"))
    return ann.search(index, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    wrappers = html_wrappers.infer(pages, Workspace(spark, "op2"))
    return html_wrappers.main_text(pages, wrappers).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation written as a transcript, in a style drawn by its id, and parsed back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pieced = chat.pieces(rows, Workspace(spark, "op3"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(chat.STYLES)))
    written = chat.write_transcripts(pieced, style)
    right = F.size(F.filter(F.zip_with("line_roles", "found_roles", lambda a, b: a == b), lambda x: x))
    return chat.recover(written, chat.learn(rows)).select(
        "conv_id", "piece", "part", F.size("turns").cast("long").alias("n_turns"),
        F.size("line_roles").cast("long").alias("n_lines"), right.cast("long").alias("n_right"),
        F.concat_ws(",", F.transform("turns", lambda t: t["role"])).alias("roles"), "rendered")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, Workspace(spark, "op4"), percent=85)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = lang_id.learn(lang_id.training_rows(docs))
    return lang_id.identify(docs, samples).select(
        "doc_id", lang_id.held_out(docs).alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json")) \
        .withColumn("over_limit", F.col("n_tokens") > 2048)


# The rules of the registered query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = [url_rules.host_rule(action, rule) for action, rule in URL_RULES]
    return url_rules.judge(pages, rules + url_rules.SPAM_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    index = decontaminate.build_index(docs, Workspace(spark, "op8"))
    matches = decontaminate.find_windows(index, read_table(spark, sf_dir, "benchmark"), size=10)
    return decontaminate.document_hits(index, matches)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, path))


def span_digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the spans of :func:`secrets.scan`."""
    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digests(secrets.scan(docs, secrets.learn(docs)))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        Workspace(spark, "op11"), shown=lambda groups: hashlib.sha256(groups.encode()).hexdigest()) \
        .withColumnRenamed("groups", "groups_sha256")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality").where(quality_ranking.learns())
    scored = quality_ranking.score(docs, quality_ranking.learn(docs, labels))
    return scored.select("doc_id", quality_ranking.held_out().alias("held_out"), "score", "predicted")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; ids divisible by 7 take the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_rows(read_table(spark, sf_dir, "embeddings"), Workspace(spark, "op13"),
                                       label=label)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, Workspace(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_graph_search": op1_graph_search,
    "op2_main_text": op2_main_text,
    "op3_transcripts": op3_transcripts,
    "op4_minhash": op4_minhash,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_url_rules": op7_url_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_bpe": op9_bpe,
    "op10_secrets": op10_secrets,
    "op11_token_alignment": op11_token_alignment,
    "op12_quality": op12_quality,
    "op13_hard_negatives": op13_hard_negatives,
}
