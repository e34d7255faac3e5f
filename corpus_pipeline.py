"""From raw documents to token ids: five stages, each one operator of ``ingestflow.llm``.

Every stage takes the documents that its predecessor kept and returns the
columns of ``documents``; the last returns ids.  Nulls, empty and very long
texts, repeated rows, empty tables and extra columns are handled as the
operators' docstrings say:

1. language: documents without a language (null or empty text, no letter, or
   characters of which no learned language knows two in a row) go; the model
   learns from the labelled documents of the stage's input.
2. near_duplicates: of each group of near copies, at 0.8 or more, the document
   with the smallest id stays.
3. decontaminate: documents that hold a window of a benchmark item go.
4. secrets: every secret's span is replaced by ``[SECRET]`` and ``n_chars`` is
   counted anew where the text changed.
5. encode: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the byte-level
   BPE ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestflow.llm import bpe, decontaminate, lang_id, minhash, secrets
from ingestflow.llm.common import Workspace, broadcast_if_small, read_table, small_batches


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return lang_id.of_known_language(docs, lang_id.learn(lang_id.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.keep_one(docs, Workspace(spark, "pipeline-near"), percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    ws = Workspace(spark, "pipeline-benchmark")
    benchmark = read_table(spark, sf_dir, "benchmark")
    numbered = ws.write(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    index = decontaminate.build_index(numbered, ws, id_col="__row")
    hits = decontaminate.document_hits(index, decontaminate.find_windows(index, benchmark), "__row")
    gone = ws.write(hits.where("contaminated").select("__row"), "gone")
    ws.drop("index")
    return numbered.join(broadcast_if_small(gone), "__row", "left_anti").drop("__row")


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = secrets.mask(docs.withColumn("__text", F.col("text")), secrets.learn(docs))
    changed = ~F.col("text").eqNullSafe(F.col("__text"))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.round_trip(docs, path))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("secrets", masked),
    ("encode", encoded),
]

# Language identification and the random field's spans have no SQL form; the tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name)
    return docs
