"""The corpus pipeline: five operators of ``tessera.llm`` over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; every stage but the last returns the columns of ``docs``.
``run`` writes each result as Parquet in the shared folder and gives it, read
back, to the next stage.

1. ``language_id``: documents without an identified language (no text, no
   letter) go; without any labelled document none can be identified.
2. ``jaccard_join``: of each group of linked documents (5-word shingles,
   Jaccard similarity of 0.8) the one with the smallest id stays, the first by a
   hash of its row if ids are absent; documents without words are not linked.
3. ``suffix_dedup``: bytes under a 50-byte string that also starts in a
   document with a smaller id go, and documents of which nothing is left;
   ``n_chars`` follows the text.
4. ``decontamination``: documents that hold a test string of ``benchmark`` go.
5. ``sentencepiece``: ``doc_id, n_tokens, ids, decoded`` of what is left.

Extra columns of ``documents`` are carried through the first four stages,
whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, jaccard_join, language_id, sentencepiece_codec, suffix_dedup
from tessera.plans import write_through


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language_id.predict_languages(docs, keep=docs.columns)
    return judged.where(F.col("lang_pred") != language_id.UNKNOWN).select("kept.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each_group(docs, shingle=5, part=80, whole=100)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, keep=docs.columns)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).select("kept_columns.*")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.search_documents(docs, benchmark, keep=docs.columns)
    return found.where(~F.col("contaminated")).select("kept.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [("language_id", language_stage), ("jaccard_join", near_duplicate_stage), ("suffix_dedup", repeats_stage),
          ("decontamination", decontamination_stage), ("sentencepiece", encoding_stage)]

# the encoding cannot be expressed in SQL; tests compare every stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
