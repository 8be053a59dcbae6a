"""Incremental word counts over a growing document folder.

The batch word count re-expressed for Structured Streaming: the same
tokenising expression, a streaming aggregate whose per-word state lives in
the state store (checkpointed, so a restarted query resumes where it left
off), and ``update`` output — only words whose count changed are emitted per
micro-batch.  New files are picked up as they land; ``maxFilesPerTrigger``
bounds each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import has_word, word_tokens

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document_stream(spark: SparkSession, folder: str, schema: str = DOCUMENT_SCHEMA, glob: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def streaming_word_counts(docs: DataFrame, text_col: str = "text", cjk_bigrams: bool | Column = False) -> DataFrame:
    """Running ``word, n`` over a streaming document DataFrame."""
    kept = docs.where(F.col(text_col).isNotNull() & has_word(text_col, cjk_bigrams))
    return (kept.select(F.explode(word_tokens(text_col, cjk_bigrams)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def start_word_counts(counts: DataFrame, checkpoint: str, sink: str = "memory", query_name: str = "word_counts",
                      output_mode: str = "update", **options) -> StreamingQuery:
    """Start the query.  ``checkpoint`` must be a shared, durable folder."""
    w = counts.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).format(sink)
    if sink == "memory":
        w = w.queryName(query_name)
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()
