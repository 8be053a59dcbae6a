"""Same results whatever the input partitioning."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import categories, keywords
from testdata_dirs import SF_SMALL


def _docs(spark, parts):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return d if parts is None else d.repartition(parts)


def _scores(spark, parts):
    docs = _docs(spark, parts)
    prep = keywords.prepare_documents(docs, "doc_id", "text")
    tfidf = keywords.tfidf(keywords.term_rows(prep), keywords.document_count(prep))
    return (sorted((r.doc, r.word, r.tf, round(r.tfidf, 9)) for r in tfidf.collect()),
            sorted(tuple(r) for r in keywords.doc_keyword(tfidf).collect()),
            sorted(tuple(r) for r in keywords.word_counts(prep).collect()))


@pytest.mark.parametrize("parts", [1, 17])
def test_text_jobs_invariant(spark, parts):
    assert _scores(spark, parts) == _scores(spark, None)


@pytest.mark.parametrize("parts", [1, 17])
def test_category_index_invariant(spark, parts):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    def run(df):
        pv = categories.position_values(df, "c_custkey", ["c_mktsegment", "c_nationkey"])
        d = categories.category_index(pv)
        enc = categories.category_encode(pv, d, "c_custkey")
        return sorted(tuple(r) for r in d.collect()), sorted((r.c_custkey, tuple(r.features)) for r in enc.collect())
    assert run(c.repartition(parts)) == run(c)


def test_salt_count_does_not_change_tfidf(spark):
    prep = keywords.prepare_documents(_docs(spark, None), "doc_id", "text")
    found = []
    for partitions in ("1", "5"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            scores = keywords.tfidf(keywords.term_rows(prep), keywords.document_count(prep))
            found.append(sorted((r.doc, r.word, round(r.tfidf, 9)) for r in scores.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1] and found[0]
