"""The documents behind TF-IDF are counted from their marks."""

import math

import pytest
from tessera import jobs
from tessera.operators import keywords
from testdata_dirs import SF_SMALL


@pytest.mark.parametrize("query", [jobs.q_tfidf, jobs.q_doc_keyword, jobs.q_tfidf_hashed])
def test_the_count_groups_no_words(spark, query):
    plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    by_word_and_document = [ln for ln in plan.splitlines() if "HashAggregate(keys=[word" in ln and ", doc#" in ln.split("functions")[0]]
    assert len(by_word_and_document) == 4, by_word_and_document  # the scores and the lookup side, two steps each


def test_repeated_and_missing_documents(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (1, "aa"), (2, "cc"), (None, "aa dd"), (None, "dd"), (3, "x"), (4, None)],
                                 "id long, t string")
    scores = keywords.tfidf(keywords.term_rows(keywords.prepare_documents(docs, "id", "t")))
    got = {(r.doc, r.word): (r.tf, round(r.tfidf, 9)) for r in scores.collect()}
    idf = lambda df: round(math.log(3 / (df + 1)), 9)  # noqa: E731 - documents 1 and 2 have a word and an id
    assert got == {(1, "aa"): (2, round(2 * math.log(3 / 2), 9)), (1, "bb"): (1, idf(1)), (2, "cc"): (1, idf(1)),
                   (None, "aa"): (1, idf(1)), (None, "dd"): (2, round(2 * math.log(3), 9))}
