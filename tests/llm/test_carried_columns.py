"""Ids and carried columns are not changed by what happens to the text."""

import datetime
import decimal

import corpus_pipeline as P
import public_tokenizers
import pytest
from tessera.llm import decontaminate, jaccard_join, language_id, sentencepiece_codec
from tessera.plans import write_through

LARGE = 9007199254740993  # 2^53 + 1
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, when timestamp_ntz, money decimal(38,5), "
          "raw binary, tags map<string,bigint>, pair struct<a:bigint,b:date>, large bigint")


@pytest.fixture(scope="module")
def docs(spark):
    words = "the cat sat on the mat and looked at all the other cats near the old house by the river"
    far = (datetime.datetime(2500, 1, 2, 3, 4, 5), decimal.Decimal("123456789012345678901234567890123.45678"), b"\x00\xff",
           {"k": LARGE}, (LARGE, datetime.date(9999, 12, 31)), LARGE)
    none = (None,) * 6
    rows = [(LARGE, words + " one", "en", "s", 1, *far), (None, "some words without an id here", "en", "s", 1, *none),
            (LARGE - 1, words.upper() + " two three four five six", "en", "s", 1, *far),
            (3, "les chats sont dans la maison avec les autres chats", "fr", "s", 1, *far)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(((r.doc_id) for r in df.select("doc_id").collect()), key=repr)


def test_ids_beside_null(spark, docs):
    want = sorted([LARGE, None, LARGE - 1, 3], key=repr)
    items = spark.createDataFrame([(LARGE, "cat sat on the mat and looked at all the")], "item_id bigint, text string")
    found = decontaminate.search_documents(docs, items)
    assert ids(found) == want
    assert {r.doc_id: r["items"] for r in found.collect()}[LARGE] == [str(LARGE)]
    assert ids(language_id.predict_languages(docs)) == want
    assert ids(sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))) == want
    joined = jaccard_join.join_documents(docs)
    assert ids(joined) == want and {r.doc_id: r.component_id for r in joined.collect()}[LARGE] == LARGE


def test_stages_carry_columns_as_they_are(spark, docs):
    sf = "/root/testdata/sf0.001"
    before = {r.doc_id: r for r in docs.collect()}
    rows = docs
    for name, stage in P.STAGES[:-1]:
        rows = write_through(stage(spark, rows, sf))
        assert rows.schema.simpleString() == docs.schema.simpleString(), name
        for r in rows.collect():
            same = {k: v for k, v in r.asDict().items() if k not in ("text", "n_chars")}
            assert same == {k: before[r.doc_id][k] for k in same}, name
    assert rows.count() >= 2
