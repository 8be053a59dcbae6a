"""Membership by distinct keys and a Bloom filter, one-hot slots, the sparse SVM trainer, the tokenizer rule."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera import jobs
from tessera.functions.text import whitespace_tokens
from tessera.operators import categories, keywords, relational, sparse_svm, svm, trails
from tessera.plans.bloom import BLOCKS, bloom_table, may_be_in
from testdata_dirs import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bloom", [None, True])
def test_semi_and_anti_with_a_hot_member(spark, bloom):
    df = spark.createDataFrame([(i, i % 50 if i % 7 else None) for i in range(2000)], "id int, k int")
    # one key is nearly all of the member side, and one member is NULL
    members = spark.range(30_000).select(F.when(F.col("id") < 29_990, 3).otherwise(F.col("id") - 29_980).cast("long").alias("m"))
    members = members.unionByName(spark.createDataFrame([(None,)], "m long"))
    inside = {3, *range(10, 20)}
    rows = [(r.id, r.k) for r in df.collect()]
    semi = relational.semi_members(df, "k", members, "m", bloom=bloom)
    anti = relational.anti_members(df, "k", members, "m", bloom=bloom)
    assert semi.columns == anti.columns == ["id", "k"]
    assert sorted(r.id for r in semi.collect()) == [i for i, k in rows if k in inside]
    assert sorted(r.id for r in anti.collect()) == [i for i, k in rows if k not in inside]


def test_member_side_is_distinct_before_the_join(spark):
    members = spark.range(40_000).select(F.when(F.col("id") < 39_000, 1).otherwise(F.col("id")).alias("m"))
    keys = relational._member_keys(members, "m")
    assert keys.count() == 1001 and keys.where("_mkey = 1").count() == 1
    assert "HashAggregate(keys=[_mkey" in _plan(relational.distinct_keys(members, "m", "_mkey"))


def test_bloom_lets_every_member_pass_and_few_others(spark):
    keys = spark.range(20_000).select((F.col("id") * 3).alias("m"))
    table = bloom_table(keys, "m")
    assert table.count() <= BLOCKS
    rows = spark.range(60_000).select("id", F.lit(1).alias("m"))
    passed = {r.id for r in may_be_in(rows, table, "id").collect()}
    assert passed >= set(range(0, 60_000, 3)) and len(passed) < 21_000
    assert may_be_in(rows, bloom_table(keys.limit(0), "m"), "id").count() == 0


def test_slots_are_dense_with_one_for_unseen(spark):
    rows = [(1, "a", "x", "u"), (2, "b", None, "v"), (3, "a", "x", "v"), (4, "c", "y", "w")]
    df = spark.createDataFrame(rows, "k int, f0 string, f1 string, f2 string")
    pv = categories.position_values(df, "k", ["f0", "f1", "f2"])
    slots = categories.feature_slots(categories.category_index(pv.where("k < 4")), 3)
    got = sorted((r.slot, r.pos, r.value, r.unseen) for r in slots.collect())
    assert got == [(0, 0, "a", False), (1, 0, "b", False), (2, 0, None, True), (3, 1, None, False), (4, 1, "x", False),
                   (5, 1, None, True), (6, 2, "u", False), (7, 2, "v", False), (8, 2, None, True)]
    coded = {r.k: r.slots for r in categories.slot_rows(pv, slots, "k").collect()}
    assert coded == {1: [0, 4, 6], 2: [1, 3, 7], 3: [0, 4, 7], 4: [2, 5, 8]}
    # a position without a training value has the slot for unseen ones only
    bare = categories.feature_slots(categories.category_index(pv.where("k < 4 AND pos != 1")), 3)
    assert sorted(r.slot for r in bare.collect()) == list(range(7)) and bare.where("pos = 1").first().unseen


def test_sparse_trainer_equals_the_dense_one(spark):
    rnd = random.Random(9)
    rows = [(i, float(rnd.random() < 0.4), [rnd.randrange(4), 4 + rnd.randrange(6), 10 + min(rnd.randrange(40), 25)])
            for i in range(500)]
    df = spark.createDataFrame(rows, "k int, label double, slots array<bigint>")
    width = 36
    dense = df.select("label", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.array_contains(
        "slots", j.cast("bigint")).cast("double")).alias("features"))
    want = svm.svm_sgd(dense, num_features=width, iterations=12)
    weights = sparse_svm.train(df, iterations=12)
    got = {r.slot: r.weight for r in weights.collect()}
    assert all(math.isclose(got.get(j, 0.0), want[j], rel_tol=1e-9, abs_tol=1e-12) for j in range(width))
    scores = {r.k: r.score for r in sparse_svm.scores(df, weights, "k").collect()}
    assert all(math.isclose(scores[k], sum(want[j] for j in x), rel_tol=1e-9, abs_tol=1e-12) for k, _, x in rows)


def test_sparse_trainer_stops_like_the_dense_one(spark):
    df = spark.createDataFrame([(1.0, [0, 1]), (0.0, [2, 3])] * 20, "label double, slots array<bigint>")
    dense = df.select("label", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.array_contains(
        "slots", j.cast("bigint")).cast("double")).alias("features"))
    want = svm.svm_sgd(dense, num_features=4, iterations=200, tol=0.05)
    got = {r.slot: r.weight for r in sparse_svm.train(df, iterations=200, tol=0.05).collect()}
    assert all(math.isclose(got[j], want[j], rel_tol=1e-9) for j in range(4))


def test_sparse_trainer_without_rows(spark):
    empty = spark.createDataFrame([], "k int, label double, slots array<bigint>")
    weights = sparse_svm.train(empty)
    assert weights.count() == 0 and sparse_svm.scores(empty, weights, "k").count() == 0


def test_wide_queries_make_no_dense_vector(spark):
    slots, rows, weights = jobs._wide_model(spark, SF_SMALL)
    assert rows.where("size(slots) != 3").count() == 0
    assert slots.where("unseen").count() == 3 and slots.count() == slots.agg(F.max("slot")).first()[0] + 1
    assert weights.count() <= slots.count()


@pytest.mark.parametrize("query", [jobs.q_idf, jobs.q_tfidf, jobs.q_doc_keyword, jobs.q_tfidf_hashed])
def test_text_is_read_once(spark, query):
    from tools.plan_summary import final_lines

    df = query(spark, SF_SMALL)
    df.collect()
    lines = final_lines(_plan(df))
    assert sum("FileScan parquet" in ln for ln in lines) == 1
    assert not any("SortAggregate" in ln for ln in lines)


def test_words_are_counted_before_they_move(spark):
    docs = spark.createDataFrame([(1, "bb aa bb cc bb"), (2, "aa"), (3, "x"), (None, "aa aa"), (2, "aa dd")], "id long, t string")
    prep = keywords.prepare_documents(docs, "id", "t")
    got = sorted(((r.doc, r.word, r.n) for r in keywords.term_rows(prep).collect()), key=repr)
    assert got == sorted([(1, "", 0), (1, "aa", 1), (1, "bb", 3), (1, "cc", 1), (2, "", 0), (2, "aa", 1), (None, "", 0),
                          (None, "aa", 2), (2, "", 0), (2, "aa", 1), (2, "dd", 1)], key=repr)
    # documents with one id are one document; one without an id counts for nothing
    idf = {r.word: (r.df, r.idf) for r in keywords.inverse_document_frequency(keywords.term_rows(prep)).collect()}
    assert {w: d for w, (d, _) in idf.items()} == {"aa": 2, "bb": 1, "cc": 1, "dd": 1}
    assert math.isclose(idf["bb"][1], math.log(3 / 2)) and idf["aa"][1] == 0.0
    scores = {(r.doc, r.word): (r.tf, r.tfidf) for r in keywords.tfidf(keywords.term_rows(prep)).collect()}
    assert scores[(2, "aa")][0] == 2 and math.isclose(scores[(1, "bb")][1], 3 * math.log(3 / 2))


def test_whitespace_tokens_are_those_of_the_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer

    texts = ["", " ", "  ", "A b", " lead", "trail  ", "two  blanks", "tab\there\nnew\r\nline\x0bv\x0cf ", "É ü x", "\n\n", "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    ml = {r.i: r.words for r in Tokenizer(inputCol="text", outputCol="words").transform(df).collect()}
    assert {r.i: r.w for r in df.select("i", whitespace_tokens("text").alias("w")).collect()} == ml


def test_both_ways_of_dedup_from_one_parse(spark):
    js = jobs._json_trails(spark, SF_SMALL)
    both = trails.path_to_target_json(js, "feet", keep=["event_id"], dedup=("exact", "substring"))
    plan = _plan(jobs.q_path_to_target_json(spark, SF_SMALL)).lower().replace("parsejson", "parse_json")
    assert plan.count("parse_json") == 1 and plan.count("filescan") == 1
    for way in ("exact", "substring"):
        one = trails.path_to_target_json(js, "feet", keep=["event_id"], dedup=way)
        assert one.columns == ["event_id", "path"]
        assert sorted(one.collect()) == sorted(both.where(F.col("dedup") == way).drop("dedup").collect())
