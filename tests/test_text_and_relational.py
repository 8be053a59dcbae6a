"""Tokenising, TF-IDF parity with pyspark.ml, splits and membership."""

import math

from pyspark.sql import functions as F

from tessera import jobs
from tessera.functions import composite_record, hash_bucket, parse_composite_record, word_tokens
from tessera.functions.text import has_word
from tessera.operators import categories, itemsets, keywords, relational
from testdata_dirs import SF_SMALL


def test_tokens_words_and_cjk_bigrams(spark):
    df = spark.createDataFrame([("Hello, WORLD a 12 中文字符 東京abc",)], "t string")
    plain, cjk = df.select(word_tokens("t"), word_tokens("t", True)).first()
    assert plain == ["hello", "world", "12", "中文字符", "東京abc"]
    assert cjk == ["hello", "world", "12", "中文", "文字", "字符", "東京", "abc"]


def test_has_word_guard_is_exact(spark):
    texts = ["", " ", "a b", "ab", "a中", "中文", "x y z 12", "é ü", "İx"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for cjk in (False, True):
        rows = df.select(has_word("t", cjk).alias("h"), F.size(word_tokens("t", cjk)).alias("n")).collect()
        assert all(r.h == (r.n > 0) for r in rows)


def test_idf_matches_pyspark_ml(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    dt = keywords.prepare_documents(docs, "doc_id", "text")
    m = keywords.document_count(dt)
    terms = keywords.term_rows(dt)
    idf = {r.word: r.idf for r in keywords.inverse_document_frequency(terms, m).where(F.col("word") == "the").collect()}
    from pyspark.ml.feature import IDF, HashingTF, Tokenizer
    words = Tokenizer(inputCol="text", outputCol="words").transform(keywords.joined_tokens(dt))
    raw = HashingTF(numFeatures=1 << 18, inputCol="words", outputCol="rawfeature").transform(words)
    hashed = IDF(inputCol="rawfeature", outputCol="feature").fit(raw).transform(raw)
    bucket = HashingTF(numFeatures=1 << 18).indexOf("the")
    ml_idf = hashed.select(F.col("feature")).first()  # any document carries the model's idf via the ratio
    row = hashed.where(F.array_contains("words", "the")).select("rawfeature", "feature").first()
    ratio = row.feature[bucket] / row.rawfeature[bucket]
    assert ml_idf is not None and math.isclose(idf["the"], ratio, rel_tol=1e-12)


def test_top_words_ties_by_word(spark):
    df = keywords.prepare_documents(spark.createDataFrame([(1, "bb aa cc aa bb")], "id int, t string"), "id", "t")
    got = [(r.word, r.n) for r in keywords.top_words(keywords.word_counts(df), 2).collect()]
    assert got == [("aa", 2), ("bb", 2)]


def test_split_disjoint_complete_and_stable(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    tr, te = relational.train_test_split(c, "c_custkey")
    a = {r.c_custkey for r in tr.select("c_custkey").collect()}
    b = {r.c_custkey for r in te.select("c_custkey").collect()}
    assert not (a & b) and len(a | b) == c.count()
    tr2, _ = relational.train_test_split(c.repartition(17), "c_custkey")
    assert {r.c_custkey for r in tr2.select("c_custkey").collect()} == a
    assert c.select(hash_bucket(F.lit(1))).first()[0] == 3301589560 % 10


def test_membership_forms_agree(spark):
    lab = {r.c_custkey: r.label for r in jobs.q_membership_label(spark, SF_SMALL).collect()}
    semi = {r.c_custkey for r in jobs.q_semi_members(spark, SF_SMALL).collect()}
    anti = {r.c_custkey for r in jobs.q_anti_members(spark, SF_SMALL).collect()}
    assert {k for k, v in lab.items() if v == 1.0} == semi
    assert {k for k, v in lab.items() if v == 0.0} == anti
    assert sorted(jobs.q_union_labeled(spark, SF_SMALL).collect()) == sorted(
        jobs.q_membership_label(spark, SF_SMALL).collect())


def test_year_filter_forms_agree(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = relational.year_filter(o, "o_orderdate", 1995, "range").select("o_orderkey")
    b = relational.year_filter(o, "o_orderdate", 1995, "text").select("o_orderkey")
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() > 0


def test_null_and_blank_texts_drop_out(spark):
    docs = spark.createDataFrame([(1, None), (2, "   "), (3, "a b"), (4, "hello hello world")], "id int, t string")
    prep = keywords.prepare_documents(docs, "id", "t")
    assert [r.doc for r in keywords.joined_tokens(prep).collect()] == [4]
    tc = {(r.doc, r.word): r.tf for r in keywords.term_counts(keywords.term_rows(prep)).collect()}
    assert tc == {(4, "hello"): 2, (4, "world"): 1}
    m = keywords.document_count(prep)
    assert keywords.inverse_document_frequency(keywords.term_rows(prep), m).where("word = 'world'").first().idf == 0.0


def test_exact_scores_choose_the_keyword(spark):
    near = spark.createDataFrame([(1, "aaa", 0.3000001), (1, "zzz", 0.3000004), (2, "bb", 0.5), (2, "aa", 0.5)],
                                 "doc int, word string, tfidf double")
    assert sorted(tuple(r) for r in keywords.doc_keyword(near).collect()) == [(1, "zzz", 0.3), (2, "aa", 0.5)]


def test_composite_record_keeps_places(spark):
    df = spark.createDataFrame([("1", ["a", None, "c"], 1.0), (None, ["a.b", "", "x|y"], None)],
                               "k string, f array<string>, y double")
    rec = df.select(composite_record("k", "f", "y", "|", "::").alias("r"))
    key, features, label = parse_composite_record("r", "|", "::")
    assert rec.where("r like '1|%'").select(key, features, label).first() == ("1", ["a", "null", "c"], "1.0")
    plain = df.select(composite_record("k", "f", "y").alias("r"))
    key, features, label = parse_composite_record("r")
    assert plain.where("r like 'null%'").select(key, features, label).first() == ("null", ["a.b", "", "x|y"], "null")


def test_null_category_has_a_code(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "k int, f string")
    pv = categories.position_values(df, "k", ["f"])
    d = categories.category_index(pv.where("k < 4"))
    codes = {r.k: r.features for r in categories.category_encode(pv, d, "k", unseen=-1.0).collect()}
    null = [r.ix for r in d.collect() if r.value is None]
    assert codes[1] == codes[3] == [float(null[0])] and codes[4] == [-1.0] and codes[2] != codes[1]


def test_one_hot_trains_a_linear_svc(spark):
    from pyspark.ml.classification import LinearSVC

    rows = [(i, float(i % 2), [float(i % 2), float(i % 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, label double, features array<double>")
    wide = categories.one_hot(df, 2)
    assert {(r.k, r.s) for r in wide.select("k", categories.set_slots("vector").alias("s")).collect()} == {
        (i, f"{i % 2},{2 + i % 3}") for i in range(60)}
    model = LinearSVC(featuresCol="vector", maxIter=10).fit(wide)
    assert model.transform(wide).where("prediction != label").count() == 0


def test_rows_without_a_basket_are_no_basket(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "a")], "o int, item string")
    assert sorted(r.o for r in itemsets.baskets_of(df, "o", "item").collect()) == [1, 2]
