"""SVM against the classic RDD trainer, itemsets against brute force,
dense indexing against a global row number."""

import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import jobs
from tessera.operators import categories, itemsets, svm
from tessera.plans import dense_index
from testdata_dirs import SF_SMALL


def test_svm_matches_mllib(spark):
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    enc = jobs._encoded(spark, SF_SMALL).where(F.col("split") == "train")
    ours = svm.svm_sgd(enc, num_features=2, iterations=10)
    pts = enc.select("label", "features").rdd.map(lambda r: LabeledPoint(r.label, r.features)).cache()
    ref = SVMWithSGD.train(pts, iterations=10)
    assert ref.intercept == 0.0
    for a, b in zip(ours, ref.weights.toArray()):
        assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_svm_random_data_matches_mllib(spark):
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    rnd = random.Random(7)
    rows = [(float(rnd.random() < 0.4), [rnd.gauss(0, 1), rnd.gauss(1, 2), rnd.random()]) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    ours = svm.svm_sgd(df, iterations=25)
    ref = SVMWithSGD.train(spark.sparkContext.parallelize([LabeledPoint(y, x) for y, x in rows]), iterations=25)
    for a, b in zip(ours, ref.weights.toArray()):
        assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_error_rate_one_pass(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.2), (0.0, -1.0), (1.0, -0.1)], "label double, score double")
    r = svm.svm_error_rate(df).first()
    assert r.n == 4 and r.error_rate == 0.5


def test_dense_index_equals_row_number(spark):
    rnd = random.Random(3)
    keys = sorted({(rnd.randrange(5), f"v{rnd.randrange(1000)}") for _ in range(3000)})
    df = spark.createDataFrame(keys, "pos int, value string").repartition(13)
    got = dense_index(df, ["pos", "value"], "ix", num_partitions=7)
    expect = df.withColumn("ix", F.row_number().over(Window.orderBy("pos", "value")) - 1)
    assert sorted(got.collect()) == sorted(expect.select("pos", "value", F.col("ix").cast("long")).collect())
    assert got.count() == len(keys)


def test_category_encode_unseen_is_zero(spark):
    train = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k int, f0 string, f1 string")
    test = spark.createDataFrame([(3, "zz", "x")], "k int, f0 string, f1 string")
    d = categories.category_index(categories.position_values(train, "k", ["f0", "f1"]))
    assert sorted((r.pos, r.value, r.ix) for r in d.collect()) == [(0, "a", 0), (0, "b", 1), (1, "x", 2)]
    enc = categories.category_encode(categories.position_values(test, "k", ["f0", "f1"]), d, "k")
    assert enc.first().features == [0.0, 2.0]


def _brute(baskets, min_support):
    n = len(baskets)
    need = math.ceil(min_support * n)
    counts = {}
    for b in baskets:
        items = sorted(set(b))
        for k in range(1, len(items) + 1):
            for combo in itertools.combinations(items, k):
                counts[combo] = counts.get(combo, 0) + 1
    return {c: f for c, f in counts.items() if f >= need}


@pytest.mark.parametrize("support", [0.2, 0.35])
def test_itemsets_match_brute_force(spark, support):
    rnd = random.Random(11)
    baskets = [[rnd.choice("abcdef") for _ in range(rnd.randint(1, 5))] for _ in range(300)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    got = {tuple(r.items): r.freq for r in itemsets.frequent_itemsets(df, "items", support, 4).collect()}
    assert got == _brute(baskets, support)


def test_itemset_support_antimonotone(spark):
    df = jobs.q_frequent_itemsets(spark, SF_SMALL)
    freq = {r.items: r.freq for r in df.collect()}
    for items, f in freq.items():
        parts = items.split(",")
        for sub in itertools.combinations(parts, len(parts) - 1):
            if sub:
                assert freq[",".join(sub)] >= f
