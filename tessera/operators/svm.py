"""Linear SVM by full-batch sub-gradient descent, one aggregate per step.

Same update rule as the classic RDD ``SVMWithSGD.train(data, iterations)``
defaults: step 1.0, L2 regularisation 0.01, whole batch, no intercept,
convergence tolerance 0.001.  Each iteration is one distributed aggregate
over the (persisted) training vectors with the current weights as literals —
only ``d + 1`` numbers come back to the driver.  For wide one-hot vectors use
``pyspark.ml.classification.LinearSVC`` instead (different optimiser).
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(features: Column | str, weights: list[float]) -> Column:
    """``x . w`` as plain arithmetic, summed left to right from 0.0 (stays in
    generated code; no lambda over the array)."""
    x = F.col(features) if isinstance(features, str) else features
    acc = F.lit(0.0)
    for j, w in enumerate(weights):
        acc = acc + F.get(x, j) * F.lit(float(w))
    return acc


def svm_sgd(train: DataFrame, features: str = "features", label: str = "label", num_features: int | None = None,
            iterations: int = 10, step: float = 1.0, reg: float = 0.01, tol: float = 0.001,
            compress: bool = True) -> list[float]:
    """Weights of a linear SVM (labels 0/1).

    ``compress``: first group identical (label, vector) rows with their count
    (one shuffle, merged map-side), so each iteration scans the distinct
    combinations, weighted by count, instead of every row.  Index-coded
    categorical features repeat heavily, so this is usually far smaller; the
    sums are the same (up to floating-point rounding)."""
    data = train.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"))
    if compress:
        data = data.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("w"))
    else:
        data = data.withColumn("w", F.lit(1.0))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        d = num_features if num_features is not None else data.select(F.max(F.size("x"))).first()[0] or 0
        w = [0.0] * d
        prev = None
        for i in range(1, iterations + 1):
            s = F.lit(2.0) * F.col("y") - F.lit(1.0)
            active = F.lit(1.0) > s * dot("x", w)
            aggs = [F.sum(F.when(active, -s * F.get(F.col("x"), j) * F.col("w")).otherwise(F.lit(0.0))).alias(f"g{j}")
                    for j in range(d)]
            row = data.agg(F.sum("w").alias("n"), *aggs).first()
            n = row["n"]
            if not n:
                break
            st = step / math.sqrt(i)
            w = [w[j] * (1.0 - st * reg) - st * (row[f"g{j}"] or 0.0) / n for j in range(d)]
            if prev is not None:
                diff = math.sqrt(sum((a - b) ** 2 for a, b in zip(prev, w)))
                if diff < tol * max(math.sqrt(sum(a * a for a in w)), 1.0):
                    break
            prev = w
        return w
    finally:
        data.unpersist()


def weights_frame(spark, weights: list[float]) -> DataFrame:
    """The model as a DataFrame ``j, weight``."""
    return spark.createDataFrame([(j, float(v)) for j, v in enumerate(weights)], "j int, weight double")


def svm_scores(df: DataFrame, weights: list[float], features: str = "features") -> DataFrame:
    """``df`` plus the raw margin ``score`` (threshold cleared)."""
    return df.withColumn("score", dot(features, weights))


def svm_error_rate(scored: DataFrame, label: str = "label", threshold: float = 0.0) -> DataFrame:
    """One row ``n, error_rate``: share of rows where ``score > threshold``
    disagrees with the 0/1 label, in one pass."""
    wrong = ((F.col("score") > F.lit(threshold)).cast("double") != F.col(label).cast("double")).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(wrong).alias("error_rate"))
