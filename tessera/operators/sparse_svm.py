"""The linear SVM of :mod:`tessera.operators.svm` over wide one-hot rows.

A row is the short list of its set slots; no vector and no weight is ever
written into a plan or sent through the driver.  The weights are a table
``slot, weight``, joined to the rows by slot; a slot that no row with a
gradient has touched has weight 0 and no row.  One iteration is

1. the entries (row, slot) joined with the weights: the weights have one row a
   slot, so AQE broadcasts them while they are small, and splits a slot that a
   third of all rows hold by its measured size otherwise;
2. the margin of each row, a sum over its entries (as many as there are features);
3. the gradient by slot, merged map-side, and the new weights, written.

Rows with the same label and slots are one row with a count.  The update rule
and its defaults are those of the dense trainer: step 1.0 / sqrt(iteration),
L2 regularisation 0.01, whole batch, no intercept, tolerance 0.001.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.checkpoint import release, write_through


def _weight() -> Column:
    return F.coalesce("weight", F.lit(0.0))


def train(rows: DataFrame, slots: str = "slots", label: str = "label", iterations: int = 10, step: float = 1.0,
          reg: float = 0.01, tol: float = 0.001) -> DataFrame:
    """``slot, weight`` from rows with an array of distinct set slots and a 0/1 label."""
    spark = rows.sparkSession
    counted = (rows.select(F.col(slots).alias("x"), F.col(label).cast("double").alias("y"))
               .groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("c")))
    counted = write_through(counted.withColumn("row", F.monotonically_increasing_id()), "rows")
    n = counted.agg(F.sum("c")).first()[0]
    weights = spark.createDataFrame([], "slot bigint, weight double")
    if not n:
        return weights
    sign = F.lit(2.0) * F.col("y") - F.lit(1.0)
    entries = write_through(counted.select("row", "c", sign.alias("s"), F.explode("x").alias("slot")),
                            "entries")
    release(counted)
    first = True
    for i in range(1, iterations + 1):
        margin = F.sum(_weight()).over(Window.partitionBy("row"))
        # before the first step all margins are 0
        active = entries if first else entries.join(weights, "slot", "left").withColumn("_m", margin).where(
            F.lit(1.0) > F.col("s") * F.col("_m"))
        gradient = active.groupBy("slot").agg(F.sum(-F.col("s") * F.col("c")).alias("g"))
        st = step / math.sqrt(i)
        new = _weight() * F.lit(1.0 - st * reg) - F.lit(st) * F.coalesce("g", F.lit(0.0)) / F.lit(n)
        stepped = write_through(weights.join(gradient, "slot", "full").select(
            "slot", _weight().alias("old"), new.alias("weight")), "weights")
        moved, size = stepped.agg(F.sum(F.pow(F.col("weight") - F.col("old"), 2)), F.sum(F.pow("weight", 2))).first()
        if not first:
            release(old)
        old, weights = stepped, stepped.select("slot", "weight")
        if not first and math.sqrt(moved or 0.0) < tol * max(math.sqrt(size or 0.0), 1.0):
            break
        first = False
    release(entries)
    return weights


def scores(rows: DataFrame, weights: DataFrame, key: str, keep: list[str] | None = None,
           slots: str = "slots") -> DataFrame:
    """``key, keep..., score``: the raw margin of each row; ``key`` identifies a row.  A row without slots scores 0."""
    names = [key, *(keep or [])]
    entries = rows.select(*names, F.explode_outer(slots).alias("slot"))
    return (entries.join(weights, "slot", "left").groupBy(*names).agg(F.sum(_weight()).alias("score")))
