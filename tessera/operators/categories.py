"""Categorical features: position-tagged values, a (position, value)
dictionary with dense indexes, and encoding against it.

The dictionary is a DataFrame, never a driver map: it is numbered with
:func:`tessera.plans.dense_index` and joined to the values.  The values side
may hold one value for a large share of rows (a gender, a country); the
dictionary side has one row per key, so that is a skew-join split, and AQE
turns the join into a broadcast only when runtime statistics show the
dictionary is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.indexing import dense_index


def position_values(df: DataFrame, key: str, features: Column | list[str], keep: list[str] | None = None) -> DataFrame:
    """``key, keep..., pos, value`` — one row per feature, position 0-based."""
    arr = features if isinstance(features, Column) else F.array(*[F.col(c).cast("string") for c in features])
    return df.select(key, *(keep or []), F.posexplode(arr).alias("pos", "value"))


def category_index(pv: DataFrame) -> DataFrame:
    """``pos, value, ix``: distinct (pos, value) pairs numbered 0..n-1 in
    (pos, value) order."""
    keys = pv.select("pos", "value").distinct()
    return dense_index(keys, ["pos", "value"], "ix")


def category_codes(pv: DataFrame, dictionary: DataFrame, unseen: float = 0.0) -> DataFrame:
    """``pv`` plus ``code`` = the dictionary index as a double; unseen → ``unseen``.  A NULL value is a
    category like any other."""
    d = dictionary.select(F.col("pos").alias("_pos"), F.col("value").alias("_value"),
                          F.col("ix").cast("double").alias("_ix"))
    same = (F.col("pos") == F.col("_pos")) & F.col("value").eqNullSafe(F.col("_value"))
    return (pv.join(d, same, "left")
            .withColumn("code", F.coalesce(F.col("_ix"), F.lit(unseen))).drop("_pos", "_value", "_ix"))


def category_encode(pv: DataFrame, dictionary: DataFrame, key: str, keep: list[str] | None = None,
                    unseen: float = 0.0) -> DataFrame:
    """``key, keep..., features array<double>`` in position order.

    ``key`` must identify one record (as a row id does): the re-grouping by
    key then collects exactly one code per feature position, a group bounded
    by the number of features."""
    codes = category_codes(pv, dictionary, unseen)
    return (codes.groupBy(key, *(keep or []))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("_pc"))
            .select(key, *(keep or []), F.transform("_pc", lambda s: s["code"]).alias("features")))


def feature_slots(dictionary: DataFrame, num_features: int) -> DataFrame:
    """``pos, value, slot, unseen``: the one-hot slots of a dictionary of :func:`category_index`.

    Each position has a dense block of slots, its values in order and then one slot of its own for values that the
    dictionary does not hold (that row has ``unseen`` set).  The blocks follow each other, so a slot is the dictionary
    index and one more for each earlier position."""
    spark = dictionary.sparkSession
    known = dictionary.select("pos", "value", (F.col("ix") + F.col("pos")).alias("slot"), F.lit(False).alias("unseen"))
    positions = spark.range(num_features).select(F.col("id").cast("int").alias("pos"))
    sizes = dictionary.groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
    # one row a feature
    up_to = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = positions.join(sizes, "pos", "left").withColumn("_end", F.sum(F.coalesce("n", F.lit(0))).over(up_to))
    rest = ends.select("pos", F.lit(None).cast("string").alias("value"), (F.col("_end") + F.col("pos")).alias("slot"),
                       F.lit(True).alias("unseen"))
    return known.unionByName(rest)


def slot_rows(pv: DataFrame, slots: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """``key, keep..., slots array<bigint>``: the set slot of each feature in position order, for rows of
    :func:`position_values`.  The array is as long as there are features; no vector of all slots is made."""
    known = slots.where("NOT unseen").select(F.col("pos").alias("_pos"), F.col("value").alias("_value"),
                                             F.col("slot").alias("_slot"))
    rest = slots.where("unseen").select(F.col("pos").alias("_at"), F.col("slot").alias("_unseen"))
    same = (F.col("pos") == F.col("_pos")) & F.col("value").eqNullSafe(F.col("_value"))
    # the slots for unseen values are one row a feature
    found = pv.join(known, same, "left").join(F.broadcast(rest), F.col("pos") == F.col("_at"))
    return (found.groupBy(key, *(keep or []))
            .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("_slot", "_unseen").alias("slot")))).alias("_ps"))
            .select(key, *(keep or []), F.transform("_ps", lambda p: p["slot"]).alias("slots")))


def one_hot(encoded: DataFrame, num_features: int, features: str = "features", vector: str = "vector") -> DataFrame:
    """``encoded`` plus a sparse vector with one set slot per feature, the form a linear trainer such as
    ``pyspark.ml.classification.LinearSVC`` takes (another optimiser than the index form's sub-gradient
    descent).  Each feature has a block of slots as wide as its largest code plus one."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    codes = [f"_code{j}" for j in range(num_features)]
    slots = [f"_slots{j}" for j in range(num_features)]
    wide = encoded.select("*", *[F.get(features, j).alias(c) for j, c in enumerate(codes)])
    wide = OneHotEncoder(inputCols=codes, outputCols=slots, dropLast=False).fit(wide).transform(wide)
    return VectorAssembler(inputCols=slots, outputCol=vector).transform(wide).drop(*codes, *slots)


def set_slots(vector: str) -> Column:
    """The positions of a vector's non-zero slots, as text."""
    from pyspark.ml.functions import vector_to_array

    places = F.transform(vector_to_array(vector), lambda x, i: F.when(x != 0, i))
    return F.array_join(F.array_compact(places), ",")
