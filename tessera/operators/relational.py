"""Filters, projections, membership lookups, distinct, union, split.

All are declarative so Catalyst pushes predicates and column pruning into the
scan.  Membership is a plain join with the distinct member keys, never a
driver-side loop: AQE splits a hot key of the labelled side by its measured
size, and a hot key of the member side is one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import hash_bucket, year_range
from ..plans.bloom import bloom_table, marked_by, may_be_in
from ..plans.checkpoint import write_through

# Member keys for which a Bloom filter is built: fewer are broadcast whole, more fill it.
BLOOM_FROM, BLOOM_TO = 10_000, 1_000_000


def range_filter(df: DataFrame, column: str, low, high, select: list[str] | None = None) -> DataFrame:
    """Rows with ``low <= column <= high`` (NULL never qualifies)."""
    out = df.where((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
    return out.select(*select) if select else out


def contains_filter(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit(needle)))


def year_filter(df: DataFrame, ts_column: str, year: int, mode: str = "range") -> DataFrame:
    """Rows of one calendar year.

    ``mode="range"`` is a half-open timestamp range that reaches the Parquet
    scan; ``mode="text"`` is the position-of-substring form
    ``locate('YYYY', cast(ts as string)) > 0`` kept for compatibility (it
    matches the digits anywhere in the rendered value and cannot be pushed).
    """
    if mode == "range":
        return df.where(year_range(ts_column, year))
    if mode == "text":
        return df.where(F.locate(f"{year:04d}", F.col(ts_column).cast("string")) > 0)
    raise ValueError(f"unknown mode {mode!r}")


def distinct_keys(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    return df.select(F.col(key).alias(alias or key)).where(F.col(alias or key).isNotNull()).distinct()


def membership_label(df: DataFrame, key: str, members: DataFrame, member_key: str,
                     label: str = "label") -> DataFrame:
    """Every row of ``df`` plus ``label`` = 1.0 when its key occurs in
    ``members`` else 0.0.

    The distinct member keys are written first: the left join then has a plain
    table on both sides, and AQE splits a key that holds many rows of ``df`` by
    its measured size."""
    keys = write_through(distinct_keys(members, member_key, "_mkey"), "members")
    joined = df.join(keys, df[key] == keys["_mkey"], "left")
    return joined.select(*[df[c] for c in df.columns],
                         F.when(F.col("_mkey").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)).alias(label))


def _member_keys(members: DataFrame, member_key: str) -> DataFrame:
    """The distinct keys, as a written table: a key that fills the member side is one row of each task before it
    moves, and the join that follows has a plain table on both sides."""
    return write_through(distinct_keys(members, member_key, "_mkey"), "members")


def _worth_a_filter(keys: DataFrame) -> bool:
    """More keys than a broadcast join takes at once, but not so many that the filter lets all rows pass."""
    return BLOOM_FROM < keys.count() <= BLOOM_TO


def semi_members(df: DataFrame, key: str, members: DataFrame, member_key: str, bloom: bool | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``members`` (each row once).

    ``bloom``: look the keys up in a Bloom filter before the join, so that rows without a member are not moved;
    decided by the number of distinct member keys when not given."""
    keys = _member_keys(members, member_key)
    bloom = _worth_a_filter(keys) if bloom is None else bloom
    kind = df.schema[key].dataType
    probed = may_be_in(df, bloom_table(keys.select(F.col("_mkey").cast(kind)), "_mkey"), key) if bloom else df
    return probed.join(keys, probed[key] == keys["_mkey"], "left_semi")


def anti_members(df: DataFrame, key: str, members: DataFrame, member_key: str, bloom: bool | None = None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``members`` (a NULL key does not).

    With ``bloom`` (see :func:`semi_members`) the rows that the filter does not know are kept as they are scanned, and
    only the others are moved to have their key compared."""
    keys = _member_keys(members, member_key)
    bloom = _worth_a_filter(keys) if bloom is None else bloom
    if not bloom:
        return df.join(keys, df[key] == keys["_mkey"], "left_anti")
    table = bloom_table(keys.select(F.col("_mkey").cast(df.schema[key].dataType)), "_mkey")
    marked = marked_by(df, table, key, "_maybe")
    sure = marked.where(~F.col("_maybe")).drop("_maybe")
    unsure = marked.where("_maybe").drop("_maybe")
    return sure.unionByName(unsure.join(keys, unsure[key] == keys["_mkey"], "left_anti"))


def union_labeled(positives: DataFrame, negatives: DataFrame, label: str = "label") -> DataFrame:
    """Positives with label 1.0, then negatives with 0.0; duplicates kept."""
    return (positives.withColumn(label, F.lit(1.0))
            .unionByName(negatives.withColumn(label, F.lit(0.0))))


def split_column(key: Column | str, train_buckets: int = 8, buckets: int = 10) -> Column:
    """``'train'`` / ``'test'`` from a stable hash of the key (80/20 by default)."""
    return F.when(hash_bucket(key, buckets) < train_buckets, F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, key: str, train_buckets: int = 8, buckets: int = 10):
    """(train, test) halves, disjoint and complete, independent of partitioning."""
    s = split_column(key, train_buckets, buckets)
    return df.where(s == "train"), df.where(s == "test")
