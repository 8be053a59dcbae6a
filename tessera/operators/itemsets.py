"""Frequent itemsets over baskets (parallel FP-growth from ``pyspark.ml``).

The miner reads its transactions several times (a count, the item counts,
the tree building), and its result is lazy; so the transactions are
written once to the shared folder (not a cache: a lost executor then costs a
re-read, not a re-computation of the upstream joins).  The result, which is
small, is written too, and the transactions are deleted then.

The miner counts items in one distributed pass (only items above the support
reach the driver: at most ``avg basket size / min_support`` of them), then
grows conditional FP-trees per item group on ``num_partitions`` tasks.  No
candidate pairs are ever materialised.  ``min_support`` is required: a low
value makes the output itself explode.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.checkpoint import release, write_through


def frequent_itemsets(baskets: DataFrame, items_col: str, min_support: float,
                      num_partitions: int | None = None) -> DataFrame:
    """``items array<string>`` (sorted) and ``freq``; support is counted over
    all non-NULL baskets, empty ones included."""
    tx = baskets.select(F.array_distinct(F.col(items_col)).alias("items")).where(F.col("items").isNotNull())
    tx = write_through(tx, "baskets")
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(tx)
    found = write_through(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq")), "itemsets")
    release(tx)
    return found


def baskets_of(df: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """Distinct items per basket; rows without a basket or an item are dropped.
    ``collect_set`` merges map-side and is bounded by the distinct items of one basket."""
    return (df.where(F.col(item_col).isNotNull() & F.col(basket_col).isNotNull())
            .groupBy(basket_col).agg(F.collect_set(F.col(item_col)).alias("items")))
