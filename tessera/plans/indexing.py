"""Dense 0..n-1 numbering of distinct keys in key order, without a
single-task global window.

The keys are range-partitioned and sorted inside each partition; every row
then carries ``monotonically_increasing_id`` = (partition << 33) + position.
After a written cut freezes those ids, the per-partition row counts
(one row per partition, so a proven bound) give each partition its offset.
Only that tiny offsets table is windowed and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoint import cut_lineage

_LOW_BITS = (1 << 33) - 1


def dense_index(keys: DataFrame, order_cols: list[str], name: str = "ix",
                num_partitions: int | None = None) -> DataFrame:
    """Number the rows of ``keys`` 0..n-1 in ``order_cols`` order.

    ``keys`` must hold distinct values of ``order_cols`` (call ``distinct``
    first); ties would make the numbering order-dependent.
    """
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (keys.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    local = ranged.select("*", F.shiftright("_mid", 33).alias("_pid"),
                          F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_pos"))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # at most `n` rows: one per range partition
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(*[c for c in keys.columns], (F.col("_off") + F.col("_pos")).alias(name)))
