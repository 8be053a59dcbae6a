"""A Bloom filter as a small table: keys are looked up before a join moves their rows.

The filter is an aggregate of the keys, one row for each of at most ``BLOCKS``
words of 64 bits, so its broadcast has a fixed size bound whatever the number of
keys.  More keys than it can hold make it let more rows pass, never fewer.  The
join that follows is exact; the filter only spares it rows without a partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 16
_SEED = "bloom"
_PROBES = 4


def _block(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BLOCKS)).cast("int")


def _bits(hashed: Column) -> Column:
    """A word with the key's bits set: six bits of the hash for each probe."""
    word = F.lit(0).cast("bigint")
    for i in range(_PROBES):
        place = F.shiftrightunsigned(hashed, 20 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return word


def bloom_table(keys: DataFrame, column: str) -> DataFrame:
    """``_block, _word``: the filter of the keys' values (map-side combined, at most ``BLOCKS`` rows)."""
    hashed = F.xxhash64(column, F.lit(_SEED))
    return (keys.select(_block(hashed).alias("_block"), _bits(hashed).alias("_bits"))
            .groupBy("_block").agg(F.bit_or("_bits").alias("_word")))


def marked_by(rows: DataFrame, table: DataFrame, column: str, mark: str) -> DataFrame:
    """``rows`` and whether each key may be among the filter's; its type must be that of the filter's keys."""
    tried = rows.withColumn("_probe", F.xxhash64(column, F.lit(_SEED)))
    joined = tried.join(F.broadcast(table), _block(F.col("_probe")) == F.col("_block"), "left")
    bits = _bits(F.col("_probe"))
    known = F.coalesce(F.col("_word").bitwiseAND(bits) == bits, F.lit(False))
    return joined.withColumn(mark, known).drop("_probe", "_block", "_word")


def may_be_in(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """The rows whose key may be among the filter's."""
    return marked_by(rows, table, column, "_maybe").where("_maybe").drop("_maybe")
