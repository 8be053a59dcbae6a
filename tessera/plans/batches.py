"""Size of the Arrow batches that carry texts to the Python workers.

By rows alone, ten thousand by default, a batch of long texts takes tens of MB,
several times over: while it is written, on its way, and as strings.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20
_UNBOUNDED = (1 << 31) - 1
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound batches of this session by their bytes too; a bound that is lower, or set with a unit, stays."""
    now = spark.conf.get(_SETTING, str(_UNBOUNDED))
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(_SETTING, str(BATCH_BYTES))
