"""Session construction for tests, benchmarks and command-line use.

Library functions never create a session; they take the caller's DataFrames.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Session settings the jobs are tuned for.  AQE re-plans joins and coalesces
# shuffle partitions at run time from real statistics; skew-join splitting is
# what keeps a hot key (one trail, one word, one category) off a single task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
