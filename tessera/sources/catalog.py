"""Catalog tables: create if absent, bulk-load a delimited file, read back; and
bucketed tables, which are joined and grouped by their key without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table(spark: SparkSession, name: str, columns_ddl: str = "key INT, value STRING",
                 fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {fmt}")


def load_delimited_into_table(spark: SparkSession, path: str, table: str, sep: str = "\x01") -> None:
    """Append a delimited text file to ``table`` by position, by the rules of such files: no quoting and
    no escapes, ``\\N`` is NULL, an empty value stays empty, missing fields and values that do not
    convert are NULL, further fields are ignored.  The source file is left in place."""
    parts = F.split("value", "\\Q" + sep + "\\E", -1)
    columns = []
    for i, field in enumerate(spark.table(table).schema.fields):
        text = F.get(parts, i)
        text = F.when(text != "\\N", text)
        columns.append(text.try_cast(field.dataType).alias(field.name))
    spark.read.text(path).select(*columns).write.insertInto(table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """A table in ``buckets`` files by the hash of ``key``, each sorted by it.

    For a dictionary or a member table that is joined again and again: two tables with the same number of buckets are
    joined on the key as they lie.  Rows are dealt to the buckets first, so there is one file a bucket."""
    df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
