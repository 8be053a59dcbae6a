"""Parquet, JSON-lines and plain text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*(path if isinstance(path, list) else [path]))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """Write keeping the schema.  The default mode refuses an existing target."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON lines from a file or directory.  Without ``schema`` Spark infers it
    in an extra pass over the input; pass one whenever it is known."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_text_lines(df: DataFrame, path: str, column: str | None = None, mode: str = "errorifexists") -> None:
    """One string per row.  Without ``column`` each row is written as JSON."""
    col = F.col(column) if column else F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    df.select(col.alias("value")).write.mode(mode).text(path)
