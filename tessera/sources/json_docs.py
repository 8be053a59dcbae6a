"""JSON held in a string column: known-schema parsing, schema inference that
stays a DataFrame job, and map-to-JSON rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, NullType, StringType, StructField,
                               StructType, VariantType)


def parse_json_column(df: DataFrame, column: str, schema: str, alias: str = "doc") -> DataFrame:
    """Add ``alias`` = ``from_json(column, schema)``; malformed text gives NULL."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def _file_type(kind: DataType) -> DataType:
    """The type as the JSON file reader infers it: fractions as double, and text where there is no
    value or values of several shapes."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _file_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_file_type(kind.elementType))
    if isinstance(kind, DecimalType):
        return DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def infer_json_schema(df: DataFrame, column: str) -> StructType:
    """Infer the type of the JSON objects in ``column``; other values and broken texts count for nothing.

    One distributed aggregate (``schema_of_variant_agg``, merged map-side);
    only the resulting type text reaches the driver.
    """
    value = F.try_parse_json(F.col(column))
    objects = F.when(F.startswith(F.schema_of_variant(value), F.lit("OBJECT<")), value)
    row = df.select(F.schema_of_variant_agg(objects).alias("s")).first()
    if row is None or row.s is None or not row.s.startswith("OBJECT<"):
        return StructType()
    # an object type starts the text or follows a name's colon or an array's bracket, never a name
    ddl = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", row.s)
    return _file_type(DataType.fromDDL(ddl))


def read_json_column(df: DataFrame, column: str, keep: list[str] | None = None,
                     schema: str | StructType | None = None) -> DataFrame:
    """Flatten the JSON objects of ``column`` into typed top-level columns."""
    kind = schema if schema is not None else infer_json_schema(df, column)
    if isinstance(kind, StructType) and not kind.fields:
        return df.select(*(keep or []))
    parsed = F.from_json(F.col(column), kind).alias("_doc")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_doc.*")


def required_json_fields(df: DataFrame, column: str, fields: list[str], keep: list[str] | None = None,
                         type_: str = "string") -> DataFrame:
    """``keep..., fields...`` read from the JSON object in ``column``; a row is
    dropped when the text is NULL or not JSON, or when any field is missing
    or JSON null.  One parse per row: a generator reads all fields at once."""
    rows = df.select(*(keep or []), F.json_tuple(F.col(column), *fields).alias(*fields))
    for f in fields:
        rows = rows.where(F.col(f).isNotNull())
    return rows if type_ == "string" else rows.select(*(keep or []), *[F.col(f).try_cast(type_).alias(f) for f in fields])


def map_to_json(map_col: Column | str) -> Column:
    return F.to_json(F.col(map_col) if isinstance(map_col, str) else map_col)
