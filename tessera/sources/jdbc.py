"""JDBC reads of a table or a sub-query, range-partitioned on a column.

Bounds only set the stride of the partitions (they filter nothing), so fixed
bounds that do not match the data put almost every row into one partition.
When the caller gives no bounds they are read from the database as
``min``/``max`` of the column — a one-row query.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMERIC_LIKE = ("int", "bigint", "smallint", "tinyint", "long", "short", "byte", "decimal",
                 "double", "float", "date", "timestamp", "timestamp_ntz")


def _as_dbtable(table_or_query: str) -> str:
    q = table_or_query.strip()
    if q.lower().startswith("select"):
        return f"({q}) AS src"
    return q


def bucket_predicates(expr: str, n: int) -> list[str]:
    """One predicate per bucket of ``expr``; the first also takes what no bucket would hold (NULL, or a
    remainder outside 0..n-1), so each row is read exactly once."""
    first = f"({expr}) = 0 OR ({expr}) IS NULL OR ({expr}) NOT BETWEEN 0 AND {n - 1}"
    return [first, *(f"({expr}) = {i}" for i in range(1, n))]


def depth_cuts(keys: DataFrame, column: str, n: int, accuracy: int = 10_000) -> list:
    """At most ``n - 1`` ascending values that cut the rows of ``keys`` into parts of nearly equal size, from a
    quantile sketch of the column (one aggregate; the sketch is bounded by ``accuracy``)."""
    wanted = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array().cast("array<double>")
    found = keys.select(F.percentile_approx(F.col(column), wanted, accuracy)).first()[0] if n > 1 else None
    return sorted(set(found or []))


def _literal(value) -> str:
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"'{value}'"
    return str(value)


def depth_predicates(column: str, cuts: list) -> list[str]:
    """One range of ``column`` for each part between the cuts; the first also takes NULL, so each row is read exactly
    once.  A value that is repeated cannot be cut: its part is as large as it is."""
    if not cuts:
        return ["1 = 1"]
    marks = [_literal(c) for c in cuts]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:], strict=False)]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *inner, f"{column} >= {marks[-1]}"]


def require_range_key(column: str, kind: str) -> None:
    if not kind.startswith(_NUMERIC_LIKE):
        raise ValueError(f"{column} is of type {kind} and cannot be cut into ranges; give bucket_expr or predicates")


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, *,
              partition_column: str | None = None, num_partitions: int = 10,
              lower_bound=None, upper_bound=None, predicates: list[str] | None = None,
              bucket_expr: str | None = None, balanced: bool = False, properties: dict | None = None) -> DataFrame:
    """``balanced``: cut the partitions at quantiles of the key instead of equal strides, for keys whose values crowd
    together; the key alone is read first, by equal strides.

    ``bucket_expr``: for keys that cannot drive range partitions (text), a
    SQL expression of the source database with ``{n}`` for the partition
    count, e.g. ``"MOD(ABS(HASHTEXT(uid)), {n})"``; it becomes one predicate per
    partition (see :func:`bucket_predicates`)."""
    props = dict(properties or {})
    dbtable = _as_dbtable(table_or_query)
    if bucket_expr and not predicates:
        predicates = bucket_predicates(bucket_expr.format(n=num_partitions), num_partitions)
    if predicates:
        return spark.read.jdbc(url, dbtable, predicates=predicates, properties=props)
    if partition_column is None:
        return spark.read.jdbc(url, dbtable, properties=props)
    if lower_bound is None or upper_bound is None:
        # the column type comes from a zero-row schema probe
        whole = spark.read.jdbc(url, dbtable, properties=props)
        kinds = {f.name.lower(): f.dataType.simpleString() for f in whole.schema.fields}
        require_range_key(partition_column, kinds.get(partition_column.lower(), "missing"))
        stats = spark.read.jdbc(
            url, f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {dbtable}) AS b",
            properties=props)
        row = stats.first()
        if row is None or row[0] is None:
            return spark.read.jdbc(url, dbtable, properties=props)
        lower_bound, upper_bound = row[0], row[1]
        if lower_bound == upper_bound:
            num_partitions = 1
    stride = {"column": partition_column, "lowerBound": lower_bound, "upperBound": upper_bound,
              "numPartitions": num_partitions, "properties": props}
    if balanced:
        keys = spark.read.jdbc(url, f"(SELECT {partition_column} FROM {dbtable}) AS k", **stride)
        cuts = depth_cuts(keys, partition_column, num_partitions)
        return spark.read.jdbc(url, dbtable, predicates=depth_predicates(partition_column, cuts), properties=props)
    return spark.read.jdbc(url, dbtable, **stride)
