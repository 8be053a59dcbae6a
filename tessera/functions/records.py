"""Record-level expressions: display lines, stable hash buckets, composite
records and year predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def labeled_line(*pairs: tuple[str, Column | str]) -> Column:
    """``"Label: value, Label2: value2"``; a NULL value prints as ``null``."""
    parts = [F.concat(F.lit(f"{label}: "), F.coalesce(_c(v).cast("string"), F.lit("null")))
             for label, v in pairs]
    return F.concat_ws(", ", *parts)


def hash_bucket(key: Column | str, buckets: int = 10) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(key as text).

    Depends on the key only, so a split made with it is the same for any
    partitioning, on re-execution after executor loss, and in other engines.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def composite_record(key: Column | str, features: Column | str, label: Column | str,
                     field_sep: str = ",", item_sep: str = "::") -> Column:
    """Export form ``key,f0::f1::...,label``; a NULL part is written as ``null``, so every
    record has three fields and every feature keeps its place."""
    text = lambda c: F.coalesce(_c(c).cast("string"), F.lit("null"))
    items = F.coalesce(F.array_join(_c(features), item_sep, "null"), F.lit("null"))
    return F.concat_ws(field_sep, text(key), items, text(label))


def parse_composite_record(record: Column | str, field_sep: str = ",", item_sep: str = "::"):
    """Inverse of :func:`composite_record`: (key, features array, label) columns.  The separators are
    taken as plain text; a record has exactly three fields, the last one takes the rest."""
    parts = F.split(_c(record), _quoted(field_sep), 3)
    return F.get(parts, 0), F.split(F.get(parts, 1), _quoted(item_sep), -1), F.get(parts, 2)


def _quoted(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def year_range(ts: Column | str, year: int) -> Column:
    """Half-open [year-01-01, year+1-01-01) predicate; reaches the Parquet scan
    as two pushed filters, unlike ``year(ts) = y``."""
    # string literals are coerced to the column's own timestamp type, so the
    # cast folds into the constant and the column stays bare for pushdown
    c = _c(ts)
    return (c >= F.lit(f"{year:04d}-01-01 00:00:00")) & (c < F.lit(f"{year + 1:04d}-01-01 00:00:00"))
