"""JSON access through Variant: parse once, read typed fields, never fail a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_array(text: Column | str) -> Column:
    """``array<variant>`` of a JSON array string; NULL when malformed or not an array."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_parse_json(c).try_cast("array<variant>")


def json_get(v: Column, path: str, type_: str = "string") -> Column:
    """Typed field of a variant; NULL when missing, JSON null, or of another shape."""
    return F.try_variant_get(v, path, type_)


def json_has(v: Column, path: str) -> Column:
    """True when ``path`` exists (a JSON null value counts as present)."""
    return F.try_variant_get(v, path, "variant").isNotNull()
