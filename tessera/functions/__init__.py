"""Column-expression builders.  Everything here returns a ``Column`` that
runs inside whole-stage code generation; no Python runs per row."""

from .text import word_tokens, whitespace_tokens, join_tokens, WORD_PATTERN
from .json import json_array, json_get, json_has
from .records import labeled_line, hash_bucket, composite_record, parse_composite_record, year_range

__all__ = ["word_tokens", "whitespace_tokens", "join_tokens", "WORD_PATTERN",
           "json_array", "json_get", "json_has",
           "labeled_line", "hash_bucket", "composite_record", "parse_composite_record", "year_range"]
