"""Readers and writers.  Every source returns a DataFrame with a declared or
inferred schema; no rows pass through the driver."""

from .delimited import read_lines, parse_delimited, lines_from_columns
from .files import read_parquet, write_parquet, read_json_lines, write_text_lines
from .json_docs import parse_json_column, infer_json_schema, read_json_column, map_to_json, required_json_fields
from .jdbc import depth_cuts, depth_predicates, read_jdbc
from .catalog import create_table, load_delimited_into_table, read_table, write_bucketed

__all__ = ["read_lines", "parse_delimited", "lines_from_columns",
           "read_parquet", "write_parquet", "read_json_lines", "write_text_lines",
           "parse_json_column", "infer_json_schema", "read_json_column", "map_to_json", "required_json_fields",
           "depth_cuts", "depth_predicates", "read_jdbc", "create_table", "load_delimited_into_table", "read_table",
           "write_bucketed"]
