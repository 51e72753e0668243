"""Sources and sinks."""

from .files import (CORRUPT, REJECT, escape_text, inline_frame, parse_json_column, read_delimited, read_jdbc,
                    read_json_lines, read_lines, register_view, rename_columns, run_sql, unescape_text)
from .sinks import write_delimited, write_json_lines, write_table, write_text
from .typed import read_counts, reject_rows, typed_projection, valid_rows

__all__ = [
    "CORRUPT", "REJECT", "escape_text", "unescape_text", "read_counts", "inline_frame", "parse_json_column", "read_delimited", "read_jdbc",
    "read_json_lines", "read_lines", "register_view", "rename_columns", "run_sql",
    "write_delimited", "write_json_lines", "write_table", "write_text", "reject_rows", "typed_projection", "valid_rows",
]
