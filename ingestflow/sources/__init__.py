"""Sources: the given tables, request/history files, and file listings."""

from ingestflow.sources.tables import read_json_lines, read_table

__all__ = ["read_table", "read_json_lines"]
