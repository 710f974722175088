"""Readers: parquet tables, delimited text, text lines, whole files, file manifests."""

from tessera.sources.tables import table
from tessera.sources.text import (read_delimited, read_lines, read_whole_files,
                                  read_headers, number_range, from_rows,
                                  register_delimited)

__all__ = ["table", "read_delimited", "read_lines", "read_whole_files",
           "read_headers", "number_range", "from_rows", "register_delimited"]
