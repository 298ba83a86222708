"""Sources: CSV, UTF-16 TSV, report files, catalog JSON, JDBC."""

from .files import (
    read_catalog_json,
    read_csv_files_by_name,
    read_csv_strings,
    read_csv_table,
    read_report_files,
    file_snapshot_stamp,
    read_utf16_tsv,
    with_file_stamp,
)
from .jdbc import key_ranges, read_jdbc_query, read_jdbc_table, read_permit_tables
from .manifest import changed_files, file_listing, load_changed
from .utf16 import read_utf16_tsv_ranges

__all__ = [n for n in dir() if not n.startswith("_")]
