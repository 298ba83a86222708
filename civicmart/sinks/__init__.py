"""Sinks: CSV files and objects, partitioned report files, keyed upserts, full replace, versioned tables, JSON records."""

from .files import write_bucketed, write_csv, write_csv_object, write_replace, write_report_partitions, write_upsert
from .published import PublishConflict, publish_replace, publish_upsert, read_published
from .records import record_column, to_payloads, to_records

__all__ = [n for n in dir() if not n.startswith("_")]
