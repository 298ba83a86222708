"""Structured Streaming forms of the incremental file loads (availableNow runs)."""

from .report_stream import report_file_stream, start_active_log_stream, start_finance_stream, start_reload_stream

__all__ = ["report_file_stream", "start_active_log_stream", "start_finance_stream", "start_reload_stream"]
