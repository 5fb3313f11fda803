"""Incremental runs over newly arrived date folders."""

from supplyview.streaming.arrivals import report_new_dates, stream_files

__all__ = ["report_new_dates", "stream_files"]
