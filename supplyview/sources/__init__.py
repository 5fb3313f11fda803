"""Readers: workbooks, CSV and JSON files, date folders."""
