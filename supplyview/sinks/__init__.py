"""Writers (K1-K6)."""

from supplyview.sinks.store import Store, Version
from supplyview.sinks.tables import (
    table_files,
    table_lines,
    write_aliases,
    write_combined_csv,
    write_dimension,
    write_fact,
    write_pivot_csv,
    write_results,
    write_tables_csv,
)

__all__ = [
    "Store",
    "Version",
    "table_files",
    "table_lines",
    "write_aliases",
    "write_combined_csv",
    "write_dimension",
    "write_fact",
    "write_pivot_csv",
    "write_results",
    "write_tables_csv",
]
