from plumbline.sources.tables import (
    REPORT_TABLES,
    cached_scope,
    read_delimited,
    read_report,
    read_table,
    register_view,
    save_table,
    write_report,
)

__all__ = [
    "REPORT_TABLES",
    "cached_scope",
    "read_delimited",
    "read_report",
    "read_table",
    "register_view",
    "save_table",
    "write_report",
]
