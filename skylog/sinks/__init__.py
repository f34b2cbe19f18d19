from skylog.sinks.csv import ExportError, export_summary, export_tables, verify_export, write_csv
from skylog.sinks.fact import append_keyed, append_new, new_rows, rebuild_fact

__all__ = [
    "ExportError",
    "append_keyed",
    "append_new",
    "export_summary",
    "export_tables",
    "new_rows",
    "rebuild_fact",
    "verify_export",
    "write_csv",
]
