from skylog.sources.locations import locations, with_location
from skylog.sources.payloads import (
    PayloadFolder,
    explode_payloads,
    fill_null_arrays,
    landed_files,
    latest_files,
    parse_payloads,
    payload_problems,
    read_payloads,
    read_texts,
    split_file_name,
)
from skylog.sources.tables import (
    csv_unreadable,
    find_fact,
    read_csv_lenient,
    read_csv_strict,
    read_fact,
    row_count,
    table_exists,
)

__all__ = [
    "PayloadFolder",
    "csv_unreadable",
    "explode_payloads",
    "find_fact",
    "fill_null_arrays",
    "landed_files",
    "latest_files",
    "locations",
    "parse_payloads",
    "payload_problems",
    "read_csv_lenient",
    "read_csv_strict",
    "read_fact",
    "read_payloads",
    "read_texts",
    "row_count",
    "split_file_name",
    "table_exists",
    "with_location",
]
