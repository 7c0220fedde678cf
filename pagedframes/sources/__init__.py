from pagedframes.sources.bodies import csv_lines, csv_rejects, csv_rows, decode_bodies
from pagedframes.sources.envelope import (
    body_rejects,
    read_array,
    read_object,
    unnest,
    unnest_typed,
)
from pagedframes.sources.fetch import fetch_keys, land_fleet, page_runs, read_fleet
from pagedframes.sources.landed import land_pages, pages_from_files, pages_from_table
from pagedframes.sources.paged import register_transport
from pagedframes.sources.records import register_records
from pagedframes.sources.transport import Budget, FunctionTransport, HttpTransport, Paging, Transport

__all__ = [
    "csv_lines",
    "csv_rejects",
    "csv_rows",
    "decode_bodies",
    "body_rejects",
    "read_array",
    "read_object",
    "unnest",
    "unnest_typed",
    "land_pages",
    "pages_from_files",
    "pages_from_table",
    "register_transport",
    "register_records",
    "fetch_keys",
    "land_fleet",
    "page_runs",
    "read_fleet",
    "Budget",
    "FunctionTransport",
    "HttpTransport",
    "Paging",
    "Transport",
]
