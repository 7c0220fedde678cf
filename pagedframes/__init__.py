"""Datasets of paged JSON APIs as Spark DataFrames."""

from pagedframes.operators import flatten, flatten_schema, infer_rows, typed_rows, validate
from pagedframes.reader import PagedAPI
from pagedframes.replay import LandedTransport
from pagedframes.sources import (
    FunctionTransport,
    HttpTransport,
    Budget,
    Paging,
    Transport,
    pages_from_files,
    pages_from_table,
    register_transport,
    unnest,
    unnest_typed,
)

__all__ = [
    "flatten",
    "flatten_schema",
    "infer_rows",
    "typed_rows",
    "validate",
    "PagedAPI",
    "FunctionTransport",
    "HttpTransport",
    "Budget",
    "LandedTransport",
    "Paging",
    "Transport",
    "pages_from_files",
    "pages_from_table",
    "register_transport",
    "unnest",
    "unnest_typed",
]
