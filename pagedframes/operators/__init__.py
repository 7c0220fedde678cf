from pagedframes.operators.audit import missing_pages, page_audit, repeated_pages
from pagedframes.operators.flattening import flatten, flatten_schema
from pagedframes.operators.keys import read_by_key, read_by_keys, unmatched_keys
from pagedframes.operators.typed import infer_rows, infer_schema, typed_rows
from pagedframes.operators.urls import url_param_values, url_params
from pagedframes.operators.validation import field_problems, validate

__all__ = [
    "missing_pages",
    "page_audit",
    "repeated_pages",
    "flatten",
    "flatten_schema",
    "read_by_key",
    "read_by_keys",
    "unmatched_keys",
    "infer_rows",
    "infer_schema",
    "typed_rows",
    "url_param_values",
    "url_params",
    "field_problems",
    "validate",
]
