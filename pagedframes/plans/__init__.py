from pagedframes.plans.catalogue import (
    base_url,
    dataset_endpoint,
    datasets,
    endpoints,
    query_params,
    read_paths,
    write_paths,
)
from pagedframes.plans.schemas import declared_schema, field_paths, fields, flat_fields
from pagedframes.plans.pages import page_plan
from pagedframes.plans.params import (
    enum_violations,
    filter_rows,
    missing_params,
    param_problems,
    request_query,
)

__all__ = [
    "base_url",
    "dataset_endpoint",
    "datasets",
    "endpoints",
    "query_params",
    "read_paths",
    "write_paths",
    "declared_schema",
    "field_paths",
    "fields",
    "flat_fields",
    "page_plan",
    "enum_violations",
    "filter_rows",
    "missing_params",
    "param_problems",
    "request_query",
]
