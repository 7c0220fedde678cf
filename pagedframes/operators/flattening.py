"""Nested structs as top-level columns ``a_b_c``; arrays stay whole."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Leaf = tuple[tuple[str, ...], T.StructField]


def _leaves(schema: T.StructType, path: tuple[str, ...] = (), nullable: bool = False) -> Iterator[Leaf]:
    for field in schema.fields:
        here, null_here = (*path, field.name), nullable or field.nullable
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here, null_here)
        else:
            yield here, T.StructField(flat_name(here), field.dataType, null_here, field.metadata)


def flat_name(path: tuple[str, ...]) -> str:
    return "_".join(path).replace(".", "_")


def _checked_leaves(schema: T.StructType) -> list[Leaf]:
    leaves = list(_leaves(schema))
    users = defaultdict(list)
    for path, field in leaves:
        users[field.name.lower()].append(" > ".join(path))
    clashes = {name: paths for name, paths in users.items() if len(paths) > 1}
    if clashes:
        told = "; ".join(f"{name} from {' and '.join(paths)}" for name, paths in clashes.items())
        raise ValueError(f"flattening would repeat column names: {told}")
    return leaves


def flatten(df: DataFrame) -> DataFrame:
    """One projection over ``df``, columns in depth-first order."""
    return df.select(
        *[
            F.col(".".join("`" + part.replace("`", "``") + "`" for part in path)).alias(field.name)
            for path, field in _checked_leaves(df.schema)
        ]
    )


def flatten_schema(schema: T.StructType) -> T.StructType:
    """The schema that :func:`flatten` gives; a leaf is nullable if anything on its path is."""
    return T.StructType([field for _, field in _checked_leaves(schema)])
