"""JSON records as typed columns: by declared schema, or by inference."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


def typed_rows(items: DataFrame, schema: T.StructType, item: str = "item") -> DataFrame:
    """Replace ``item`` by the declared columns; a value that does not fit its type becomes null.

    What stands behind the end of a record is not looked at here;
    :func:`pagedframes.operators.field_problems` tells of it.

    ``from_json`` makes every field nullable, so ``required`` is for
    :func:`pagedframes.operators.validate` to check.
    """
    keep = [F.col(f"`{c}`") for c in items.columns if c != item]
    return items.select(*keep, F.from_json(item, schema).alias("__record")).select(*keep, "__record.*")


def infer_schema(items: DataFrame, item: str = "item") -> T.StructType:
    """The merged schema of all records, as ``spark.read.json`` would infer it.

    One aggregate over the records: each task merges what it sees, and a
    single text comes to the driver. Records that are no JSON objects add the
    column ``_corrupt_record``.
    """
    text = F.col(item)
    record = F.when(F.json_object_keys(text).isNotNull(), F.try_parse_json(text))
    merged, corrupt = items.agg(
        F.schema_of_variant_agg(record), F.count_if(text.isNotNull() & record.isNull())
    ).first()
    schema = _without_empty(_schema_of(merged)) or T.StructType()
    if corrupt:
        schema.add(_CORRUPT, T.StringType())
    return T.StructType(sorted(schema.fields, key=lambda field: field.name))


def infer_rows(items: DataFrame, item: str = "item") -> DataFrame:
    """Typed rows with the inferred schema.

    ``items`` is computed twice, so land what cannot be read again as it was.
    """
    schema = infer_schema(items, item)
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    return items.select(F.from_json(item, schema, options).alias("__record")).select("__record.*")


# in the text of a variant schema, outside quoted names: what differs from a Spark schema
_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bDECIMAL\((\d+), *(\d+)\)|\b(?:VOID|VARIANT)\b(?!:)")


def _schema_of(text: str | None) -> T.StructType:
    def in_spark(found: re.Match) -> str:
        word = found.group(0)
        if word.startswith("`"):
            return word
        if word == "OBJECT":
            return "STRUCT"
        if word.startswith("DECIMAL"):
            # whole numbers beyond 64 bits stay decimal, fractions are doubles
            return word if found.group(2) == "0" and int(found.group(1)) > 19 else "DOUBLE"
        return "STRING"  # never a value, or values of several types

    if text is None or not text.startswith("OBJECT<"):
        return T.StructType()
    return T.StructType.fromDDL("record " + _VARIANT_TYPE.sub(in_spark, text))["record"].dataType


def _without_empty(kind: T.DataType) -> T.DataType | None:
    """Objects that never had a field give no column."""
    if isinstance(kind, T.ArrayType):
        element = _without_empty(kind.elementType)
        return element and T.ArrayType(element)
    if isinstance(kind, T.StructType):
        held = [(field.name, _without_empty(field.dataType)) for field in kind]
        fields = [T.StructField(name, inner) for name, inner in held if inner is not None]
        return T.StructType(fields) if fields else None
    return kind


def narrowed(schema: T.StructType, columns: Sequence[str] | None) -> T.StructType:
    """The declared schema cut down to ``columns``, so that only these are parsed."""
    if columns is None:
        return schema
    unknown = [c for c in columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"no such fields: {', '.join(unknown)}")
    return T.StructType([schema[c] for c in columns])
