"""Compare records with the declared schema.

Each record gives an array of its own problems; exploding that array and
counting per (field, problem) shuffles a handful of partial counts, however
many records there are. Records without a problem give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.functions.bodies import whole_json

_WRITTEN = T.MapType(T.StringType(), T.StringType())  # an object as written: field name -> JSON text
_NONE = "array<struct<field:string,problem:string>>"

Path = tuple[str, ...]


def _problem(path: str, kind: str) -> Column:
    return F.struct(F.lit(path).alias("field"), F.lit(kind).alias("problem"))


def _when(condition: Column, path: str, kind: str) -> Column:
    return F.when(condition, F.array(_problem(path, kind))).otherwise(F.array().cast(_NONE))


def _struct_paths(schema: T.StructType, path: Path = ()) -> list[Path]:
    """The paths of all structs that no array holds, outer before inner."""
    found = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found.append((*path, field.name))
            found.extend(_struct_paths(field.dataType, (*path, field.name)))
    return found


class _Written:
    """The written objects of a record; those outside arrays are columns, each parsed once."""

    def __init__(self, schema: T.StructType):
        self.names = {(): "__written"}
        for path in _struct_paths(schema):
            self.names[path] = f"__written{len(self.names)}"

    def add_to(self, rows: DataFrame, item: str) -> DataFrame:
        rows = rows.withColumn("__written", F.from_json(item, _WRITTEN))
        depth = max(len(path) for path in self.names)
        for level in range(1, depth + 1):
            texts = {p: F.element_at(self.names[p[:-1]], F.lit(p[-1])) for p in self.names if len(p) == level}
            rows = rows.withColumns({self.names[p]: F.from_json(text, _WRITTEN) for p, text in texts.items()})
        return rows

    def child(self, path: Path | None, text: Column) -> Column:
        return F.from_json(text, _WRITTEN) if path is None else F.col(self.names[path])


def _struct_problems(
    written: Column, typed: Column, schema: T.StructType, label: str, objects: _Written, path: Path | None
) -> list[Column]:
    """``written`` is the object as text, ``typed`` what the schema made of it; ``path`` is None below an array."""
    prefix = f"{label}." if label else ""
    declared = F.array(*[F.lit(name) for name in schema.fieldNames()])
    extra = F.coalesce(F.array_except(F.map_keys(written), declared), F.array().cast("array<string>"))

    def undeclared(name: Column) -> Column:
        return F.struct(F.concat(F.lit(prefix), name).alias("field"), F.lit("undeclared").alias("problem"))

    found = [F.transform(extra, undeclared)]
    for field in schema.fields:
        text, value = F.element_at(written, F.lit(field.name)), typed.getField(field.name)
        here = prefix + field.name
        if not field.nullable:
            found.append(_when(written.isNotNull() & text.isNull(), here, "missing"))
        found.append(_when(text.isNotNull() & value.isNull(), here, "unreadable"))
        below = None if path is None else (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            inner = objects.child(below, text)
            found.extend(_struct_problems(inner, value, field.dataType, here, objects, below))
        elif isinstance(field.dataType, T.ArrayType):
            found.append(_array_problems(text, value, field.dataType.elementType, f"{here}[]", objects))
    return found


def _array_problems(text: Column, typed: Column, element: T.DataType, label: str, objects: _Written) -> Column:
    is_struct = isinstance(element, T.StructType)
    written = F.from_json(text, T.ArrayType(_WRITTEN if is_struct else T.StringType()))
    # either side may be null; then there is nothing to compare
    pairs = F.arrays_zip(written.alias("written"), typed.alias("typed"))
    if not is_struct:
        bad = F.exists(pairs, lambda pair: pair["written"].isNotNull() & pair["typed"].isNull())
        return _when(F.coalesce(bad, F.lit(False)), label, "unreadable")

    def of_one(pair: Column) -> Column:
        return F.concat(*_struct_problems(pair["written"], pair["typed"], element, label, objects, None))

    # several elements with the same problem are one problem of the record
    looked_at = F.filter(pairs, lambda pair: ~_flawless(pair, element))
    return F.coalesce(F.array_distinct(F.flatten(F.transform(looked_at, of_one))), F.array().cast(_NONE))


def _flawless(pair: Column, element: T.StructType) -> Column:
    """Whether an element holds all declared fields, each of its type, and nothing else, so that it needs no closer look."""
    if any(isinstance(field.dataType, (T.StructType, T.ArrayType)) for field in element.fields):
        return F.lit(False)
    held = F.size(pair["written"]) == len(element.fields)
    for field in element.fields:
        held = held & pair["typed"].getField(field.name).isNotNull()
    return F.coalesce(held, F.lit(False))


def field_problems(items: DataFrame, schema: T.StructType, item: str = "item") -> DataFrame:
    """One row per record and problem: the input's columns, ``field`` and ``problem``.

    ``missing`` is a required field without a value, ``unreadable`` a value
    that the declared type cannot hold, ``undeclared`` a field the schema does
    not know. A record that is no object, or that text follows, has the problem
    ``unreadable`` with the field ``$``. Elements of arrays are checked one by one.
    """
    keep = [F.col(f"`{c}`") for c in items.columns]
    objects = _Written(schema)
    parsed = objects.add_to(items.withColumn("__typed", F.from_json(item, schema)), item)
    written = F.col("__written")
    parts = _struct_problems(written, F.col("__typed"), schema, "", objects, ())
    problems = F.when(written.isNotNull() & whole_json(F.col(f"`{item}`")), F.concat(*parts)).otherwise(F.array(_problem("$", "unreadable")))
    # As a column of its own the array is computed with common parts shared. The
    # outer explode keeps Catalyst from computing it once more in a filter.
    each = parsed.select(*keep, problems.alias("__problems")).select(*keep, F.explode_outer("__problems").alias("__one"))
    return each.filter(F.col("__one").isNotNull()).select(*keep, "__one.field", "__one.problem")


def validate(items: DataFrame, schema: T.StructType, item: str = "item") -> DataFrame:
    """Records per ``field`` and ``problem``; only problems that occur are listed."""
    return (
        field_problems(items.select(item), schema, item).groupBy("field", "problem").agg(F.count("*").alias("records"))
    )
