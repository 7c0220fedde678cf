"""From response bodies to records.

A page body is ``{"$total": n, ..., "$items": [record, ...]}``. Records are
kept as JSON text (``unnest``), or parsed together with their envelope in a
single pass when the record schema is known (``unnest_typed``). Everything
here is a narrow transformation: no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.functions.bodies import body_shape, whole_record

TOTAL = "$total"
ITEMS = "$items"
SLICE = ("first", "size")  # columns of the paged source: which items of the page to take


def _envelope(record: T.DataType) -> T.StructType:
    return T.StructType().add(TOTAL, T.LongType()).add(ITEMS, T.ArrayType(record))


def _fail(*message: Column | str) -> Column:
    parts = [F.lit(m) if isinstance(m, str) else F.coalesce(m.cast("string"), F.lit("null")) for m in message]
    return F.raise_error(F.concat(*parts))


def _open(pages: DataFrame, record: T.DataType, body: str, strict: bool) -> tuple[DataFrame, list[Column], Column]:
    """The pages with their body parsed, the columns to keep, and the items to explode."""
    sliced = all(c in pages.columns for c in SLICE)
    keep = [F.col(f"`{c}`") for c in pages.columns if c != body and not (sliced and c in SLICE)]
    # text after the end of the envelope makes the body unreadable
    parsed = pages.withColumn("__envelope", whole_record(F.col(f"`{body}`"), _envelope(record)))
    items = F.col("__envelope").getField(ITEMS)
    held = F.coalesce(items, F.array())
    if strict:
        where = F.col("page") if "page" in pages.columns else F.lit("?")
        held = F.when(items.isNull(), _fail("page ", where, " is not a readable page body")).otherwise(items)
    if sliced:
        first, size = F.col("first"), F.col("size")
        rest = F.slice(held, first + 1, F.coalesce(size, F.size(items)))
        held = F.when(
            F.size(items) < first + size,
            _fail("page ", F.col("page"), " holds ", F.size(items), " items, expected ", first + size),
        ).otherwise(rest)
    return parsed, [*keep, F.col("__envelope").getField(TOTAL).alias("total")], held


# The items go into explode as an expression: of a column, Catalyst would
# infer a filter on its size and evaluate the expression behind it twice.


def unnest(pages: DataFrame, body: str = "body", strict: bool = True) -> DataFrame:
    """One row per item: the page's own columns, ``total``, ``pos`` and the JSON text ``item``.

    A body that is no page fails the read; with ``strict=False`` it gives no
    rows and is left to :func:`body_rejects`.
    """
    parsed, keep, items = _open(pages, T.StringType(), body, strict)
    return parsed.select(*keep, F.posexplode(items).alias("pos", "item"))


def unnest_typed(pages: DataFrame, schema: T.StructType, body: str = "body", strict: bool = True) -> DataFrame:
    """One row per item with the declared columns, parsed in the same pass as the envelope."""
    parsed, _, items = _open(pages, schema, body, strict)
    return parsed.select(F.explode(items).alias("__record")).select("__record.*")


def read_object(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Bodies of shape ``object``: one ``item`` per body. Any other shape fails."""
    return _expect(bodies, body, "object").withColumnRenamed(body, "item")


def read_array(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Bodies of shape ``array``: one ``item`` per element. Any other shape fails."""
    checked = _expect(bodies, body, "array")
    keep = [F.col(f"`{c}`") for c in bodies.columns if c != body]
    elements = F.from_json(F.col(body), T.ArrayType(T.StringType()))
    return checked.select(*keep, F.posexplode(elements).alias("pos", "item"))


def _expect(bodies: DataFrame, body: str, shape: str) -> DataFrame:
    text = F.col(f"`{body}`")
    found = body_shape(text)
    checked = F.when(found == shape, text).otherwise(
        _fail(f"expected a body of shape {shape}, found ", F.coalesce(found, F.lit("no JSON")))
    )
    return bodies.withColumn(body, checked)


def body_rejects(pages: DataFrame, body: str = "body") -> DataFrame:
    """The page bodies that cannot be unnested, each with a ``reason``."""
    text = F.col(f"`{body}`")
    shape = body_shape(text)
    items = F.from_json(text, _envelope(T.StringType())).getField(ITEMS)
    reason = (
        F.when(text.isNull(), F.lit("null body"))
        .when(shape.isNull(), F.lit("not json"))
        .when(items.isNotNull(), F.lit(None).cast("string"))
        .when(shape != "object", F.lit("not an object"))
        .otherwise(F.lit("no $items"))
    )
    return pages.withColumn("reason", reason).filter(F.col("reason").isNotNull())
