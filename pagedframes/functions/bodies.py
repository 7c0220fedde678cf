"""Column expressions over response bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_json(body: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    Spark's JSON functions stop at the end of the first value. Between
    brackets, text after it is an error unless it begins with a closing
    bracket, and between braces unless it begins with a closing brace; only
    the end of the text passes both. Values are skipped over, so no tree is built.
    """
    listed = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
    held = F.json_object_keys(F.concat(F.lit('{"v":'), body, F.lit("}"))).isNotNull()
    return F.coalesce(listed & held, F.lit(False))


_MARK = "__whole"


def whole_record(text: Column, schema: T.StructType) -> Column:
    """``text`` parsed as ``schema`` (and a field ``__whole``); null unless it is one JSON object and nothing else.

    One parse that notices what stands after the object: the text goes into an
    array in front of a mark, its own hash. Only if the text ends where its
    object ends, the array holds these two and nothing more.
    """
    mark = F.xxhash64(text)
    marked = F.concat(F.lit("["), text, F.lit(f',{{"{_MARK}":'), mark.cast("string"), F.lit("}]"))
    held = F.from_json(marked, T.ArrayType(T.StructType([*schema.fields, T.StructField(_MARK, T.LongType())])))
    # the array of one makes one parse of it, wherever it is used
    first = F.transform(F.array(held), lambda h: F.when((F.size(h) == 2) & (F.get(h, F.lit(1))[_MARK] == mark), F.get(h, F.lit(0))))
    return F.get(first, F.lit(0))


def whole_variant(text: Column) -> Column:
    """``text`` as a variant; null unless it is one JSON value and nothing else. One parse, as in :func:`whole_record`."""
    mark = F.xxhash64(text).cast("string")
    held = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    one = F.transform(
        F.array(held),
        lambda h: F.when(
            (F.try_variant_get(h, "$[1]", "string") == mark) & F.try_variant_get(h, "$[2]", "variant").isNull(),
            F.try_variant_get(h, "$[0]", "variant"),
        ),
    )
    return F.get(one, F.lit(0))


def body_shape(body: Column) -> Column:
    """``object``, ``array``, ``scalar``, or null when the text is not JSON.

    The first character tells the shape, and the whole text must parse: what
    stands after the end of a value makes it no JSON.
    """
    first = F.substring(F.ltrim(body, F.lit(" \t\r\n")), 1, 1)
    return (
        F.when(~whole_json(body), F.lit(None).cast("string"))
        .when(first == "{", F.lit("object"))
        .when(first == "[", F.lit("array"))
        .otherwise(F.lit("scalar"))
    )


def utf8_text(content: Column) -> Column:
    """Bytes as text; each byte run that is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))
