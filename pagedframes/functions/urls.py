"""Column expressions over URLs and query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagedframes.constants import PAGE_SIZE, PAGING_PARAMS


def _decoded(text: Column) -> Column:
    # a stray percent sign makes the text undecodable; it is then kept as it is
    return F.coalesce(F.try_url_decode(text), text)


def query_part(url: Column) -> Column:
    """What stands between ``?`` and ``#``; null when there is no ``?``.

    The text decides, so a URL that is otherwise malformed keeps its query.
    """
    return F.when(url.rlike(r"^[^?#]*\?"), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))


def query_pairs(query: Column) -> Column:
    """``k=v&k=w&flag`` as ``ARRAY<STRUCT<key, value>>`` in text order.

    ``flag`` and ``flag=`` have a null value. Only the first ``=`` separates,
    so ``k=a=b`` has the value ``a=b``.
    """

    def pair(part: Column) -> Column:
        halves = F.split(F.rtrim(part, F.lit("=")), "=", 2)
        return F.struct(
            _decoded(F.get(halves, F.lit(0))).alias("key"),
            _decoded(F.get(halves, F.lit(1))).alias("value"),
        )

    return F.transform(F.split(query, "&"), pair)


def query_values(pairs: Column) -> Column:
    """Pairs as ``MAP<key, ARRAY<value>>``, values in text order.

    A query string sits in one row, so grouping its keys needs no shuffle.
    """
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))

    def entry(key: Column) -> Column:
        own = F.filter(pairs, lambda p: p["key"] == key)
        return F.struct(key, F.transform(own, lambda p: p["value"]))

    return F.map_from_entries(F.transform(keys, entry))


def query_string(params: Column) -> Column:
    """``MAP<STRING, STRING>`` as an encoded query string, keys in order; empty map gives ''."""
    entries = F.array_sort(F.map_entries(params))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))),
        "&",
    )


def page_query(
    query: Column,
    page: Column,
    size: int = PAGE_SIZE,
    page_param: str = PAGING_PARAMS[1],
    size_param: str = PAGING_PARAMS[0],
) -> Column:
    """A query string extended by the paging parameters."""
    return F.concat_ws(
        "&",
        F.when(query != "", query),
        F.lit(f"{size_param}={size}"),
        F.concat(F.lit(f"{page_param}="), page.cast("string")),
    )
