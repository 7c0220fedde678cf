"""Query parameters of URLs as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedframes.functions.urls import query_pairs, query_part, query_values


def url_params(rows: DataFrame, url: str = "url") -> DataFrame:
    """One row per parameter: the other columns, ``pos``, ``key`` and ``value``."""
    keep = [F.col(f"`{c}`") for c in rows.columns if c != url]
    pairs = query_pairs(query_part(F.col(url)))
    return rows.select(*keep, F.posexplode(pairs).alias("pos", "pair")).select(*keep, "pos", "pair.key", "pair.value")


def url_param_values(rows: DataFrame, url: str = "url") -> DataFrame:
    """One row per key of each URL: the other columns, ``key`` and the array ``values`` in text order."""
    keep = [F.col(f"`{c}`") for c in rows.columns if c != url]
    pairs = query_pairs(query_part(F.col(url)))
    parsed = rows.select(*keep, pairs.alias("__pairs"))
    return parsed.select(*keep, F.explode(query_values(F.col("__pairs"))).alias("key", "values"))
