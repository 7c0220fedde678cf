"""Records by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_by_key(rows: DataFrame, key: object, column: str = "id") -> DataFrame:
    """The record with one key; a plain filter, so it can reach the scan."""
    if key is None:
        raise ValueError("a key is required")
    return rows.filter(F.col(column) == F.lit(key))


_COPIES = 64


def _thinned(rows: DataFrame, column: str) -> DataFrame:
    """The keys of ``rows``, each at most 64 times, however often it occurs.

    A plain distinct would do too, but as the last step before a join it takes
    the place of the join's own shuffle, and then adaptive execution does not
    split the other side where that is skewed.
    """
    salted = rows.select(column, (F.spark_partition_id() % _COPIES).alias("__salt"))
    return salted.distinct().select(column)


def read_by_keys(rows: DataFrame, keys: DataFrame, column: str = "id") -> DataFrame:
    """The records whose key is in ``keys``, each once, however often a key is given.

    The strategy is left to Spark: broadcast when the measured key side is
    small, else a shuffle whose skewed partitions adaptive execution splits.
    Null keys are left out here, and the join then takes nulls for equal, since
    else Catalyst would look for null keys of ``rows`` in a filter before the
    join, and parse records once more for it.
    """
    wanted = _thinned(keys.filter(F.col(f"`{column}`").isNotNull()), column).withColumnRenamed(column, "__key")
    return rows.join(wanted, rows[f"`{column}`"].eqNullSafe(wanted["__key"]), "left_semi")


def unmatched_keys(rows: DataFrame, keys: DataFrame, column: str = "id") -> DataFrame:
    """The keys, each once, that no record has. A null key matches nothing and is listed."""
    return keys.select(column).distinct().join(_thinned(rows, column), column, "left_anti")
