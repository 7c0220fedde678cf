"""The requests that a set of datasets needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedframes.constants import PAGE_SIZE, PAGING_PARAMS
from pagedframes.functions.urls import page_query, query_string

_BLOCK = 10_000  # pages per block


def page_plan(
    totals: DataFrame,
    page_size: int = PAGE_SIZE,
    page_param: str = PAGING_PARAMS[1],
    size_param: str = PAGING_PARAMS[0],
) -> DataFrame:
    """``(dataset, total[, params])`` to one row per page, with its query string.

    The query asks for pages of the size that the plan counts with, by the
    parameter names of the server. An empty dataset still has its first page. Pages come out of blocks that
    are spread over the cluster first, so one dataset with billions of records
    is neither one array nor one task.
    """
    spark = totals.sparkSession
    params = F.col("params") if "params" in totals.columns else F.create_map().cast("map<string,string>")
    count = F.greatest(F.lit(1), F.ceil(F.col("total") / page_size)).cast("bigint")
    blocks = totals.select("dataset", query_string(params).alias("__base"), count.alias("__count")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__count") - 1) / _BLOCK))).alias("__block")
    )
    spread = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "dataset", "__block")
    low = F.col("__block") * _BLOCK + 1
    high = F.least(F.col("__count"), (F.col("__block") + 1) * _BLOCK)
    return spread.select("dataset", F.explode(F.sequence(low, high)).alias("page"), "__base").select(
        "dataset", "page", page_query(F.col("__base"), F.col("page"), page_size, page_param, size_param).alias("query")
    )
