"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedframes.storage import new_folder, write_and_reopen

#: white space of ASCII, as in the contracts of the operators
SPACES = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, and no lost executor takes it away."""
    return write_and_reopen(df, new_folder(df.sparkSession, label))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, _UPPER, _LOWER)


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of the undirected ``edges`` (``a, b`` bigint): the smallest vertex it reaches.

    Large-star and small-star steps in turn: each vertex tells its larger, then
    its smaller neighbours of the least one that it knows, until nothing
    changes. A vertex with very many neighbours is a count-like aggregate that
    combines before the shuffle, and a join that adaptive execution may split.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    pairs = cut(pairs, "links")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        pairs = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == before:
            break
        before = tuple(row)
    found = pairs.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("vertex"), "root").distinct())
