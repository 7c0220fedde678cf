"""Pages that were already landed: plain Spark scans, the way to read volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedframes.constants import BLOCK_PAGES
from pagedframes.storage import shuffles_released

#: bodies in one page of a landed file
FILE_ROWS = 8


def pages_from_files(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """One page body per file. Returns ``file, body`` (and ``dataset`` when it is given)."""
    pages = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")
    )
    return pages if dataset is None else pages.select(F.lit(dataset).alias("dataset"), "file", "body")


def pages_from_table(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Pages landed as a parquet table with the columns ``dataset, page, body``."""
    pages = spark.read.parquet(path).select("dataset", "page", "body")
    return pages if dataset is None else pages.filter(F.col("dataset") == dataset)


def block_of(page: str) -> Column:
    """The block of a landing table that holds a page."""
    return F.expr(f"({page} - 1) div {BLOCK_PAGES}")


def land_pages(pages: DataFrame, path: str, mode: str = "errorifexists", dealt: bool = False) -> None:
    """Write ``dataset, page, body`` in blocks of consecutive pages, ordered by page.

    A block is a folder whose name follows from the page number, so whoever
    wants a page range finds it without opening any other block. Many small
    datasets share block 0, but are dealt out over many files. Pages that are
    ``dealt`` have each block of a dataset in one partition and do not move.
    """
    blocks = pages.select("dataset", "page", "body", block_of("page").alias("block"))
    if not dealt:
        blocks = blocks.repartition("dataset", "block")
    # bodies are large: small row groups let a page range skip most of its block, and small
    # pages of the file (by itself Parquet writes no less than 100 rows) let a reader hold few bodies
    writer = blocks.sortWithinPartitions("block", "dataset", "page").write.option("parquet.block.size", 8 * 1024 * 1024)
    writer = writer.option("parquet.page.row.count.limit", FILE_ROWS).option("parquet.page.size.row.check.min", FILE_ROWS)
    with shuffles_released(pages.sparkSession):
        writer.option("compression", "zstd").mode(mode).partitionBy("block").parquet(path)
