"""Pages as a stream: as they are landed, or straight from the API."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pagedframes.sources.envelope import unnest, unnest_typed
from pagedframes.storage import new_folder

LANDED = "dataset STRING, page BIGINT, body STRING"


def stream_landed(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Each page that appears in a landing table ``dataset, page, body``."""
    landed = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return landed.select("dataset", "page", "body")


def stream_api(spark: SparkSession, endpoint: str, name: str = "paged", pages_per_batch: int | None = None) -> DataFrame:
    """Each item that an append-only endpoint gains, in batches of bounded size; ``name`` is a registered transport."""
    reader = spark.readStream.format(name).option("endpoint", endpoint)
    return (reader.option("maxPagesPerBatch", pages_per_batch) if pages_per_batch else reader).load()


def stream_items(pages: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The batch unnest on a stream of pages: JSON text, or typed when the schema is given."""
    return unnest(pages) if schema is None else unnest_typed(pages, schema)


def drain(stream: DataFrame, target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append what is there now to a parquet table and return that table.

    Batches are of limited size and follow each other until the source has
    given what it held at the start, or has nothing more to give. What it gains
    meanwhile is left to the next call. With the same ``target`` and
    ``checkpoint`` that call goes on where this one ended; the file sink's log
    keeps every page exactly once. (Spark's own trigger for what is available
    would ask an API once for where to end, and take all in one batch.)
    """
    spark = stream.sparkSession
    target = target or new_folder(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint or f"{target}-checkpoint")
        .trigger(processingTime="0 seconds")
        .start()
    )
    goal = None
    try:
        while query.isActive and query.status["message"] != "Waiting for data to arrive":
            end = _reached(query)
            goal = end.get("total", end.get("items")) if goal is None else goal
            if goal is not None and end["items"] >= goal:
                break
            time.sleep(0.05)
    finally:
        query.stop()
    query.awaitTermination()  # raises what ended the query
    return spark.read.schema(stream.schema).parquet(target)


def _reached(query: StreamingQuery) -> dict:
    """The offset that the last batch came to; empty if there was none, or for sources that count no items."""
    if query.lastProgress is None:
        return {}
    sources = json.loads(query.lastProgress.json)["sources"]
    end = sources[0].get("endOffset") if sources else None
    end = json.loads(end) if isinstance(end, str) else end
    return end if isinstance(end, dict) and "items" in end else {}
