"""Exact histogram of encoded lengths, and what it says of every context limit."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut
from pagedframes.llm.tokens import Encoder

#: lengths that are summed together before the sums of blocks are
BLOCK = 1024


def _lengths(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        sizes = [len(encoder.packed(text)) // encoder.dtype.itemsize for text in batch["text"].to_pylist()]
        length, n = np.unique(np.array(sizes, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(n.astype(np.int64))], names=["length", "n"])


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``length, documents``: how many rows of ``docs`` have as many ids. A null or empty text has none, length 0.

    Every row counts, repeated ones and those without ``doc_id`` too; columns beside ``text`` are not read.
    """
    counted = docs.select("text").mapInArrow(partial(_lengths, path=tokenizer), "length bigint, n bigint")
    return counted.groupBy("length").agg(F.sum("n").alias("documents"))


def limits(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, taken as context limit: counts, quantile and tokens under and over it.

    ``documents`` have that length, ``longer_documents`` more; ``quantile`` is
    the part of documents up to it, ``tokens`` are in documents up to it, and
    ``truncated_tokens`` remain if longer ones are cut to it. Suffix sums run
    within blocks of lengths, then over blocks, so no task holds all lengths.
    An empty histogram gives no rows.
    """
    rows = cut(histogram.withColumn("block", F.expr(f"length div {BLOCK}")), "lengths")
    amount = F.col("length") * F.col("documents")
    sums = rows.groupBy("block").agg(F.sum("documents").alias("d"), F.sum(amount).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0)
    blocks = sums.select(
        "block",
        F.coalesce(F.sum("d").over(later), none).alias("d_after"),
        F.coalesce(F.sum("t").over(later), none).alias("t_after"),
        F.sum("d").over(every).alias("d_all"),
        F.sum("t").over(every).alias("t_all"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.coalesce(F.sum("documents").over(inside), none) + F.col("d_after")
    over = F.coalesce(F.sum(amount).over(inside), none) + F.col("t_after")
    held = rows.join(blocks, "block").withColumns({"longer": longer, "over": over})
    return held.select(
        "length",
        "documents",
        F.col("longer").alias("longer_documents"),
        ((F.col("d_all") - F.col("longer")) / F.col("d_all")).alias("quantile"),
        (F.col("t_all") - F.col("over")).alias("tokens"),
        (F.col("t_all") - F.col("over") + F.col("longer") * F.col("length")).alias("truncated_tokens"),
        F.col("t_all").alias("all_tokens"),
    )


def at_limits(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """``limit, longer_documents, truncated_tokens`` for any ``limit`` of ``wanted``, from :func:`limits`.

    Each limit looks at the greatest length up to it; documents longer than that go up to the limit. That length is
    in the block of the limit, or the last one of the blocks before, so no task holds all lengths or limits.
    """
    known = table.select(
        F.col("length").alias("at"), F.lit(0).alias("kind"), F.struct("length", "longer_documents", "truncated_tokens").alias("row")
    )
    known = known.withColumn("block", F.expr(f"at div {BLOCK}"))
    total = table.agg(F.sum("documents").alias("d"))
    every = wanted.select(F.col("limit").cast("bigint").alias("limit"))
    asked = every.distinct().select(F.col("limit").alias("at"), F.lit(1).alias("kind"))
    none = F.lit(None).cast(known.schema["row"].dataType)
    rows = known.unionByName(asked.withColumn("row", none).withColumn("block", F.expr(f"at div {BLOCK}")))
    rows = cut(rows, "asked-limits")
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(F.col("block").alias("of")).agg(F.max("row").alias("row"))
    blocks = blocks.select("of", F.last("row", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("inside", F.last("row", ignorenulls=True).over(inside)).filter("kind = 1")
    seen = seen.join(blocks, F.col("block").eqNullSafe(F.col("of"))).withColumn("seen", F.coalesce("inside", "carried"))
    longer = F.coalesce("seen.longer_documents", "d", F.lit(0))
    kept = F.coalesce("seen.truncated_tokens", F.lit(0)) + longer * (F.col("at") - F.coalesce("seen.length", F.lit(0)))
    result = seen.join(total, F.lit(True), "left").select("at", longer.alias("longer_documents"), kept.alias("truncated_tokens"))
    return every.join(result, F.col("limit").eqNullSafe(F.col("at"))).drop("at")


def quantile(table: DataFrame, q: float) -> DataFrame:
    """``length``: the least length that at least the part ``q`` of documents does not exceed."""
    return table.filter(F.col("quantile") >= q).agg(F.min("length").alias("length"))
