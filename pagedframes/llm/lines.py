"""Line dedup: lines that several documents hold stay in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedframes.llm.common import SPACES, ascii_lower


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` per row of ``docs`` (``doc_id, text``).

    Keys of at least ``min_chars`` code points in at least ``min_docs``
    documents lose all their lines but those in the largest ``doc_id``. Other
    lines stay in their order, joined by line ends. A null or empty text is
    one empty line. Rows that share a ``doc_id`` count as one document and
    keep or lose lines alike; a null ``doc_id`` is one document too, smaller
    than any other. Other columns are not read.

    Only hashes (128 bits), ids and positions of lines are shuffled for the
    counting; a document's text moves once, to meet the positions it loses.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")
    exploded = docs.select("doc_id", mark, F.posexplode(_lines("text")).alias("pos", "line"))
    keyed = exploded.select("doc_id", "mark", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.filter(F.length("key") >= min_chars)
    hashed = keyed.select("doc_id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    held = hashed.select("h1", "h2", "doc_id").distinct()
    common = held.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    common = common.filter(F.col("n") >= min_docs).drop("n")
    lost = hashed.join(common, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("lost"))
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("mark").alias("lost_mark"), "lost")
    whole = docs.select("doc_id", mark, _lines("text").alias("lines"))
    met = whole["doc_id"].eqNullSafe(lost["lost_id"]) & (whole["mark"] == lost["lost_mark"])
    joined = whole.join(lost, met, "left").select("doc_id", "lines", "lost")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stays = F.transform(F.array_except(every, F.col("lost")), lambda k: F.get(F.col("lines"), k))
    kept = F.array_join(F.when(F.col("lost").isNull(), F.col("lines")).otherwise(stays), "\n")
    dropped = F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost"))
    return joined.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        dropped.cast("bigint").alias("n_dropped"),
        kept.alias("kept_text"),
    )
