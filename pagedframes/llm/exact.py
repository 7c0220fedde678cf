"""Exact duplicates by an extendible-hash index in the shared folder.

A directory over leading bits of the hashes of all texts doubles until no
bucket holds more hashes than its capacity; buckets that need fewer bits stay
shallow. Each text then goes to the owner of its bucket, which compares texts
of one hash byte by byte, chains those that differ, and writes the entries of
its range of keys in order. Copies by the very many are combined before they
move. Documents find their entry by hash and digest.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut

#: different hashes of a bucket, whose texts one owner reads
CAPACITY = 1 << 12
#: a hash held by at least one of so many rows has its copies combined before they move
HOT = 1000
#: leading bits of a hash that the directory may use
MAX_DEPTH = 40


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one blank; null as the empty text.

    Single blanks are left alone, since replacing them changes nothing.
    """
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


@dataclass(frozen=True)
class HashIndex:
    """``entries``: ``bucket, key, link, keep_id, group_size, text_sha256``; ``directory``: ``slot, depth, bucket``."""

    entries: DataFrame
    directory: DataFrame
    depth: int


def _slot(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """``slot, depth, bucket`` for distinct ``key`` values, and the directory's own depth.

    Fewer slots than entries over capacity must overflow, so doubling starts
    there; it goes on while a bucket is overfull. A bucket sits at the least
    depth at which it fits, and all its slots name it.
    """
    n = keys.count()
    depth = max(0, math.ceil(math.log2(n / capacity))) if n else 0
    while True:
        counts = keys.groupBy(_slot(F.col("key"), depth).alias("slot")).agg(F.count("*").alias("n"))
        if depth >= MAX_DEPTH or counts.filter(F.col("n") > capacity).isEmpty():
            break
        depth += 1
    levels = F.sequence(F.lit(0), F.lit(depth))
    at = counts.select("slot", "n", F.explode(levels).alias("depth"))
    at = at.withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {depth} - depth)"))
    fits = at.groupBy("depth", "prefix").agg(F.sum("n").alias("held"))
    least = F.min(F.when((F.col("held") <= capacity) | (F.col("depth") == depth), F.struct("depth", "prefix")))
    slots = at.join(fits, ["depth", "prefix"]).groupBy("slot").agg(least.alias("at"))
    bucket = F.concat(F.col("at")["depth"].cast("string"), F.lit("-"), F.col("at")["prefix"].cast("string"))
    return slots.select("slot", F.col("at")["depth"].alias("depth"), bucket.alias("bucket")), depth


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, key: Callable[[Column], Column] = F.xxhash64
) -> HashIndex:
    """Index of the distinct normalised texts of ``docs`` (``doc_id, text``), written to the shared folder.

    Less than ``HOT`` hashes can be held by one of ``HOT`` rows each, so their list is broadcast whatever the input.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("body"))
    texts = texts.select("doc_id", "body", key(F.col("body")).alias("key"))
    keys = cut(texts.groupBy("key").agg(F.count("*").alias("n")), "keys")
    slots, depth = directory(keys.select("key"), capacity)
    slots = cut(slots, "directory")
    total = keys.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(keys.filter((F.col("n") > 1) & (F.col("n") * HOT >= total)).select("key"))
    single = texts.join(hot, "key", "left_anti")
    single = single.select("key", "body", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    combined = texts.join(hot, "key", "left_semi").groupBy("key", "body")
    combined = combined.agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    moved = single.unionByName(combined).withColumn("slot", _slot(F.col("key"), depth))
    owned = moved.join(slots.select("slot", "bucket"), "slot").drop("slot").repartition("bucket")
    # both the comparison and the chains stay in the task of the owner
    equal = owned.groupBy("bucket", "key", "body").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    equal = equal.select("bucket", "key", "keep_id", "group_size", F.sha2("body", 256).alias("text_sha256"))
    chain = Window.partitionBy("bucket", "key").orderBy(F.col("keep_id").asc_nulls_first(), "text_sha256")
    entries = equal.withColumn("link", F.row_number().over(chain))
    return HashIndex(cut(entries.sortWithinPartitions("bucket", "key", "link"), "hash-index"), slots, depth)


def find_copies(
    docs: DataFrame, capacity: int = CAPACITY, key: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """``docs`` with ``keep_id, group_size, text_sha256, kept`` for each row, dropped ones too.

    Of rows whose texts are equal once normalised, that with the smallest
    ``doc_id`` stays. A null text is an empty one. A null ``doc_id`` is never
    the smallest unless all of the group are null, when ``keep_id`` is null;
    rows that share the smallest ``doc_id`` all stay, for no column tells them
    apart. No rows give no rows. Columns of ``docs`` with these names give way.

    Very long texts are hashed, moved and compared whole. Texts whose hashes
    collide are told apart by the index, in which they are links of one chain.
    """
    index = build_index(docs, capacity, key)
    added = ["keep_id", "group_size", "text_sha256"]
    body = normalised(F.col("text"))
    rows = docs.drop(*added, "kept", "_key").withColumns({"_key": key(body), "text_sha256": F.sha2(body, 256)})
    entries = index.entries.select(F.col("key").alias("_key"), *added)
    result = rows.join(entries, ["_key", "text_sha256"])
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).drop("_key")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without later copies, in the columns it has.

    Rows that share both ``doc_id`` and normalised text are one document, of
    which one row stays; only rows of such groups are moved for it.
    """
    found = find_copies(docs.withColumn("_held", F.struct("*"))).filter("kept")
    alone = found.filter("group_size = 1").select("_held")
    groups = found.filter("group_size > 1").groupBy("text_sha256", "group_size")
    first = groups.agg(F.min_by("_held", F.xxhash64("_held")).alias("_held")).select("_held")
    return alone.unionByName(first).select("_held.*")
