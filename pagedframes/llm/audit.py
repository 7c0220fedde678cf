"""Filter interaction audit: what each of several filters removes, in every order in which they may run.

For each part and range of row ids, each filter has its sorted posting list of
the ids that fail it. Unions of lists, by k-way merges that gallop over runs,
and differences from them say what a filter finds left over after any set of
earlier ones. Sizes are summed over ranges; orders are read from sets, since
what a filter removes depends on which filters ran before it, not on how.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import partial
from heapq import heapify, heappop, heapreplace
from itertools import permutations
from math import factorial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut

FILTERS = "ABCDE"
#: rows of a range
RANGE = 1 << 13
#: the labels that good and toxic documents carry
LABELS = ("good", "toxic")

_UPPER = bytes(range(65, 91))
_MARKS = re.compile(rb"[#$%&*|]")

# --- posting lists --------------------------------------------------------------


def gallop(ids: Sequence[int], value: int, at: int) -> int:
    """The first place from ``at`` on whose id is not below ``value``: steps double, then the last is halved."""
    step, end = 1, len(ids)
    while at + step < end and ids[at + step] < value:
        step *= 2
    return bisect_left(ids, value, at + step // 2 if step > 1 else at, min(at + step + 1, end))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """The ids of all ``lists`` (each ascending, without repeats), merged run by run.

    The list with the least id gives the whole run that lies below the next
    list's head, which galloping finds.
    """
    heads = [(ids[0], k, 0) for k, ids in enumerate(lists) if len(ids)]
    heapify(heads)
    merged: list[int] = []
    while len(heads) > 1:
        first, k, at = heads[0]
        ids = lists[k]
        if merged and merged[-1] == first:
            at += 1
        other = heads[1][0] if len(heads) == 2 else min(heads[1][0], heads[2][0])
        end = gallop(ids, other, at) if at < len(ids) else at
        merged += ids[at:end]
        if end == len(ids):
            heappop(heads)
        elif end == at and ids[at] == other:
            # the same id heads two lists: taken once, here
            merged.append(other)
            if at + 1 < len(ids):
                heapreplace(heads, (ids[at + 1], k, at + 1))
            else:
                heappop(heads)
        else:
            heapreplace(heads, (ids[end], k, end))
    if heads:
        first, k, at = heads[0]
        merged += lists[k][at + (bool(merged) and merged[-1] == first) :]
    return merged


def difference(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """Those of ``ids`` that ``gone`` (both ascending) does not hold; runs between ids of ``gone`` are taken whole."""
    left: list[int] = []
    at = place = 0
    while at < len(ids):
        place = gallop(gone, ids[at], place) if place < len(gone) else place
        if place == len(gone):
            left += ids[at:]
            break
        end = gallop(ids, gone[place], at)
        left += ids[at:end]
        at = end + (end < len(ids) and ids[end] == gone[place])
    return left


def common(ids: Sequence[int], others: Sequence[int]) -> int:
    """How many ids both lists hold."""
    n = at = place = 0
    while at < len(ids) and place < len(others):
        place = gallop(others, ids[at], place)
        if place == len(others):
            break
        at = gallop(ids, others[place], at)
        if at < len(ids) and ids[at] == others[place]:
            n, at, place = n + 1, at + 1, place + 1
    return n


def _sizes(lists: list[list[int]], marked: list[list[int]]) -> Iterator[tuple[int, ...]]:
    """For each filter and set of others (a bit set) that ran earlier: sizes of what is removed by then, here, was
    removed before though failing here too, and of the marked among those removed here."""
    n = len(lists)
    merged = [union([lists[k] for k in range(n) if s >> k & 1]) for s in range(1 << n)]
    for s, gone in enumerate(merged):
        for k in range(n):
            if not s >> k & 1:
                removed = difference(lists[k], gone)
                hit = (common(removed, m) for m in marked)
                yield k, s, len(merged[s | 1 << k]), len(removed), len(lists[k]) - len(removed), *hit


_SIZES = ("filter", "earlier", "gone", "removed", "redundant", "good_lost", "toxic_lost")


def _merge(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            found = list(_sizes([row[f"fails_{f}"] for f in range(n)], [row[m] for m in LABELS]))
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            same = [pa.array([row[c]] * len(found), t) for c, t in (("part", pa.string()), ("docs", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*same, *columns], names=["part", "docs", *_SIZES])


# --- the filters ------------------------------------------------------------------


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, digests = [], []
        for text in batch["text"].to_pylist():
            data = (text or "").encode()
            words = data.split()
            capitals = len(data) - len(data.translate(None, _UPPER))
            rows.append(
                [
                    len(words) < 100,
                    100 * len(set(words)) < 80 * len(words),
                    100 * capitals > 10 * len(text or ""),
                    bool(_MARKS.search(data)),
                ]
            )
            digests.append(xxhash.xxh3_128_digest(data))
        arrays = [batch["doc_id"], batch["part"], pa.array(digests, pa.binary()), pa.array(rows, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "digest", "fails"])


def _looked_up(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``rows`` (``range, ...``) with the columns of ``table`` (one row per ``key``), null where it has none.

    A key may own most rows: each range asks once for each key it holds, so no
    join meets more rows of one key than a range holds, or than there are ranges.
    """
    asked = rows.filter(F.col(key).isNotNull()).select("range", key).distinct()
    return rows.join(asked.join(table, key), ["range", key], "left")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, range, part, doc_id, fails (five booleans), good, toxic`` for each row of ``docs``, a written table.

    Texts count as identical by 128 bits of hash, which stand for them in the shuffle.
    """
    texts = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    found = texts.mapInArrow(_features, "doc_id bigint, part string, digest binary, fails array<boolean>")
    found = found.withColumn("id", F.monotonically_increasing_id())
    rows = cut(found.withColumn("range", F.floor(F.col("id") / RANGE)), "audit-features")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = _looked_up(_looked_up(rows, "digest", first.drop("last")), "doc_id", marks)
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return cut(
        rows.select(
            "id",
            "range",
            "part",
            "doc_id",
            F.concat("fails", F.array(copy)).alias("fails"),
            *[F.coalesce(m, F.lit(False)).alias(m) for m in LABELS],
        ),
        "audit-judged",
    )


def posting_lists(judged: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """``part, range, docs`` and sorted lists of ids: ``fails_k`` for each of ``n`` filters, ``good`` and ``toxic``."""

    def listed(condition: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.col("id"))))

    # merging costs far more than the bytes of the lists tell, so tasks are counted by rows
    tasks = max(1, -(-judged.count() // (4 * RANGE)))
    return judged.repartition(tasks, "part", "range").groupBy("part", "range").agg(
        F.count("*").alias("docs"),
        *[listed(F.col("fails")[k]).alias(f"fails_{k}") for k in range(n)],
        *[listed(F.col(m)).alias(m) for m in LABELS],
    )


def interactions(postings: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` from lists."""
    n = len(filters)
    schema = ", ".join(["part string", "docs bigint", *(f"{c} bigint" for c in _SIZES)])
    merged = postings.mapInArrow(partial(_merge, n=n), schema)
    sums = merged.groupBy("part", "filter", "earlier").agg(*[F.sum(c).alias(c) for c in ("docs", *_SIZES[2:])])
    # the n * 2 ** (n - 1) rows of a part and filter; a set of s earlier filters stands for s! * (n - 1 - s)! orders
    whole = Window.partitionBy("part", "filter")
    ways = F.array(*[F.lit(factorial(s) * factorial(n - 1 - s)) for s in range(n)])
    others = F.expr(f"{(1 << n) - 1}L - shiftleft(1L, cast(filter AS int))")
    sums = sums.withColumns(
        {
            "shapley": F.sum(F.col("removed") * ways[F.bit_count("earlier")]).over(whole),
            "unique_fails": F.max(F.when(F.col("earlier") == others, F.col("removed"))).over(whole),
        }
    )
    orders = [
        ("".join(filters[k] for k in order), step + 1, order[step], sum(1 << k for k in order[:step]))
        for order in permutations(range(n))
        for step in range(n)
    ]
    # n * n! rows, whatever the input
    table = postings.sparkSession.createDataFrame(orders, "filter_order string, step int, filter bigint, earlier bigint")
    return sums.join(F.broadcast(table), ["filter", "earlier"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("docs") - F.col("gone")).alias("kept"),
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of five filters on ``docs`` (``doc_id, text, lang``) for every part, order and step, zeros included.

    A part is a ``lang``; null counts as the empty string. Failing means: A,
    under 100 words; B, distinct words under 80 % of all; C, over 10 % of code
    points in A-Z; D, any of ``#$%&*|``; E, a text that a smaller ``doc_id``
    has too. A null text is an empty one, which fails A (and E behind other
    empty ones). Each row counts by itself, rows that repeat too; a null
    ``doc_id`` is not smaller or greater than any, and has no label. An id
    labelled more than once is good or toxic if any of its labels says so.
    No documents, no rows. Other columns are not read.
    """
    return interactions(posting_lists(judge(docs, labels)))
