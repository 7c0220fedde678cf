"""Were all pages read, once, and with the promised number of items?

The pages of a dataset are bits: one bitmap for each block of 32,768 page
numbers. What is missing and what is too much are read from the bits, so no
plan of all pages is ever made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.constants import PAGE_SIZE
from pagedframes.functions.bodies import whole_record

_ENVELOPE = T.StructType().add("$total", T.LongType()).add("$items", T.ArrayType(T.StringType()))
#: bits of one of Spark's bitmaps
_BITS = 32_768
_NIBBLES = "0123456789ABCDEF"


def _arrived(pages: DataFrame) -> DataFrame:
    """``dataset, page, total, items`` of each body that arrived; a body that is no whole JSON text has neither.

    The array of one keeps Catalyst from parsing the body again where a column
    is used, and from taking a dataset with one name for a constant.
    """
    opened = pages.select(
        "dataset", F.col("page").cast("bigint").alias("page"), whole_record(F.col("body"), _ENVELOPE).alias("e")
    )
    one = F.struct(
        "dataset",
        "page",
        F.col("e.`$total`").alias("total"),
        F.coalesce(F.array_size("e.`$items`"), F.lit(0)).alias("items"),
    )
    return opened.select(F.explode(F.array(one)).alias("one")).select("one.*")


def _blocks(pages: DataFrame, page_size: int) -> DataFrame:
    """One row per dataset: sums, ``promised``, ``planned``, and its blocks ``(block, n, held)`` in order.

    ``held`` is the bitmap of the pages that are there, and null where all are.
    A dataset of a billion pages has 30,000 blocks, most of them without a bitmap.
    """
    each = _arrived(pages).groupBy("dataset", "page").agg(
        F.count("*").alias("copies"), F.max("total").alias("total"), F.max("items").alias("items")
    )
    blocks = each.groupBy("dataset", F.bitmap_bucket_number("page").alias("block")).agg(
        F.count("*").alias("n"),
        F.bitmap_construct_agg(F.bitmap_bit_position("page")).alias("held"),
        F.sum("items").alias("items"),
        F.sum(F.col("copies") - 1).alias("extra_copies"),
        F.max("total").alias("promised"),
    )
    block = F.struct("block", "n", F.when(F.col("n") < _BITS, F.col("held")).alias("held"))
    found = blocks.groupBy("dataset").agg(
        F.max("promised").alias("promised"),
        F.sum("items").alias("items"),
        F.sum("n").alias("pages"),
        F.sum("extra_copies").alias("extra_copies"),
        F.sort_array(F.collect_list(block)).alias("blocks"),
    )
    planned = F.greatest(F.lit(1), F.ceil(F.col("promised") / page_size)).cast("bigint")
    return found.withColumn("planned", F.when(F.col("promised").isNotNull(), planned))


def _is_set(held: Column, bit: Column) -> Column:
    """Bit ``bit`` of a bitmap as hex text, where the lower half of a byte is the second character."""
    place = F.floor(bit / 8).cast("int") * 2 + F.when(bit % 8 < 4, 2).otherwise(1)
    nibble = F.position(F.substring(held, place, F.lit(1)), F.lit(_NIBBLES)) - 1
    return F.getbit(nibble, bit % 4) == 1


def _bits_below(held: Column, end: Column) -> Column:
    """How many of the first ``end`` bits are set: whole bytes at once, the bits of the last one by one."""
    whole = F.floor(end / 8).cast("int")
    rest = F.filter(F.sequence(whole * 8, whole * 8 + 7), lambda k: (k < end) & _is_set(F.hex(held), k))
    return F.bitmap_count(F.substring(held, F.lit(1), whole)) + F.size(rest)


def page_audit(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per dataset: the promised ``total``, the ``items`` and ``pages`` that are there, and what is amiss.

    ``missing_pages`` counts planned pages that are not there and
    ``extra_pages`` those beyond the plan, so the two cannot make up for each
    other; both, and ``complete``, are null if no page tells a total. Items of
    repeated pages count once, and a page that is no whole JSON text holds none.
    A null page number is beyond any plan. The groupings combine before they
    shuffle, so a dataset that owns most of the pages costs no more.
    """
    whole = F.floor(F.col("planned") / _BITS)

    def inside(block: Column) -> Column:
        partly = _bits_below(
            F.coalesce(block["held"], F.unhex(F.lit("FF" * (_BITS // 8)))), (F.col("planned") % _BITS).cast("int")
        )
        return (
            F.when(block["block"].between(1, whole), block["n"])
            .when(block["block"] == whole + 1, partly)
            .otherwise(F.lit(0).cast("bigint"))
        )

    counted = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda n, block: n + inside(block))
    audit = _blocks(pages, page_size).withColumn("there", F.when(F.col("planned").isNotNull(), counted))
    missing = F.col("planned") - F.col("there")
    return audit.select(
        "dataset",
        F.col("promised").alias("total"),
        "items",
        "pages",
        missing.alias("missing_pages"),
        (F.col("pages") - F.col("there")).alias("extra_pages"),
        "extra_copies",
        ((F.col("items") == F.col("promised")) & (missing == 0)).alias("complete"),
    )


def missing_pages(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The planned pages ``(dataset, page)`` that are not there; none of a dataset that tells no total.

    Blocks without a gap are left out before blocks are dealt over the cluster,
    and only the gaps of the others become rows.
    """
    last = F.ceil(F.col("planned") / _BITS)
    numbers = F.sequence(F.lit(1).cast("bigint"), last)
    absent = F.array_except(numbers, F.transform("blocks", lambda b: b["block"]))
    gaps = F.transform(absent, lambda k: F.struct(k.alias("block"), F.lit("").alias("held")))
    held = F.filter("blocks", lambda b: b["block"].between(1, last) & b["held"].isNotNull())
    some = F.transform(held, lambda b: F.struct(b["block"].alias("block"), F.hex(b["held"]).alias("held")))
    blocks = _blocks(pages, page_size).select("dataset", "planned", F.explode(F.concat(some, gaps)).alias("b"))
    dealt = blocks.select("dataset", "planned", "b.*").repartition("dataset", "block")
    start = (F.col("block") - 1) * _BITS
    bits = F.sequence(F.lit(0), (F.least(F.lit(_BITS).cast("bigint"), F.col("planned") - start) - 1).cast("int"))
    unset = F.filter(bits, lambda k: F.when(F.col("held") == "", True).otherwise(~_is_set(F.col("held"), k)))
    return dealt.select("dataset", F.explode(F.transform(unset, lambda k: start + k + 1)).alias("page"))


def repeated_pages(pages: DataFrame) -> DataFrame:
    """Pages ``(dataset, page, copies)`` that arrived more than once."""
    counted = pages.groupBy("dataset", "page").agg(F.count("*").alias("copies"))
    return counted.filter("copies > 1")
