"""A Merkle manifest of a dataset: trees over the rows of each part, and one tree over the parts.

A level of a tree lies in aligned blocks, each level of a block as one string
of hex digests. Fixed-width substrings of it are hashed to the level above,
and the substrings that flank a node within its run are its siblings. The
roots of the blocks are the nodes of the next round, so a block never holds
more than ``ARITY ** HEIGHT`` nodes, however many rows a part has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut

#: nodes that are hashed to one
ARITY = 2
#: levels of a block
HEIGHT = 10
#: characters of a digest
WIDTH = 64

_PATH = "array<struct<left: binary, right: binary>>"


def digest(text: Column) -> Column:
    """H: lowercase hex SHA-256."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the bytes of ``value`` as text, their number before a colon."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def _levels(first: Column, height: Column, arity: int) -> Column:
    """The levels of a block from ``first`` (the digests of its nodes as one binary) up, ``height`` of them above it."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (arity * WIDTH)).cast("int") - 1)
        return F.array_join(
            F.transform(runs, lambda k: F.sha2(F.substring(level, k * (arity * WIDTH) + 1, F.lit(arity * WIDTH)), 256)), ""
        ).cast("binary")

    steps = F.filter(F.sequence(F.lit(0), height), lambda k: k > 0)
    # the last level goes through an array, so that each step takes it out once
    return F.aggregate(
        steps,
        F.array(first),
        lambda held, _: F.concat(held, F.transform(F.array(F.element_at(held, -1)), above)),
    )


def _siblings(levels: Column, at: Column, arity: int) -> Column:
    """What flanks node ``at`` of a block within its run, level by level below the block's root."""

    def flanks(level: Column, k: Column) -> Column:
        node = F.floor(at / F.pow(F.lit(arity), k)).cast("int")
        run = node - node % arity
        after = F.greatest(F.lit(0), F.lit(arity) - 1 - node % arity) * WIDTH
        return F.struct(
            F.substring(level, run * WIDTH + 1, (node - run) * WIDTH).alias("left"),
            F.substring(level, (node + 1) * WIDTH + 1, after).alias("right"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks).cast(_PATH)


def _fold(leaf: Column, path: Column) -> Column:
    """The digest at the end of ``path``, starting from ``leaf``."""
    return F.aggregate(
        path,
        leaf.cast("binary"),
        lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]), 256).cast("binary"),
    ).cast("string")


def _proof(path: Column) -> Column:
    """All siblings of ``path`` as one string, from left to right within a run, runs in their order."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"]).cast("string")), "")


def numbered(rows: DataFrame, part: str, order: list[Column], label: str) -> DataFrame:
    """``rows`` (written) with ``at``, the place of a row within its ``part`` by ``order``, from 0 on.

    Rows are dealt by ranges of (part, order), so a part that owns most rows is
    many tasks; a last key of the order that tells equal rows apart lets even
    those be cut. Places are counted within a range and shifted by what earlier
    ranges hold of the part, one number per range and part.
    """
    dealt = rows.repartitionByRange(F.col(part), *order).withColumn("_range", F.spark_partition_id())
    held = cut(dealt, label)
    counts = held.groupBy(part, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(part, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy(part, "_range").orderBy(*order))
    placed = held.withColumn("_local", local).join(shifts, [part, "_range"])
    return placed.withColumn("at", F.col("_local") - 1 + F.col("_shift")).drop("_local", "_shift", "_range")


@dataclass(frozen=True)
class Rounds:
    """The rounds of the trees over nodes of parts, all written tables.

    ``blocks[k]``: ``part, block, levels, up``, whose ``up`` tells whether a further round follows for that part;
    ``roots``: ``part, root``. A part of one node is its own root, in no levels.
    """

    blocks: list[DataFrame]
    roots: DataFrame


def build(nodes: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> Rounds:
    """Trees over ``nodes`` (``part, at, node``; places from 0 on without a gap)."""
    span, rounds = arity**height, []
    roots = None
    while True:
        block = F.floor(F.col("at") / span).cast("bigint")
        held = nodes.groupBy("part", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("at", "node"))).alias("held"))
        first = F.array_join(F.transform("held", lambda x: x["node"]), "").cast("binary")
        held = held.select("part", "block", F.size("held").alias("n"), first.alias("first"))
        # parts of one block end with their root; in others every block has the full height
        many = held.filter("block > 0").select("part").distinct().withColumn("up", F.lit(True))
        held = held.join(many, "part", "left").withColumn("up", F.coalesce("up", F.lit(False)))
        own = F.expr(f"""aggregate(sequence(1, {height}), 0, (top, k) ->
            CASE WHEN power({arity}, k - 1) < n THEN k ELSE top END)""")
        levels = _levels(F.col("first"), F.when(F.col("up"), height).otherwise(own).cast("int"), arity)
        blocks = cut(held.select("part", "block", "up", levels.alias("levels")), "merkle-blocks")
        rounds.append(blocks)
        top = F.element_at("levels", -1).cast("string")
        done = blocks.filter("not up").select("part", top.alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        nodes = blocks.filter("up").select("part", F.col("block").alias("at"), top.alias("node"))
        if nodes.isEmpty():
            return Rounds(rounds, roots)


def paths(tree: Rounds, upper: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """``part, block, levels, path`` of the lowest blocks: ``path`` leads from the block's root on.

    ``upper`` (``part, path``) is what follows after the root of a part.
    """
    span = arity**height
    lower = None
    for blocks in reversed(tree.blocks):
        last = blocks.filter("not up").join(upper, "part")
        if lower is None:
            found = last
        else:
            # the blocks above, node by node: a node is the root of a block below
            last_node = (F.octet_length(F.col("levels")[0]) / WIDTH - 1).cast("int")
            nodes = F.transform(
                F.sequence(F.lit(0), last_node),
                lambda k: F.struct(
                    (F.col("block") * span + k).alias("block"),
                    F.concat(_siblings(F.col("levels"), k, arity), F.col("path")).alias("path"),
                ),
            )
            nodes = lower.select("part", F.explode(nodes).alias("node")).select("part", "node.*")
            found = last.unionByName(blocks.filter("up").join(nodes, ["part", "block"]))
        lower = found.select("part", "block", "levels", "path")
    return lower


def manifest(docs: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified`` for every row of ``docs``.

    A leaf is H of ``doc_id, source, lang, n_chars, text``. The leaves of a
    ``lang`` ascend by ``doc_id`` (null first; rows that share an id by their
    leaf, so rows that repeat stand side by side, each with its own proof).
    Runs of ``arity`` nodes become their H until one is left, the subroot;
    subroots, null first and then by the bytes of ``lang``, likewise give the
    root. ``proof`` holds the siblings as one string; ``folded_root`` is folded
    from them and from the leaf as it is after tampering: of ids whose CRC-32
    can be divided by 7, ``n_chars`` is one more (null stays, and so does the
    leaf). A null and an empty ``lang`` are two parts. No rows, no rows. Texts
    are hashed whole, once, and then left behind; other columns are not read.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    held = {c: F.col(c) for c in columns}
    tampered = {**held, "n_chars": held["n_chars"].cast("decimal(20,0)") + 1}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(hit & F.col("n_chars").isNotNull(), row_digest(*tampered.values()))
    leaves = docs.select(
        "doc_id",
        # parts in their order: null, then the others by bytes
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("part"),
        row_digest(*held.values()).alias("leaf"),
        changed.alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = cut(leaves, "merkle-leaves")
    placed = cut(
        numbered(leaves, "part", [F.asc_nulls_first("doc_id"), F.col("leaf"), F.col("row")], "merkle-sorted"), "merkle-placed"
    )
    trees = build(placed.select("part", "at", F.col("leaf").alias("node")), arity, height)
    subroots = cut(trees.roots.withColumnRenamed("root", "subroot"), "merkle-subroots")
    ordered = numbered(subroots.withColumn("all", F.lit(0)), "all", [F.col("part")], "merkle-parts")
    ordered = cut(ordered, "merkle-parts-placed")
    top = build(ordered.select(F.lit("").alias("part"), "at", F.col("subroot").alias("node")), arity, height)
    nothing = top.roots.select("part", F.col("root"), F.array().cast(_PATH).alias("path"))
    span = arity**height
    over = paths(top, nothing.drop("root"), arity, height).select("block", "levels", "path")
    own = ordered.select(F.col("part"), "subroot", "at", F.floor(F.col("at") / span).cast("bigint").alias("block"))
    upper = own.join(over, "block").select(
        "part",
        "subroot",
        F.concat(_siblings(F.col("levels"), (F.col("at") % span).cast("int"), arity), "path").alias("path"),
    )
    upper = cut(upper, "merkle-upper")
    lower = paths(trees, upper.select("part", "path"), arity, height)
    # one root for all: the few bytes are the result of the trees, whatever the input's size
    found = top.roots.select("root").first()
    root = F.lit(found[0] if found else None).cast("string")
    # the documents of a block meet its levels in one row, and leave it with their proofs
    inside = placed.groupBy("part", F.floor(F.col("at") / span).cast("bigint").alias("block")).agg(
        F.collect_list(F.struct((F.col("at") % span).cast("int").alias("k"), "doc_id", "leaf", "changed")).alias("docs")
    )
    met = inside.join(lower, ["part", "block"]).join(upper.select("part", "subroot"), "part")
    proven = F.transform(
        F.transform(
            "docs",
            lambda d: F.struct(
                d["doc_id"].alias("doc_id"),
                d["leaf"].alias("leaf"),
                F.coalesce(d["changed"], d["leaf"]).alias("start"),
                F.concat(_siblings(F.col("levels"), d["k"], arity), F.col("path")).alias("path"),
            ),
        ),
        lambda d: F.struct(
            d["doc_id"].alias("doc_id"),
            d["leaf"].alias("leaf"),
            _proof(d["path"]).alias("proof"),
            _fold(d["start"], d["path"]).alias("folded_root"),
        ),
    )
    result = met.select("subroot", F.explode(proven).alias("doc")).select("doc.*", "subroot", root.alias("root"))
    return result.select(
        "doc_id", "leaf", "subroot", "root", "proof", digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        F.col("folded_root").eqNullSafe(F.col("root")).alias("verified"),
    )
