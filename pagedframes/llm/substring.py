"""Substring dedup: fuzzy passages that documents share, by collinear chaining.

Each document is a row of seeds (minimizers: the k-word runs with the smallest
hash of every window). A seed that several documents hold is matched with its
first holder, or by the first holder with the last, so a passage in very many
documents costs each of them one match per seed. Matches of two documents on
one diagonal make segments; segments are chained in order with a gap cost
through a Fenwick tree of best scores; insides, gaps and ends of a chain are
aligned word by word, and its longest parts that agree well enough are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut
from pagedframes.llm.shingles import Words, rolled

#: words of a seed, and seeds of a window: a run of SEED + WINDOW - 1 equal words always has a common seed
SEED, WINDOW = 6, 16
#: words of a passage at least
PASSAGE = 50
#: words between two seeds of a chain at most, and cost of a word skipped
MAX_GAP, GAP_COST = 32, 0.1
#: words of a chain at least, that may be part of a passage
CHAIN = 12
#: words that an end is followed for, and what a word that differs takes from the score of a word that agrees
REACH, DIFFERS = 24, 2
#: words of a chain that may differ, as a share of all its words
EDITS = 0.2
#: bits of the filter in front of the second reading of texts
FILTER_BITS = 20


# --- one document, or one pair ------------------------------------------------------


def seeds(words: np.ndarray, size: int = SEED, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the minimizers of ``words``; none if there are fewer than ``size``."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = rolled(words, size)
    w = min(window, len(runs))
    at = np.unique(np.lib.stride_tricks.sliding_window_view(runs, w).argmin(1) + np.arange(len(runs) - w + 1))
    return runs[at], at


class BestBefore:
    """Fenwick tree: the best score, and whose it is, among places before one."""

    def __init__(self, n: int):
        self.best, self.owner = [-np.inf] * (n + 1), [-1] * (n + 1)

    def put(self, place: int, score: float, owner: int) -> None:
        place += 1
        while place < len(self.best):
            if score > self.best[place]:
                self.best[place], self.owner[place] = score, owner
            place += place & -place

    def ask(self, place: int) -> tuple[float, int]:
        best, owner = -np.inf, -1
        while place:
            if self.best[place] > best:
                best, owner = self.best[place], self.owner[place]
            place -= place & -place
        return best, owner


def segments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """``x, y, words`` of matches on one diagonal that are at most ``MAX_GAP`` apart."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    new = np.flatnonzero(np.r_[True, (np.diff(x - y) != 0) | (np.diff(x) > MAX_GAP)])
    last = np.r_[new[1:], len(x)] - 1
    return sorted(zip(x[new].tolist(), y[new].tolist(), (x[last] - x[new] + SEED).tolist(), strict=True))


def chains(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Segments in the best collinear chains, each in one, with no gap over ``MAX_GAP``."""
    if len(parts) == 1:
        return [parts]
    places = {y: k for k, y in enumerate(sorted({y + n - SEED for _, y, n in parts} | {y for _, y, _ in parts}))}
    tree, score, before = BestBefore(len(places)), [0.0] * len(parts), [-1] * len(parts)
    events = sorted([(x, 0, k) for k, (x, _, _) in enumerate(parts)] + [(x + n - SEED, 1, k) for k, (x, _, n) in enumerate(parts)])
    for _, ends, k in events:
        x, y, n = parts[k]
        if not ends:
            # a word skipped on either side costs the same, so one sum holds what a predecessor brings
            best, owner = tree.ask(places[y])
            gain = best - GAP_COST * (x + y)
            score[k], before[k] = n + max(gain, 0.0), owner if gain > 0 else -1
        else:
            tree.put(places[y + n - SEED], score[k] + GAP_COST * (x + y + 2 * (n - SEED)), k)
    used, out = [False] * len(parts), []
    for k in sorted(range(len(parts)), key=lambda k: -score[k]):
        chain: list[tuple[int, int, int]] = []
        while k >= 0 and not used[k]:
            used[k] = True
            part = parts[k]
            if chain and (chain[-1][0] - part[0] - part[2] > MAX_GAP or chain[-1][1] - part[1] - part[2] > MAX_GAP):
                out.append(chain[::-1])
                chain = []
            chain.append(part)
            k = before[k]
        if chain:
            out.append(chain[::-1])
    return out


def distance(a: list, b: list) -> int:
    """Edits of words that turn ``a`` into ``b``."""
    row = list(range(len(b) + 1))
    for i, u in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, v in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (u != v))
    return row[-1]


def extension(a: np.ndarray, b: np.ndarray) -> int:
    """Words by which a passage goes on, for the best sum of agreeing less differing words."""
    n = min(len(a), len(b))
    if not n:
        return 0
    total = np.where(a[:n] == b[:n], 1, -DIFFERS).cumsum()
    k = int(total.argmax())
    return k + 1 if total[k] > 0 else 0


def holes(a: np.ndarray, b: np.ndarray, run: int = SEED) -> list[tuple[int, int, int]]:
    """``low, high, edits`` of the stretches, between ``run`` or more equal words, where two texts of one length differ."""
    at = np.flatnonzero(a != b)
    if not len(at):
        return []
    new = np.flatnonzero(np.r_[True, np.diff(at) > run])
    ends = zip(at[new].tolist(), (at[np.r_[new[1:], len(at)] - 1] + 1).tolist(), strict=True)
    return [(u, v, 1 if v - u == 1 else distance(a[u:v].tolist(), b[u:v].tolist())) for u, v in ends]


def agreeing(span: tuple[int, int, int, int], between: list[list[int]], least: int, share: float = EDITS) -> list[tuple[int, ...]]:
    """``start, stop, other_start, other_stop, edits`` of parts of a chain with edits for at most ``share`` of the words.

    ``between`` are the places ``x, to_x, y, to_y, edits`` where the chain
    (from ``start, other_start`` to ``stop, other_stop``) differs; what lies
    between them is equal. The longest part comes first, then the longest on
    either side of it, down to ``least`` words, so no part that agrees is
    left out but for what a longer one takes.
    """
    between = sorted(between)
    x0, y0 = [np.array([s, *(h[k] for h in between)]) for s, k in ((span[0], 1), (span[2], 3))]
    x1, y1 = [np.array([*(h[k] for h in between), s]) for s, k in ((span[1], 0), (span[3], 2))]
    edits = np.r_[0, np.cumsum([h[4] for h in between], dtype=np.int64)]
    out, todo = [], [(0, len(x0))]
    while todo:
        low, high = todo.pop()
        if low >= high or x1[low:high].max() - x0[low:high].min() < least:
            continue
        # pieces i to j agree if share * (x1[j] - x0[i]) is at least edits[j] - edits[i]
        begin, end = share * x0[low:high] - edits[low:high], share * x1[low:high] - edits[low:high]
        beyond = np.maximum.accumulate(end[::-1])  # the best end from each piece on, last piece first
        last = high - 1 - np.searchsorted(beyond, begin - 1e-9)
        last = np.maximum(last, np.arange(low, high))
        i = int((x1[last] - x0[low:high]).argmax())
        i, j = low + i, int(last[i])
        if x1[j] - x0[i] >= least:
            out.append((int(x0[i]), int(x1[j]), int(y0[i]), int(y1[j]), int(edits[j] - edits[i])))
            todo += [(low, i), (j + 1, high)]
    return sorted(out)


# --- the jobs ----------------------------------------------------------------------


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        ids, hashes, at = batch["doc_id"].to_numpy(), [], []
        for text in batch["text"].to_pylist():
            found = seeds(words.of(text))
            hashes.append(found[0].view(np.int64))
            at.append(found[1])
        owners = np.repeat(ids, [len(h) for h in hashes])
        columns = [np.concatenate([*hashes, np.zeros(0, np.int64)]), owners, np.concatenate([*at, np.zeros(0, np.int64)])]
        kinds = [pa.int64(), pa.int64(), pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["seed", "doc_id", "pos"])


_CHAINS = "doc_id bigint, other_id bigint, start int, other_start int, stop int, other_stop int, gaps array<array<int>>, parts array<array<int>>"


def _chains(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Chains of each pair; its matches lie together, but may go on in the next batch."""
    kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 4

    def found(columns: list[np.ndarray]) -> pa.RecordBatch:
        doc, other, x, y = columns
        first = np.flatnonzero(np.r_[len(doc) > 0, (np.diff(doc) != 0) | (np.diff(other) != 0)])
        rows = []
        for a, b in zip(first, np.r_[first[1:], len(doc)][: len(first)], strict=True):
            for chain in chains(segments(x[a:b], y[a:b])):
                (x0, y0, _), (x1, y1, n) = chain[0], chain[-1]
                if x1 + n - x0 < least:
                    continue
                gaps = [
                    [u + m, v - u - m, p + m, q - p - m]
                    for (u, p, m), (v, q, _) in zip(chain, chain[1:], strict=False)
                ]
                # seeds of two diagonals may overlap by some words; such a gap is counted by what it adds
                rows.append((int(doc[a]), int(other[a]), x0, y0, x1 + n, y1 + n, gaps, [list(p) for p in chain]))
        kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.list_(pa.list_(pa.int32()))] * 2
        names = ["doc_id", "other_id", "start", "other_start", "stop", "other_stop", "gaps", "parts"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    for batch in batches:
        columns = [np.concatenate([k, batch[c].to_numpy().astype(np.int64)]) for k, c in zip(kept, ("doc_id", "other_id", "pos", "other_pos"), strict=True)]
        if not len(columns[0]):
            continue
        tail = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        cut_at = len(tail) - int(tail[::-1].argmin()) if not tail.all() else 0
        kept = [c[cut_at:] for c in columns]
        yield found([c[:cut_at] for c in columns])
    yield found(kept)


def _words(batches: Iterator[pa.RecordBatch], filled: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        batch = batch.filter(pa.array(filled[batch["slot"].to_numpy()]))
        held = [words.of(t).astype(np.uint32).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(held, pa.binary())], names=["doc_id", "words"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        more, differ = [], []
        places = (batch[c].to_pylist() for c in ("kind", "low", "to", "other_low", "other_to"))
        for kind, x, to_x, y, to_y, a, b in zip(*places, batch["a"], batch["b"], strict=True):
            a, b = (np.frombuffer(v.as_buffer(), "<u4") for v in (a, b))
            n = 0
            if kind == "gap":
                edits = distance(a.tolist(), b.tolist())
                differ.append([[x, to_x, y, to_y, edits]] if edits else [])
            else:
                if kind == "left":
                    n = extension(a[::-1], b[::-1])
                    x, y, a, b = x + len(a) - n, y + len(b) - n, a[len(a) - n :], b[len(b) - n :]
                elif kind == "right":
                    n = extension(a, b)
                    a, b = a[:n], b[:n]
                differ.append([[x + u, x + v, y + u, y + v, e] for u, v, e in holes(a, b)])
            more.append(n)
        added = [pa.array(more, pa.int32()), pa.array(differ, pa.list_(pa.list_(pa.int32())))]
        yield pa.RecordBatch.from_arrays([batch["chain"], batch["kind"], *added], names=["chain", "kind", "more", "differ"])


def _agreeing(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "stop", "other_id", "other_start", "other_stop", "edits"]
    kinds = [pa.int64(), *[pa.int32()] * 2, pa.int64(), *[pa.int32()] * 2, pa.int64()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            span = (r["start"] - r["left"], r["stop"] + r["right"], r["other_start"] - r["left"], r["other_stop"] + r["right"])
            for x0, x1, y0, y1, edits in agreeing(span, r["differ"], least):
                rows.append((r["doc_id"], x0, x1, r["other_id"], y0, y1, edits))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def _ends(texts: DataFrame) -> DataFrame:
    """``seed, doc_id, pos`` of seeds that several documents hold, with the ``first`` and ``last`` of them."""
    each = texts.mapInArrow(_seeds, "seed bigint, doc_id bigint, pos int")
    held = each.groupBy("seed").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return cut(each.join(held.filter("first < last"), "seed"), "seeds")


def _slices(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, low, n, words``: the words of each wanted range, 4 bytes each."""
    slots = 1 << FILTER_BITS
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("slot")
    filled = np.zeros(slots, bool)  # at most `slots` numbers come to the driver
    filled[wanted.select(slot).distinct().toPandas()["slot"].to_numpy(np.intp)] = True
    held = texts.select("doc_id", "text", slot).mapInArrow(partial(_words, filled=filled), "doc_id bigint, words binary")
    ranges = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("low", "n")).alias("ranges"))
    found = held.join(ranges, "doc_id").select("doc_id", "words", F.explode("ranges").alias("r"))
    part = F.substring("words", F.col("r.low") * 4 + 1, F.col("r.n") * 4)
    # rows that share an id: the first in order of their words speaks for it
    return found.groupBy("doc_id", "r").agg(F.min(part).alias("words")).select("doc_id", "r.low", "r.n", "words")


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, chain: int = CHAIN) -> DataFrame:
    """``doc_id, start, stop, other_id, other_start, other_stop, edits, passage_start, passage_stop``.

    One row for each aligned chain that is part of a repeated passage: words
    ``start`` to ``stop`` of ``doc_id`` are those of ``other_id``, but for
    ``edits``, at most ``EDITS`` of them. A chain that differs more is kept in
    its longest parts that do not. Chains that touch make one passage, which counts from
    ``passage`` words on, so a passage whose parts were first seen in
    different documents is found too. Words are what stands between ASCII
    white space, A-Z in lower case.

    A row names one partner, the first document with those words, or for that
    one the last. A passage has no row if its seeds all go to partners that
    hold less than ``chain`` words of it each. Copies of whole
    documents are passages. Null ids and texts, empty texts and texts of fewer
    words than a passage give no row. Rows that share a ``doc_id`` are one
    document. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").filter("doc_id is not null and text is not null")
    shared = _ends(texts)
    partner = F.when(F.col("doc_id") == F.col("first"), F.col("last")).otherwise(F.col("first"))
    places = shared.filter("doc_id = first or doc_id = last").groupBy("seed", "doc_id").agg(F.min("pos").alias("other_pos"))
    places = places.withColumnRenamed("doc_id", "other_id")
    matches = shared.withColumn("other_id", partner).join(places, ["seed", "other_id"])
    matches = matches.select("doc_id", "other_id", "pos", "other_pos").repartition("doc_id", "other_id")
    matches = matches.sortWithinPartitions("doc_id", "other_id", "pos", "other_pos")
    found = matches.mapInArrow(partial(_chains, least=chain), _CHAINS)
    found = found.withColumn("chain", F.xxhash64("doc_id", "other_id", "start", "other_start"))
    found = cut(found, "chains")

    def area(kind: str, x: Column, n: Column, y: Column, m: Column) -> Column:
        # seeds of two diagonals may overlap: no words between, but the next one starts before the last one ends
        names = ("kind", "low", "n", "other_low", "other_n", "to", "other_to")
        numbers = (x, F.greatest(n, F.lit(0)), y, F.greatest(m, F.lit(0)), x + n, y + m)
        values = (F.lit(kind), *[v.cast("int") for v in numbers])
        return F.struct(*[v.alias(name) for name, v in zip(names, values, strict=True)])

    before = F.least("start", "other_start", F.lit(REACH))
    left = area("left", F.col("start") - before, before, F.col("other_start") - before, before)
    right = area("right", F.col("stop"), F.lit(REACH), F.col("other_stop"), F.lit(REACH))
    middle = F.transform("gaps", lambda g: area("gap", g[0], g[1], g[2], g[3]))
    inside = F.transform("parts", lambda p: area("inside", p[0], p[2], p[1], p[2]))
    areas = found.select("chain", "doc_id", "other_id", F.explode(F.concat(F.array(left, right), middle, inside)).alias("area"))
    areas = areas.select("chain", "doc_id", "other_id", "area.*")
    wanted = areas.select("doc_id", "low", "n").unionByName(
        areas.select(F.col("other_id").alias("doc_id"), F.col("other_low").alias("low"), F.col("other_n").alias("n"))
    )
    slices = cut(_slices(texts, wanted.distinct()), "slices")
    one = slices.withColumnRenamed("words", "a")
    other = slices.select(
        F.col("doc_id").alias("other_id"), F.col("low").alias("other_low"), F.col("n").alias("other_n"), F.col("words").alias("b")
    )
    met = areas.join(one, ["doc_id", "low", "n"]).join(other, ["other_id", "other_low", "other_n"])
    met = met.select("chain", "kind", "low", "to", "other_low", "other_to", "a", "b")
    aligned = met.mapInArrow(_aligned, "chain bigint, kind string, more int, differ array<array<int>>")
    ends = aligned.groupBy("chain").agg(
        F.max(F.when(F.col("kind") == "left", F.col("more"))).alias("left"),
        F.max(F.when(F.col("kind") == "right", F.col("more"))).alias("right"),
        F.flatten(F.collect_list("differ")).alias("differ"),
    )
    full = found.drop("gaps", "parts").join(ends, "chain").mapInArrow(
        partial(_agreeing, least=chain),
        "doc_id bigint, start int, stop int, other_id bigint, other_start int, other_stop int, edits bigint",
    )
    # chains of one document, of which there are no more than it has seeds
    order = Window.partitionBy("doc_id").orderBy("start", "stop", "other_id", "other_start")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    numbered = full.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "run")
    whole = numbered.withColumns({"passage_start": F.min("start").over(run), "passage_stop": F.max("stop").over(run)})
    return whole.filter(F.col("passage_stop") - F.col("passage_start") >= passage).drop("new", "run")
