"""Language-model scores of whole texts by a weighted backoff automaton over smoothed n-grams.

The n-grams of the training texts become states. An arc carries the log-probability
of a word after the words of its state; a failure arc leads to the state without
the first of these words and carries the weight of backing off. One walk from
left to right scores a text.

No task holds the whole model. Texts are cut into blocks of a bounded number of
tokens; a block asks for the counts of its own n-grams, which owners of key
ranges add up over all blocks, and builds the part of the automaton that its
texts can reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedframes.llm.common import cut
from pagedframes.llm.shingles import Words

#: words of an n-gram at most
ORDER = 2
#: tokens of a block; a longer text is a block of its own
BLOCK = 250_000
#: requests of one owner of a key range, about
OWNED = 1_000_000

# what stands before and behind a text; no word is blank
_START, _END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" ", b"\n"))
_STEP, _MIX, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def held_out(doc_id: Column) -> Column:
    """Ids whose texts are never learnt: crc32 of the id as text leaves 2 when divided by 7. Not so for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# --- blocks of tokens --------------------------------------------------------------


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, compressed: planes of small numbers are nearly all zero."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_BLOCKS = "block bigint, doc_ids array<bigint>, held_out array<boolean>, sizes array<int>, words binary, tokens binary"


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of the block's own words, each text between its start and its end."""
    memory, made, size = Words(), 0, 0
    rows: list[tuple] = []

    def closed() -> pa.RecordBatch:
        ids, out, texts = zip(*rows, strict=True)
        words, tokens = np.unique(np.concatenate(texts), return_inverse=True)
        number = (TaskContext.get().partitionId() << 32) + made
        values = [number, list(ids), list(out), [len(t) for t in texts], packed(words), packed(tokens.astype(np.uint32))]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "doc_ids", "held_out", "sizes", "words", "tokens"])

    for batch in batches:
        for doc_id, out, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
            tokens = np.concatenate(([_START], memory.of(text), [_END]))
            if rows and size + len(tokens) > block:
                yield closed()
                made, size = made + 1, 0
                rows.clear()
            rows.append((doc_id, out, tokens))
            size += len(tokens)
    if rows:
        yield closed()


@dataclass(frozen=True)
class Block:
    """``place``: position in the text, 0 for its start; ``grams[n - 1]``: hashes of the ``n`` tokens that end at a position."""

    doc_ids: list
    held_out: list
    sizes: np.ndarray
    words: np.ndarray
    tokens: np.ndarray
    place: np.ndarray
    grams: list[np.ndarray]

    @staticmethod
    def of(row: dict, order: int) -> Block:
        sizes = np.array(row["sizes"], np.int64)
        words, tokens = unpacked(row["words"], np.uint64), unpacked(row["tokens"], np.uint32)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grams = [words[tokens]]
        for _ in range(order - 1):
            longer = np.zeros(len(tokens), np.uint64)
            longer[1:] = grams[-1][:-1] * _STEP + grams[0][1:]
            longer ^= longer >> _HALF
            longer *= _MIX
            longer ^= longer >> _HALF
            grams.append(longer)
        return Block(row["doc_ids"], row["held_out"], sizes, words, tokens, place, grams)

    def at(self, n: int) -> np.ndarray:
        """Positions where ``n`` tokens of one text end."""
        return np.flatnonzero(self.place >= n - 1)


# --- counts --------------------------------------------------------------------------


def _requests(batches: Iterator[pa.RecordBatch], order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of a block with their counts in its training texts, cut by leading bits of the hash."""
    for batch in batches:
        for k in range(batch.num_rows):
            block = Block.of(batch.slice(k, 1).to_pylist()[0], order)
            number = batch["block"][k].as_py()
            learnt = np.repeat(~np.array(block.held_out, bool), block.sizes)
            for n in range(1, order + 1):
                at = block.at(n)
                grams, which = np.unique(block.grams[n - 1][at], return_inverse=True)
                counts = np.bincount(which[learnt[at]], minlength=len(grams)).astype(np.uint32)
                owner = grams >> np.uint64(64 - bits) if bits else np.zeros(len(grams), np.uint64)
                cuts = np.concatenate((np.flatnonzero(np.diff(owner, prepend=owner[0] + np.uint64(1))), [len(grams)]))
                pieces = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
                columns = {
                    "n": pa.array([n] * len(pieces), pa.int32()),
                    "owner": pa.array([int(owner[p.start]) for p in pieces], pa.int64()),
                    "block": pa.array([number] * len(pieces), pa.int64()),
                    "grams": pa.array([packed(np.diff(grams[p], prepend=np.uint64(0))) for p in pieces], pa.binary()),
                    "counts": pa.array([packed(counts[p]) for p in pieces], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)


_FACTS = pa.list_(pa.struct([("kind", pa.int32()), ("n", pa.int64()), ("total", pa.int64())]))
#: kinds of facts beside classes of counts (powers of two)
_DISTINCT, _TOKENS = -1, -2


def _owned(table: pa.Table) -> pa.Table:
    """Total counts of a key range for each block that asked, and one row of facts about them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    n = rows[0]["n"]
    asked = [np.cumsum(unpacked(r["grams"], np.uint64), dtype=np.uint64) for r in rows]
    grams, which = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.concatenate([unpacked(r["counts"], np.uint32) for r in rows])
    totals = np.bincount(which, counts, len(grams)).astype(np.int64)
    ends = np.cumsum([len(a) for a in asked])
    answers = [packed(totals[which[e - len(a) : e]].astype(np.uint64)) for a, e in zip(asked, ends, strict=True)]
    there = totals > 0
    facts = [{"kind": _DISTINCT, "n": int(there.sum()), "total": int((totals == 1).sum())}]
    contexts = there
    if n == 1:
        token = there & (grams != _START)
        facts.append({"kind": _TOKENS, "n": int(token.sum()), "total": int(totals[token].sum())})
        contexts = there & (grams != _END)
    held = totals[contexts]
    classes = np.frexp(held)[1] - 1
    for k in np.unique(classes):
        facts.append({"kind": int(k), "n": int((classes == k).sum()), "total": int(held[classes == k].sum())})
    columns = {
        "n": pa.array([n] * (len(rows) + 1), pa.int32()),
        "owner": pa.array([rows[0]["owner"]] * (len(rows) + 1), pa.int64()),
        "block": pa.array([*(r["block"] for r in rows), None], pa.int64()),
        "totals": pa.array([*answers, None], pa.binary()),
        "facts": pa.array([*([None] * len(rows)), facts], _FACTS),
    }
    return pa.Table.from_pydict(columns)


@dataclass(frozen=True)
class Smoothing:
    """``tokens`` and ``distinct`` ones of the training texts, and for each order from 2 on ``scale, power``.

    A context seen ``c`` times stands for ``scale * c ** power`` further tokens
    dealt by the shorter context: the number of different words that are
    expected to follow it. By Heaps' law ``power`` is the share of n-grams seen
    once, and ``scale`` lets the expected numbers add up to the n-grams there are.
    """

    tokens: int
    distinct: int
    expected: tuple[tuple[float, float], ...]

    def further(self, n: int, counts: np.ndarray) -> np.ndarray:
        scale, power = self.expected[n - 2]
        return scale * counts.astype(np.float64) ** power


def smoothing(answers: DataFrame, order: int) -> Smoothing:
    """From facts of all owners: sums for at most 66 kinds and each order come to the driver."""
    facts = answers.filter("block IS NULL").select("n", F.explode("facts").alias("fact"))
    sums = facts.groupBy("n", "fact.kind").agg(F.sum("fact.n").alias("number"), F.sum("fact.total").alias("total")).collect()
    held = {(r["n"], r["kind"]): (r["number"], r["total"]) for r in sums}
    expected = []
    for n in range(2, order + 1):
        distinct, once = held.get((n, _DISTINCT), (0, 0))
        power = once / distinct if distinct else 0.0
        classes = sorted((k, v) for (m, k), v in held.items() if m == n - 1 and k >= 0)
        total = math.fsum(number * (tokens / number) ** power for _, (number, tokens) in classes)
        expected.append((distinct / total if total else 1.0, power))
    distinct, tokens = held.get((1, _TOKENS), (0, 0))
    return Smoothing(tokens, distinct, tuple(expected))


# --- the automaton -------------------------------------------------------------------


@dataclass(frozen=True)
class Automaton:
    """State 0 knows no word before; ``arcs`` finds an arc by ``state * words + word``."""

    words: int
    start: int
    arcs: dict[int, int]
    weight: list[float]
    target: list[int]
    back: list[float]
    fail: list[int]

    def walk(self, tokens: list[int]) -> float:
        """The log10 probability of ``tokens`` after a start."""
        state, total = self.start, 0.0
        words, find, weight, target, back, fail = self.words, self.arcs.get, self.weight, self.target, self.back, self.fail
        for token in tokens:
            arc = find(state * words + token)
            while arc is None:
                total += back[state]
                state = fail[state]
                arc = find(state * words + token)
            total += weight[arc]
            state = target[arc]
        return total


def automaton(block: Block, counts: list[np.ndarray], smooth: Smoothing) -> Automaton:
    """The states and arcs that texts of ``block`` reach; ``counts[n - 1]`` holds the counts of the n-grams at ``block.at(n)``."""
    order, size = len(counts), len(block.tokens)
    count, state = np.zeros((order, size), np.int64), np.zeros((order, size), np.int64)
    back, fail = [np.zeros(1)], [np.zeros(1, np.int64)]
    keys, weights, targets = [], [], []
    known, p = 1, np.zeros(size)
    start = np.flatnonzero(block.place == 0)
    for n in range(1, order + 1):
        at = block.at(n)
        count[n - 1, at] = counts[n - 1]
        _, first, which = np.unique(block.grams[n - 1][at], return_index=True, return_inverse=True)
        seen = at[first]
        here = count[n - 1, seen]
        if n < order:
            # contexts of n words are states; the state without the first word is one already
            numbers = np.where(here > 0, known + np.cumsum(here > 0) - 1, 0)
            state[n - 1, at] = numbers[which]
            context = seen[here > 0]
            further = smooth.further(n + 1, count[n - 1, context])
            back.append(np.log10(further / (count[n - 1, context] + further)))
            fail.append(state[n - 2, context] if n > 1 else np.zeros(len(context), np.int64))
            known += len(context)
        if n == 1:
            arc = seen
            new = (count[0] + 1.0) / (smooth.tokens + smooth.distinct + 1.0)
        else:
            # the context is what ends one token earlier
            arc = seen[here > 0]
            before = np.zeros(size, np.int64)
            before[1:] = count[n - 2, :-1]
            met = (block.place >= n - 1) & (before > 0)
            further = smooth.further(n, np.where(met, before, 1))
            new = np.where(met, (count[n - 1] + further * p) / (before + further), p)
        p = new
        origin = state[n - 2, arc - 1] if n > 1 else np.zeros(len(arc), np.int64)
        # of the longest n-grams the last order - 1 words are the next state
        longest = min(n, order - 1)
        keys.append(origin * len(block.words) + block.tokens[arc])
        weights.append(np.log10(p[arc]))
        targets.append(state[longest - 1, arc] if longest else np.zeros(len(arc), np.int64))
    numbers = np.concatenate(keys)
    return Automaton(
        len(block.words),
        int(state[0, start[0]]) if order > 1 and len(start) else 0,
        dict(zip(numbers.tolist(), range(len(numbers)), strict=True)),
        np.concatenate(weights).tolist(),
        np.concatenate(targets).tolist(),
        np.concatenate(back).tolist(),
        np.concatenate(fail).tolist(),
    )


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def _scored(blocks: pa.Table, answers: pa.Table, order: int, smooth: Smoothing) -> pa.Table:
    """Each text of a block walked through the block's automaton."""
    parts: dict[int, dict[int, bytes]] = {}
    for n, owner, totals in zip(*(answers[c].to_pylist() for c in ("n", "owner", "totals")), strict=True):
        parts.setdefault(n, {})[owner] = totals
    block = Block.of(blocks.to_pylist()[0], order)
    counts = []
    for n in range(1, order + 1):
        _, which = np.unique(block.grams[n - 1][block.at(n)], return_inverse=True)
        held = parts.get(n, {})
        totals = np.concatenate([unpacked(held[k], np.uint64) for k in sorted(held)] or [np.zeros(0, np.uint64)])
        counts.append(totals[which].astype(np.int64))
    machine = automaton(block, counts, smooth)
    base = np.log10((counts[0] + 1.0) / (smooth.tokens + smooth.distinct + 1.0))
    rows, end, tokens = [], 0, block.tokens.tolist()
    for doc_id, out, size in zip(block.doc_ids, block.held_out, block.sizes.tolist(), strict=True):
        inner = slice(end + 1, end + size)
        end += size
        known = int((counts[0][inner] > 0).sum())
        rows.append((doc_id, out, size - 1, known, smooth.tokens, math.fsum(base[inner]), machine.walk(tokens[inner])))
    names = [f.split()[0] for f in _SCORES.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    columns = zip(*rows, strict=True)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def score_texts(docs: DataFrame, order: int = ORDER, block: int = BLOCK, owned: int = OWNED) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs`` (``doc_id, text``).

    Tokens are the words between ASCII white space, A-Z in lower case, and one
    end for each text; a null text is an empty one, whose only token is the end.
    Texts outside ``held_out`` are learnt, rows that repeat each time, and a
    null ``doc_id`` too. ``base_score`` is the text's log10 probability by single
    tokens with one added to each count and one token for all unknown ones;
    ``score`` is that of n-grams up to ``order``, each smoothed by the shorter
    one down to these, so probabilities after any context add up to 1. Without
    training texts both are that of one unknown token, 0. No rows, no rows.
    Words and n-grams count as equal by 64 bits of hash. Other columns are not read.

    A block holds at most ``block`` tokens or one text, and an owner about
    ``owned`` requests, both however large the input is; a frequent n-gram
    is one request of each block.
    """
    chosen = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    blocks = cut(chosen.mapInArrow(partial(_blocks, block=block), _BLOCKS), "lm-blocks")
    tokens = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, n: a + n))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, tokens / owned))))
    requests = blocks.mapInArrow(
        partial(_requests, order=order, bits=bits), "n int, owner bigint, block bigint, grams binary, counts binary"
    )
    answered = requests.groupBy("n", "owner").applyInArrow(
        _owned, "n int, owner bigint, block bigint, totals binary, facts array<struct<kind: int, n: bigint, total: bigint>>"
    )
    answers = cut(answered, "lm-answers")
    found = partial(_scored, order=order, smooth=smoothing(answers, order))
    replies = answers.filter("block IS NOT NULL").drop("facts")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda a, b: found(a, b), _SCORES)
