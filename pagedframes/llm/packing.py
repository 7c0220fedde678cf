"""Mixture-controlled packing of documents into sequences of fixed size.

Each source named in the mixture is a queue of tokens, all others share one.
Windows of many sequences are filled in turn: a queue gets its share of a
window plus the deficit that it carries, so its tokens up to any window differ
from its target by less than one. When a queue runs out, the others share its
part. Since documents may be cut, what a window takes from a queue is a range
of the queue's token positions, and its bounds have a closed form; a task that
knows where its documents lie in their queues places them without any other.
Positions come from one sum per partition and queue.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagedframes.llm.common import cut
from pagedframes.llm.tokens import END, Encoder
from pagedframes.storage import new_folder

LENGTH = 1024
#: sequences of a window
WINDOW = 64

_TOKENS = "part int, doc_id bigint, queue int, before bigint, n bigint, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


# --- the plan ----------------------------------------------------------------


@dataclass(frozen=True)
class Phase:
    """Windows that are filled by the same rule: by weights, or (one window) by fixed amounts."""

    window: int  # the first one
    taken: tuple[int, ...]  # from each queue before it
    bounds: tuple[int, ...] = ()  # running sums of the weights of queues that have tokens left
    amounts: tuple[int, ...] = ()

    def upto(self, k: int, t: int) -> int:
        """Tokens of the first ``k`` queues among the first ``t`` of this phase."""
        return t * self.bounds[k - 1] // self.bounds[-1] if k else 0


@dataclass(frozen=True)
class Plan:
    """Deficit round-robin over queues of ``totals`` tokens with integer ``weights``."""

    totals: tuple[int, ...]
    weights: tuple[int, ...]
    window: int  # tokens
    phases: list[Phase] = field(default_factory=list)

    @staticmethod
    def of(totals: tuple[int, ...], weights: tuple[int, ...], window: int) -> Plan:
        if min(weights) < 0:
            raise ValueError("weights must not be negative")
        plan = Plan(totals, weights, window)
        taken, at = [0] * len(totals), 0
        while any(t < n for t, n in zip(taken, totals, strict=True)):
            left = [n - t for t, n in zip(taken, totals, strict=True)]
            live = [w if n else 0 for w, n in zip(weights, left, strict=True)]
            if not any(live):  # only queues without a share are left
                live = [int(n > 0) for n in left]
            phase = Phase(at, tuple(taken), tuple(int(b) for b in np.cumsum(live)))
            full = plan._full_windows(phase, left, live)
            if full:
                plan.phases.append(phase)
                taken = [t + plan._of(phase, k, full) for k, t in enumerate(taken)]
                left = [n - t for t, n in zip(taken, totals, strict=True)]
                at += full
            if any(left):  # a window in which some queue runs out: the others fill it up
                amounts = plan._last(left, live)
                plan.phases.append(Phase(at, tuple(taken), (), tuple(amounts)))
                taken = [t + a for t, a in zip(taken, amounts, strict=True)]
                at += 1
        return plan

    def _of(self, phase: Phase, k: int, windows: int) -> int:
        t = windows * self.window
        return phase.upto(k + 1, t) - phase.upto(k, t)

    def _full_windows(self, phase: Phase, left: list[int], live: list[int]) -> int:
        """Windows before any queue runs short."""
        most = min(n * phase.bounds[-1] // (w * self.window) + 1 for n, w in zip(left, live, strict=True) if w)
        while most and any(self._of(phase, k, most) > n for k, n in enumerate(left)):
            most -= 1
        return most

    def _last(self, left: list[int], live: list[int]) -> list[int]:
        amounts, room, live = [0] * len(left), self.window, list(live)
        while room and any(n > a for n, a in zip(left, amounts, strict=True)):
            open_ = [k for k, n in enumerate(left) if n > amounts[k]]
            weight = {k: live[k] for k in open_ if live[k]} or dict.fromkeys(open_, 1)
            whole, given = sum(weight.values()), 0
            for k, w in weight.items():
                share = min(room * w // whole, left[k] - amounts[k])
                amounts[k] += share
                given += share
            if not given:  # less than a token each: one to the first
                amounts[next(iter(weight))] += 1
                given = 1
            room -= given
        return amounts

    def pieces(self, queue: int, start: int, stop: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """``position in the queue, size, sequence, offset`` for tokens ``start`` to ``stop`` of a queue."""
        bases = [p.taken[queue] for p in self.phases]
        while start < stop:
            phase = self.phases[i := bisect_right(bases, start) - 1]
            y = start - bases[i]
            if phase.amounts:
                window, first, inside = phase.window, sum(phase.amounts[:queue]), y
                end = phase.amounts[queue]
            else:
                w = phase.bounds[queue] - (phase.bounds[queue - 1] if queue else 0)
                j = max(0, (y - 1) * phase.bounds[-1] // (w * self.window) - 1)
                while self._of(phase, queue, j + 1) <= y:
                    j += 1
                low, end = self._of(phase, queue, j), self._of(phase, queue, j + 1)
                t = j * self.window
                window, inside = phase.window + j, y - low
                first = phase.upto(queue, t + self.window) - phase.upto(queue, t)
            limit = min(stop, bases[i] + end, bases[i + 1] if i + 1 < len(bases) else stop)
            place = window * self.window + first + inside
            while start < limit:
                size = min(limit - start, length - place % length)
                yield start, size, place // length, place % length
                start, place = start + size, place + size


# --- the jobs ------------------------------------------------------------------


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, queues: dict[str, int]) -> Iterator[pa.RecordBatch]:
    encoder, part, rest = Encoder(path), TaskContext.get().partitionId(), len(queues)
    end = encoder.dtype.type(END).tobytes()
    before = [0] * (rest + 1)
    for batch in batches:
        rows = [[], [], [], []]
        for source, text in zip(batch["source"].to_pylist(), batch["text"].to_pylist(), strict=True):
            queue, ids = queues.get(source, rest), encoder.packed(text) + end
            n = len(ids) // encoder.dtype.itemsize
            for column, value in zip(rows, (queue, before[queue], n, ids), strict=True):
                column.append(value)
            before[queue] += n
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(batch), pa.int32()),
                batch["doc_id"].cast(pa.int64()),
                pa.array(rows[0], pa.int32()),
                *(pa.array(r, pa.int64()) for r in rows[1:3]),
                pa.array(rows[3], pa.binary()),
            ],
            names=["part", "doc_id", "queue", "before", "n", "ids"],
        )


def _place(batches: Iterator[pa.RecordBatch], plan: Plan, length: int, width: int, ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        columns = [batch[name].to_pylist() for name in ("doc_id", "queue", "at", "n")]
        for doc, queue, at, n, packed in zip(*columns, batch["ids"], strict=True):
            tokens = np.frombuffer(packed.as_buffer(), f"<u{width}").astype("<u4")
            for position, size, sequence, offset in plan.pieces(queue, at, at + n, length):
                held = tokens[position - at : position - at + size]
                row = (doc, position - at, size, zlib.crc32(held), n, sequence, offset, held.tobytes() if ids else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 7 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
        )


#: starts of queues (a row for each task that coded texts, and queue) that go to every task, about 30 MB
FEW_STARTS = 1 << 20


def pack(
    docs: DataFrame,
    tokenizer: str,
    mixture: Mapping[str, int],
    rest: int,
    length: int = LENGTH,
    window: int = WINDOW,
    ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens: where each lies, and its ids (4 bytes each).

    ``mixture`` gives whole-number weights of sources, ``rest`` that of all
    other sources together; null sources are among these. A queue of weight 0
    comes when the others are empty. Each document is its ids by the tokenizer
    file and the end id; a null or empty text is the end id alone. Every token
    lies in one piece; all sequences but the last are full. Rows that repeat,
    or have a null ``doc_id``, are packed like any other. No rows, no pieces.
    Columns beside ``doc_id, text, source`` are not read.
    """
    spark = docs.sparkSession
    if window < 1 or length < 1:
        raise ValueError("length and window must be positive")
    queues = {name: k for k, name in enumerate(mixture)}
    rows = docs.select(F.col("doc_id").cast("bigint"), "source", "text")
    folder = new_folder(spark, "tokens")
    coded = rows.mapInArrow(partial(_tokenise, path=tokenizer, queues=queues), _TOKENS)
    coded.write.option("compression", "zstd").parquet(folder)
    tokens = spark.read.schema(_TOKENS).parquet(folder)
    sums = tokens.groupBy("part", "queue").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", "queue", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    # one row per queue, and there are as many as the mixture names
    found = dict(sums.groupBy("queue").agg(F.sum("held")).collect())
    totals = tuple(found.get(k, 0) for k in range(len(queues) + 1))
    plan = Plan.of(totals, (*mixture.values(), rest), window * length)
    width = Encoder(tokenizer).dtype.itemsize
    base = cut(base, "queue-starts")
    if base.count() <= FEW_STARTS:
        # a few numbers go to the tokens, and no token moves; beyond the bound both sides are dealt by key
        base = F.broadcast(base)
    placed = tokens.join(base, ["part", "queue"]).withColumn("at", F.col("base") + F.col("before"))
    placed = placed.select("doc_id", "queue", "at", "n", "ids")
    return placed.mapInArrow(partial(_place, plan=plan, length=length, width=width, ids=ids), _PIECES)


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = END) -> DataFrame:
    """``sequence_id, used, ids``: whole sequences, padded to ``length`` unless a power of two is used.

    A sequence gathers ``length`` tokens at most.
    """
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    one = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), held.alias("held"))
    joined = F.aggregate("held", F.unhex(F.lit("")), lambda a, h: F.concat(a, h["ids"]))
    filler = F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (length - F.col("used")).cast("int"))
    padded = F.when(F.bit_count("used") == 1, joined).otherwise(F.concat(joined, F.unhex(filler)))
    return one.select("sequence_id", "used", padded.alias("ids"))
