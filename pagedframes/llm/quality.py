"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are fitted on the driver to a bounded sample of labelled documents
(``SAMPLE`` rows, chosen by a hash of the id). The statistics and the scores
are computed where the documents are, one pass, with all trees flattened into
arrays that numpy walks level by level for a whole batch.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled documents that the trees are fitted to at most
SAMPLE = 12_000
#: score from which a document counts as good
GOOD = 0.7

_MARKS = b"!|#$%&*,.?;:\"'()-_/\\<>{}[]=+@~^`"
_NAMES = [
    *("chars", "words", "lines", "word_length", "longest_word", "distinct_words", "top_word", "repeats", "repeat_run"),
    *("line_length", "distinct_lines", "upper", "digits", "other_bytes", "blanks", "marks", "marked_words", "entropy"),
    *(f"mark_{m:02x}" for m in _MARKS),
]
_LETTER_END = re.compile(rb"[^a-z0-9.,;:?\x80-\xff]$")


def _of(text: str | None) -> list[float]:
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, words = max(len(data), 1), data.lower().split()
    n_words, lines = max(len(words), 1), data.split(b"\n")
    held = Counter(words)
    same = [a == b for a, b in zip(words, words[1:], strict=False)]
    run = longest = 0
    if any(same):
        for s in same:
            run = run + 1 if s else 0
            longest = max(longest, run)
    part = counts[counts > 0] / n
    sizes = sum(map(len, words))
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sizes / n_words,
        np.log1p(max(map(len, held), default=0)),
        len(held) / n_words,
        max(held.values(), default=0) / n_words,
        sum(same) / n_words,
        longest / n_words,
        np.log1p(n / len(lines)),
        len(set(lines)) / len(lines),
        counts[65:91].sum() / n,
        counts[48:58].sum() / n,
        counts[128:].sum() / n,
        counts[[9, 10, 11, 12, 13, 32]].sum() / n,
        (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / n,
        sum(c for w, c in held.items() if _LETTER_END.search(w)) / n_words,
        float(-(part * np.log2(part)).sum()),
        *(counts[list(_MARKS)] / n_words),
    ]


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of statistics for each whole text; a null is an empty text."""
    return np.array([_of(t) for t in texts], np.float64).reshape(len(texts), len(_NAMES))


# --- trees -------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node ``k`` has the children ``2k + 1`` and ``2k + 2``."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # go right if the value is greater
    value: np.ndarray  # trees x leaves

    @property
    def learnt(self) -> bool:
        """Whether there was any label to learn from; if not, all scores are 0.5 and say nothing."""
        return len(self.feature) > 0 or self.base != 0

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.intp)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2, ridge: float = 1.0
) -> Trees:
    """Boosted trees for the log-odds of ``y``. Without rows all scores are 0.5; with one class they tend to it."""
    inner, leaves = 2**depth - 1, 2**depth
    prior = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.intp), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    # bin b holds the values in (edge[b-1], edge[b]]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)])
    total = np.full(len(y), base)
    feature = np.zeros((trees, inner), np.intp)
    limit, value = np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.intp)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            local = node - first
            gain, best, where = np.full(n, 1e-9), np.zeros(n, np.intp), np.full(n, -1)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                slot = local * bins + binned[f]
                sums = [np.bincount(slot, v, n * bins).reshape(n, bins).cumsum(1) for v in (g, h)]
                (gl, hl), (ga, ha) = (s[:, : len(e)] for s in sums), (s[:, -1:] for s in sums)
                gr, hr = ga - gl, ha - hl
                found = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - ga**2 / (ha + ridge)
                found[(hl < 1e-3) | (hr < 1e-3)] = 0
                at = found.argmax(1)
                better = found[np.arange(n), at] > gain
                gain[better], best[better], where[better] = found[np.arange(n), at][better], f, at[better]
            for k in np.flatnonzero(where >= 0):
                feature[t, first + k], limit[t, first + k] = best[k], edges[best[k]][where[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > limit[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        total += value[t, leaf]
    return Trees(base, feature, limit, value)


# --- the jobs ------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Ids whose labels are never learnt: crc32 of the id as text leaves 2 when divided by 4. Not so for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = statistics(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.float64())), batch["good"]], names=["x", "good"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Trees:
    """Trees for ``labels.quality`` from at most ``sample`` labelled documents outside the held-out ids.

    An id labelled both ways counts as 0. Labels without id, quality or
    document are not used. Which ids the sample takes depends on their hash alone.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("good"))
    # only labels of documents that are there, before the sample is taken
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` pairs of 16 bytes
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "good")
    held = texts.mapInArrow(_statistics, "x array<double>, good double").toPandas()
    x = np.array(held["x"].to_list(), np.float64).reshape(len(held), len(_NAMES))
    order = np.lexsort([*x.T, held["good"]])  # the same sums in whatever order the rows came
    return fit(x[order], held["good"].to_numpy()[order], **options)


def _scores(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = pa.array(trees.score(statistics(batch["text"].to_pylist())))
        names = [*batch.schema.names, "score"]
        yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=names)


def score(docs: DataFrame, trees: Trees, good: float = GOOD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``good`` on) for every row, by its whole text.

    A null or empty text is scored like any other, by statistics that are all
    zero. Only ``text`` is looked at; columns of ``docs`` named ``score`` or
    ``predicted`` give way.
    """
    rows = docs.drop("score", "predicted")
    schema = rows.select("*", F.lit(0.0).alias("score")).schema
    scored = rows.mapInArrow(partial(_scores, trees=trees), schema)
    return scored.withColumn("predicted", (F.col("score") >= good).cast("int"))
