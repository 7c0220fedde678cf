"""Benchmark decontamination: passages of documents within an edit distance of a benchmark item.

An item of n words may differ in k = floor(rate * n) words. Cut into k + 1
pieces, one of them must appear as it is. All pieces of a block of items are
found in one pass over a text by an Aho-Corasick automaton, and the
surroundings of a hit are verified by Myers' bit-parallel distance over words.
Blocks are written to the shared folder, from which each task reads them one
after the other; the driver sees none of them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedframes.storage import new_folder

#: part of an item's words that may differ
RATE = 0.2
#: an item with fewer words (a character of `DENSE` is half a word) and fewer characters must make up a whole document
MIN_WORDS, MIN_CHARS = 5, 20
#: characters of items that are searched for at once
BLOCK_CHARS = 1 << 22
#: bytes of documents that a task holds while it goes through the blocks
HELD_BYTES = 1 << 26

_HITS = "doc_id bigint, item_id bigint, start bigint, stop bigint, distance bigint, item_words bigint"
_WORD = re.compile(r"\w+")
#: letters and marks of scripts without blanks: Thai, Lao, Myanmar, Khmer, kana, Bopomofo, Han
DENSE = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ebd\u0ec0-\u0ece\u1000-\u103f\u1050-\u108f\u109a-\u109d\u1780-\u17d3"
    "\u3005-\u3007\u3041-\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
)
_DENSE = re.compile(f"[{DENSE}]")
_DENSE_WORD = re.compile(rf"[{DENSE}]|[^\W{DENSE}]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores in lower case, and single characters of scripts without blanks."""
    text = (text or "").lower()
    return (_DENSE_WORD if not text.isascii() and _DENSE.search(text) else _WORD).findall(text)


def too_short(held: list[str]) -> bool:
    """Whether an item of the words ``held`` says too little to be searched for inside a document."""
    weight = sum(0.5 if len(w) == 1 and _DENSE.match(w) else 1 for w in held)
    return weight < MIN_WORDS and sum(map(len, held)) < MIN_CHARS


def pieces(n: int, errors: int) -> list[tuple[int, int]]:
    """``errors + 1`` nearly equal ranges of ``n`` words."""
    cuts = [n * k // (errors + 1) for k in range(errors + 2)]
    return list(zip(cuts, cuts[1:], strict=False))


def myers(pattern: list[str], text: list[str]) -> list[int]:
    """For each end in ``text``, the least number of edits that turn ``pattern`` into some part ending there."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for k, w in enumerate(pattern):
        masks[w] |= 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, []
    for w in text:
        eq = masks.get(w, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | eq) | down
        plus, minus = down | (full & ~(d | up)), up & d
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(x | plus)) & full, plus & x & full
        out.append(score)
    return out


class Items:
    """Benchmark items ready for search."""

    def __init__(self, items: list[tuple[int | None, str | None]], rate: float):
        import ahocorasick

        self.items, self.errors, self.short = [], [], defaultdict(list)
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            held = words(text)
            if too_short(held):
                if held:
                    self.short[tuple(held)].append(item_id)
                continue
            errors = int(rate * len(held))
            for low, high in pieces(len(held), errors):
                found[" " + " ".join(held[low:high]) + " "].append((len(self.items), low))
            self.items.append((item_id, held))
            self.errors.append(errors)
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if found:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> Iterator[tuple[int | None, int, int, int, int]]:
        """``item_id, start, stop, distance, words of the item`` of passages, in words of ``text``."""
        held = words(text)
        for item_id in self.short.get(tuple(held), ()) if len(held) < 2 * MIN_WORDS else ():
            yield item_id, 0, len(held), 0, len(held)
        if not self.items:
            return
        regions: dict[int, list[list[int]]] = defaultdict(list)
        joined, at, word = " " + " ".join(held) + " ", 0, 0
        for end, (size, owners) in self.automaton.iter(joined):
            start = end - size + 1
            if start < at:  # a shorter piece may end later than a longer one that began before
                word -= joined.count(" ", start, at)
            else:
                word += joined.count(" ", at, start)
            at = start
            for k, low in owners:
                n, errors = len(self.items[k][1]), self.errors[k]
                first, last = max(0, word - low - errors), min(len(held), word - low + n + errors)
                if regions[k] and first <= regions[k][-1][1]:
                    regions[k][-1][0] = min(first, regions[k][-1][0])
                    regions[k][-1][1] = max(last, regions[k][-1][1])
                else:
                    regions[k].append([first, last])
        for k, found in regions.items():
            item_id, pattern = self.items[k]
            for first, last in found:
                yield from ((item_id, first + a, first + b, d, len(pattern)) for a, b, d in self._verify(k, held[first:last]))

    def _verify(self, k: int, text: list[str]) -> Iterator[tuple[int, int, int]]:
        """Passages that do not overlap: in each run of ends within the budget, the first best one."""
        pattern, errors = self.items[k][1], self.errors[k]
        scores, passed, e = myers(pattern, text), 0, 0
        while e < len(scores):
            if scores[e] > errors:
                e += 1
                continue
            last = e
            while last + 1 < len(scores) and scores[last + 1] <= errors:
                last += 1
            best = min(range(e, last + 1), key=scores.__getitem__)
            # the start: the same search backwards from the end that was found
            low = max(passed, best + 1 - len(pattern) - errors)
            back = myers(pattern[::-1], text[low : best + 1][::-1])
            if back and min(back) <= errors:
                start = best - min(range(len(back)), key=back.__getitem__)
                yield start, best + 1, min(back)
                passed = best + 1
            e = last + 1


@lru_cache(maxsize=1)
def _read_block(folder: str, block: int, rate: float) -> Items:
    """One block ready for search; a worker keeps the last one, so a benchmark of one block is built once."""
    files, path = fs.FileSystem.from_uri(f"{folder}/block={block}")
    if files.get_file_info(path).type == fs.FileType.NotFound:  # no item has this number
        return Items([], rate)
    held = pq.read_table(path, filesystem=files, columns=["item_id", "text"], partitioning=None)
    rows = zip(held["item_id"].to_pylist(), held["text"].to_pylist(), strict=True)
    return Items(sorted(rows, key=str), rate)


@dataclass(frozen=True)
class Blocks:
    """The distinct items of a benchmark, written as ``block=N`` folders of about ``block_chars`` characters."""

    folder: str
    count: int
    rate: float

    def __iter__(self) -> Iterator[Items]:
        return (_read_block(self.folder, block, self.rate) for block in range(self.count))


def _write_blocks(benchmark: DataFrame, rate: float, block_chars: int) -> Blocks:
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = -(-size // block_chars) or 1
    spark = benchmark.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(new_folder(spark, "benchmark-blocks"))
    # tasks open files by themselves, so the file system is named in full
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    dealt.repartition("block").write.partitionBy("block").parquet(folder)
    return Blocks(folder, count, rate)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "start", "stop", "distance", "item_words"]
    for portion in _portions(batches):
        for search in blocks:
            for batch in portion:
                ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
                rows = [(d, *hit) for d, text in zip(ids, texts, strict=True) for hit in search.hits(text)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names=names)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id, item_id, start, stop, distance, item_words``: passages of documents that are benchmark items.

    Words are runs of letters, digits and underscores in lower case, and single
    characters of scripts without blanks (``DENSE``); ``start`` and ``stop``
    count them. Every passage within ``floor(rate * words)`` edits
    of an item is covered by a row (overlapping ones share one). An item of
    less than ``MIN_WORDS`` words (two such characters are one) is searched for
    like others from ``MIN_CHARS`` characters on, which of less than five words
    allows no edit; a shorter one matches only documents that consist of it;
    one without words, like a null, matches nothing. Documents without text
    have no passage. Repeated rows and rows with null ids are searched alike.

    The benchmark is searched for in blocks of bounded size, all in one pass
    over the documents. Very long texts are searched whole.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(partial(_search, blocks=_write_blocks(benchmark, rate, block_chars)), _HITS)


def _clean(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    for portion in _portions(batches):
        for search in blocks:
            for k, batch in enumerate(portion):
                stays = [next(search.hits(text), None) is None for text in batch["text"].to_pylist()]
                portion[k] = batch.filter(pa.array(stays, pa.bool_()))
        yield from portion


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which :func:`find_leaks` finds a passage, in the columns it has."""
    return docs.mapInArrow(partial(_clean, blocks=_write_blocks(benchmark, rate, block_chars)), docs.schema)
