"""The paged API as a Spark data source, batch and streaming.

``$total`` of page 1 tells how many pages there are, so pages are read in
parallel, one task per page range, instead of one after the other. Rows are
``page, first, size, body``: take ``size`` items of the body from position
``first`` on (all that follow, when ``size`` is null). ``unnest`` applies
that window and fails the read when a page holds fewer items than it should.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

import pagedframes
from pagedframes.sources.transport import Budget, Pace, Paging, Transport

SCHEMA = "page BIGINT, first INT, size INT, body STRING"
_ARROW = pa.schema([("page", pa.int64()), ("first", pa.int32()), ("size", pa.int32()), ("body", pa.string())])
_BATCH_PAGES = 16
_MIN_WIDTH, _MAX_TASKS = 50, 20_000  # pages per task at least, tasks per read at most
_BATCH_LIMIT = 10_000  # pages of one micro-batch of a stream


@dataclass
class PageRange(InputPartition):
    """Pages ``first..last``; an open range goes on until a page is not full."""

    first: int
    last: int
    open: bool = False
    start: int | None = None  # item window, streaming only
    end: int | None = None
    interval: float = 0.0  # seconds between requests, under a budget


class PagedSource(DataSource):
    transport: Transport
    pushdown = False

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        reader = PushdownReader if self.pushdown else PagedReader
        return reader(self.transport, self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStreamReader(self.transport, self.options)


def travel() -> None:
    """The package goes with the tasks that use it, so the executors' Python need not have it."""
    cloudpickle.register_pickle_by_value(pagedframes)


def register_transport(spark: SparkSession, transport: Transport, name: str = "paged") -> None:
    """Make ``spark.read.format(name)`` fetch through ``transport``. Option ``endpoint`` names the data.

    Filters on ``page`` narrow the requests when the session had
    ``spark.sql.python.filterPushdown.enabled`` on at this point; Spark refuses
    a reader with pushdown otherwise. The package travels with the source, so
    the executors' Python need not have it.
    """
    travel()
    enabled = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    bound = {"transport": transport, "pushdown": enabled, "name": classmethod(lambda cls: name)}
    source = type("BoundPagedSource", (PagedSource,), bound)
    spark.dataSource.register(source)


class _Endpoint:
    """The endpoint that the options name: ``endpoint``, and ``pageParam``, ``sizeParam``, ``pageSize`` if they differ."""

    def __init__(self, transport: Transport, options: dict[str, str]):
        self.transport, self.name = transport, options["endpoint"]
        known = Paging()
        self.paging = Paging(
            options.get("pageParam", known.page_param),
            options.get("sizeParam", known.size_param),
            int(options.get("pageSize", str(known.size))),
        )
        self.size = self.paging.size
        self.width = options.get("pagesPerPartition")
        self.per_batch = int(options.get("maxPagesPerBatch", str(_BATCH_LIMIT)))
        given = options.get("requestsPerSecond")
        self.budget = Budget(float(given)) if given else None

    def ranges(self, first: int, last: int) -> list[tuple[int, int]]:
        """Pages ``first..last`` cut into the ranges that tasks read."""
        width = int(self.width or max(_MIN_WIDTH, -(-(last - first + 1) // _MAX_TASKS)))
        if self.budget:
            tasks = self.budget.tasks(max(1, -(-(last - first + 1) // width)))
            width = max(1, -(-(last - first + 1) // tasks))
        return [(low, min(low + width - 1, last)) for low in range(first, last + 1, width)]

    def paced(self, parts: list) -> list:
        """Tell each part how long its task waits between requests."""
        for part in parts:
            part.interval = self.budget.interval(len(parts)) if self.budget else 0.0
        return parts

    def in_task(self, part: PageRange) -> _Endpoint:
        """This endpoint at the pace of ``part``."""
        if not part.interval:
            return self
        other = copy.copy(self)
        other.transport = self.transport.paced(Pace(part.interval))
        return other

    def pages(self, first: int, last: int | None) -> Iterator[tuple[int, str]]:
        """Pages ``first..last``, each of them and in order; the end is open without ``last``."""
        expected = first
        for page, body in self.transport.pages(self.name, first, last, self.paging):
            if page != expected:
                raise LookupError(f"expected page {expected}, got page {page}")
            yield page, body
            expected += 1
        if expected <= (first if last is None else last):
            raise LookupError(f"page {expected} is missing")

    def total(self) -> int | None:
        (_, text), *_ = self.pages(1, 1)
        body = json.loads(text)
        if not isinstance(body, dict) or not isinstance(body.get("$items"), list):
            raise ValueError(f"{self.name} does not answer with pages")
        return body.get("$total")

    def _is_full(self, page: int) -> bool:
        try:
            (_, text), *_ = self.pages(page, page)
        except LookupError:  # a page that is not there; the tasks will tell if it should be
            return False
        return len(json.loads(text)["$items"]) >= self.size

    def last_full(self) -> int:
        """The last full page, 0 if none is: pages 1, 2, 4, ... are asked for until one is not full, then halves."""
        low, high = 0, 1
        while self._is_full(high):
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._is_full(middle) else (low, middle)
        return low


def _batches(rows: Iterator[tuple[int, int, int | None, str]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH_PAGES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)


class PagedReader(DataSourceReader):
    def __init__(self, transport: Transport, options: dict[str, str]):
        self.endpoint = _Endpoint(transport, options)
        self.low, self.high = 1, None

    def partitions(self) -> Sequence[InputPartition]:
        total = self.endpoint.total()
        # without a total, the page after the last full one is the last
        final = self.endpoint.last_full() + 1 if total is None else max(1, -(-total // self.endpoint.size))
        last = final if self.high is None else min(final, self.high)
        parts = [PageRange(low, high) for low, high in self.endpoint.ranges(self.low, last)]
        if parts and last == final:
            parts[-1].open = True
        return self.endpoint.paced(parts or [PageRange(1, 0)])

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(part))

    def _rows(self, part: PageRange) -> Iterator[tuple[int, int, int | None, str]]:
        endpoint = self.endpoint.in_task(part)
        size = endpoint.size
        full_until = part.last - 1 if part.open else part.last
        if part.first <= full_until:
            for page, body in endpoint.pages(part.first, full_until):
                yield page, 0, size, body
        if part.open:
            # Items may have been added since page 1 was read, so the end is
            # where a page is not full, whatever the total said.
            for page, body in endpoint.pages(max(part.first, part.last), None):
                full = len(json.loads(body)["$items"]) == size
                yield page, 0, size if full else None, body
                if not full:
                    break


class PushdownReader(PagedReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        # Filters on the page number narrow the requests; Spark still applies them all.
        for f in filters:
            if getattr(f, "attribute", None) == ("page",):
                if isinstance(f, EqualTo):
                    self._narrow(f.value, f.value)
                elif isinstance(f, In):
                    self._narrow(min(f.value), max(f.value))
                elif isinstance(f, GreaterThan):
                    self._narrow(f.value + 1, None)
                elif isinstance(f, GreaterThanOrEqual):
                    self._narrow(f.value, None)
                elif isinstance(f, LessThan):
                    self._narrow(None, f.value - 1)
                elif isinstance(f, LessThanOrEqual):
                    self._narrow(None, f.value)
            yield f

    def _narrow(self, low: int | None, high: int | None) -> None:
        if low is not None:
            self.low = max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)


class PagedStreamReader(DataSourceStreamReader):
    """An append-only dataset as a stream; the offset counts items, so a page that fills up is not read twice.

    A batch takes up to ``maxPagesPerBatch`` pages, so a backlog is many
    batches, each of them committed. An offset short of the ``total`` seen when
    it was made tells that too, which is where ``drain`` ends. Spark asks a query
    that goes on for the empty range at its last offset first, so the reader
    knows where it stands.
    """

    def __init__(self, transport: Transport, options: dict[str, str]):
        self.endpoint = _Endpoint(transport, options)
        self.seen = 0
        self.at = 0

    def initialOffset(self) -> dict:
        return {"items": 0}

    def latestOffset(self) -> dict:
        total = self.endpoint.total()
        if total is None:
            raise ValueError(f"{self.endpoint.name} gives no $total, so it cannot be streamed")
        if total < self.seen:
            raise ValueError(f"{self.endpoint.name} shrank from {self.seen} to {total} items, so it cannot be streamed")
        self.seen = total
        end = min(total, self._limit(self.at))
        return {"items": end} if end == total else {"items": end, "total": total}

    def _limit(self, start: int) -> int:
        """Where ``per_batch`` pages after item ``start`` end."""
        return (start // self.endpoint.size + self.endpoint.per_batch) * self.endpoint.size

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        begin, stop = start["items"], end["items"]
        self.at = stop
        if begin > stop:
            # items that are gone shift all later ones, so what comes next could not be told from what was read
            raise ValueError(f"{self.endpoint.name} shrank from {begin} to {stop} items, so it cannot be streamed")
        if begin == stop:
            return []
        size = self.endpoint.size
        first, last = begin // size + 1, -(-stop // size)
        parts = [PageRange(low, high, start=begin, end=stop) for low, high in self.endpoint.ranges(first, last)]
        return self.endpoint.paced(parts)

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        return _batches(self._rows(part))

    def _rows(self, part: PageRange) -> Iterator[tuple[int, int, int, str]]:
        endpoint = self.endpoint.in_task(part)
        size = endpoint.size
        for page, body in endpoint.pages(part.first, part.last):
            base = (page - 1) * size
            low = max(part.start - base, 0)
            high = min(part.end - base, size)
            yield page, low, high - low, body
