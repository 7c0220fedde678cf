"""The records of a paged endpoint as a typed Spark data source, whose filters reach the server.

The schema is the declared record. A filter of equality on a field that is also
a parameter of the endpoint becomes a parameter of the requests, so the server
sends fewer pages; Spark still applies the filter to what comes.
"""

from __future__ import annotations

import json
import math
import urllib.parse
from collections.abc import Callable, Iterator, Mapping
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from pagedframes.sources.paged import PageRange, PagedReader, travel
from pagedframes.sources.transport import Transport

Fit = Callable[[Any], Any]

_NO_NUMBERS = {"NaN": math.nan, "Infinity": math.inf, "+Infinity": math.inf, "-Infinity": -math.inf}


def _whole(bits: int) -> Fit:
    end = 1 << bits - 1
    return lambda v: v if type(v) is int and -end <= v < end else None


def _real(v: Any) -> float | None:
    if type(v) in (int, float):
        return float(v)
    return _NO_NUMBERS.get(v) if isinstance(v, str) else None


def _text(v: Any) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def _listed(v: Any, fit: Fit) -> list | None:
    """An array with an element that does not fit is none."""
    fitted = [fit(e) for e in v] if isinstance(v, list) else None
    return None if fitted and any(f is None and e is not None for f, e in zip(fitted, v, strict=True)) else fitted


def fit_of(kind: T.DataType) -> Fit:
    """What makes a parsed JSON value a value of ``kind``, null where it does not fit, as ``from_json`` does."""
    if isinstance(kind, T.StructType):
        fits = [(f.name, fit_of(f.dataType)) for f in kind.fields]
        return lambda v: {name: fit(v.get(name)) for name, fit in fits} if isinstance(v, dict) else None
    if isinstance(kind, T.ArrayType):
        return partial(_listed, fit=fit_of(kind.elementType))
    if isinstance(kind, T.StringType):
        return _text
    if isinstance(kind, T.IntegerType):
        return _whole(32)
    if isinstance(kind, T.LongType):
        return _whole(64)
    if isinstance(kind, T.DoubleType):
        return _real
    if isinstance(kind, T.BooleanType):
        return lambda v: v if isinstance(v, bool) else None
    raise ValueError(f"type {kind.simpleString()} is not declared by any description")


class RecordSource(DataSource):
    transport: Transport
    pushdown = False

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        reader = PushdownRecordReader if self.pushdown else RecordReader
        return reader(self.transport, self.options, schema)


def register_records(spark: SparkSession, transport: Transport, name: str = "paged_records") -> None:
    """Make ``spark.read.format(name).schema(declared)`` read records through ``transport``.

    Options are those of the paged source, and ``equal``: parameters, as JSON
    ``{name: [allowed values]}`` (an empty list allows all), whose meaning at
    the server is equality with the field of that name. Filters reach the
    server if ``spark.sql.python.filterPushdown.enabled`` was on at this point.
    """
    travel()
    enabled = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    bound = {"transport": transport, "pushdown": enabled, "name": classmethod(lambda cls: name)}
    spark.dataSource.register(type("BoundRecordSource", (RecordSource,), bound))


class RecordReader(DataSourceReader):
    def __init__(self, transport: Transport, options: Mapping[str, str], schema: T.StructType):
        self.transport, self.options, self.schema = transport, dict(options), schema
        self.fit = fit_of(schema)
        self.given: dict[str, str] = {}

    def _pages(self) -> PagedReader:
        endpoint = next(v for k, v in self.options.items() if k.lower() == "endpoint")
        if self.given:
            endpoint += ("&" if "?" in endpoint else "?") + urllib.parse.urlencode(self.given)
        return PagedReader(self.transport, _Options({**self.options, "endpoint": endpoint}))

    def partitions(self) -> list[InputPartition]:
        return self._pages().partitions()

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        kind = pa.struct(list(arrow))
        for page, first, size, body in self._pages()._rows(part):
            items = json.loads(body)["$items"][first:]
            if size is not None and len(items) < size:
                raise ValueError(f"page {page} holds {first + len(items)} items, expected {first + size}")
            # what is no object has no fields, and is a row of nulls
            rows = [self.fit(item if isinstance(item, dict) else {}) for item in items[:size]]
            yield pa.RecordBatch.from_struct_array(pa.array(rows, kind)).cast(arrow)


class PushdownRecordReader(RecordReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality with an allowed value becomes a parameter; Spark applies all filters itself as well."""
        equal = json.loads(next((v for k, v in self.options.items() if k.lower() == "equal"), "{}"))
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo) and len(f.attribute) == 1 else None
            if name in equal and f.value is not None:
                value = json.dumps(f.value) if isinstance(f.value, bool) else str(f.value)
                if not equal[name] or value in equal[name]:
                    self.given.setdefault(name, value)
            yield f


class _Options(dict):
    """Options by their names in any case, as Spark gives them."""

    def __init__(self, given: Mapping[str, str]):
        super().__init__({k.lower(): v for k, v in given.items()})

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)
