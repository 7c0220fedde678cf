"""Read a dataset of a paged API by its name."""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagedframes.constants import PAGING_PARAMS
from pagedframes.operators.flattening import flatten_schema
from pagedframes.operators.typed import infer_rows, narrowed, typed_rows
from pagedframes.plans import catalogue, params as parameters
from pagedframes.plans.schemas import declared_schema, field_paths
from pagedframes.sources.envelope import read_array, read_object, unnest, unnest_typed
from pagedframes.sources.fetch import fetch_keys
from pagedframes.sources.paged import register_transport
from pagedframes.sources.records import register_records
from pagedframes.sources.transport import Budget, Paging, Transport
from pagedframes.storage import new_folder, write_and_reopen


class PagedAPI:
    """The datasets that one API description offers, read through one transport.

    ``paging`` tells page size and parameter names where they differ from the
    usual ones, ``budget`` how many requests a second each read may send.

    >>> api = PagedAPI(spark, description, HttpTransport("https://api.example.test", headers))
    >>> invoices = api.read("Invoice", {"status": "PAID"})
    """

    def __init__(
        self,
        spark: SparkSession,
        description: str,
        transport: Transport,
        name: str = "paged",
        paging: Paging | None = None,
        budget: Budget | None = None,
    ):
        self.spark, self.transport, self.name = spark, transport, name
        self.specs = spark.createDataFrame([(0, description)], "spec_id INT, body STRING")
        # One description has few endpoints; their rows are looked up on every read.
        self._datasets = {
            (row["schema_name"], row["kind"]): row
            for row in catalogue.dataset_endpoint(catalogue.endpoints(self.specs)).collect()
        }
        self._paths: DataFrame | None = None
        self.paging, self.budget = paging or Paging(), budget
        register_transport(spark, transport, name)
        register_records(spark, transport, f"{name}_records")

    def datasets(self) -> list[str]:
        return sorted({name for name, _ in self._datasets})

    def schema(self, dataset: str, flat: bool = False) -> T.StructType:
        """The declared schema, references resolved; ``flat`` gives the columns after flattening."""
        if self._paths is None:
            self._paths = field_paths(self.specs)
        schema = declared_schema(self._paths, dataset)
        return flatten_schema(schema) if flat else schema

    def read(
        self,
        dataset: str,
        params: Mapping[str, object] | None = None,
        columns: Sequence[str] | None = None,
        infer: bool = False,
    ) -> DataFrame:
        """The records of ``dataset`` as a DataFrame with the declared schema.

        A parameter ``key`` reads the one record of that key. The other
        parameters are checked against the description and sent to the
        server; paging parameters are ignored. ``columns`` limits what is
        parsed. ``infer=True`` takes the schema from the records instead,
        which are fetched at once and kept in the shared folder for that.
        """
        given = dict(params or {})
        entry, url = self._request(dataset, given)
        if self._is_paged(entry):
            pages = self.spark.read.format(self.name).options(**self._options(url)).load()
            if infer:
                return infer_rows(unnest(self._landed(pages, "pages")))
            return unnest_typed(pages, narrowed(self.schema(dataset), columns))
        # a single body; it is fetched in a task when the DataFrame runs
        get = self.transport.get
        bodies = self.spark.createDataFrame([(url,)], "url STRING").mapInPandas(
            lambda frames: (frame.assign(body=frame["url"].map(get))[["body"]] for frame in frames), "body STRING"
        )
        if entry["schema_type"] == "object":
            items = read_object(bodies)
        elif entry["schema_type"] == "array":
            items = read_array(bodies)
        else:
            raise ValueError(f"{dataset}: unknown response type {entry['schema_type']}")
        if infer:
            return infer_rows(self._landed(items.select("item"), "items"))
        return typed_rows(items.select("item"), narrowed(self.schema(dataset), columns))

    def records(
        self, dataset: str, params: Mapping[str, object] | None = None, equal: Sequence[str] | None = None
    ) -> DataFrame:
        """The records of a paged ``dataset`` with the declared schema, whose filters reach the server.

        ``equal`` names the parameters that mean equality with the field of
        their name; by default these are all that bear the name of a field and
        take text, whole numbers or booleans as the field does. A comparison
        with a value outside a parameter's declared ones stays with Spark. What
        a server makes of a parameter is its own affair: leave out of ``equal``
        those that mean a range or a search. Needs
        ``spark.sql.python.filterPushdown.enabled`` before this object is made.
        """
        entry, url = self._request(dataset, dict(params or {}))
        if not self._is_paged(entry):
            raise ValueError(f"{dataset} is not paged")
        schema = self.schema(dataset)
        kinds = {"string": T.StringType(), "integer": T.IntegerType(), "boolean": T.BooleanType()}
        fields = {f.name: f.dataType for f in schema.fields}
        taken = set(params or {})
        means = {
            p["name"]: list(p["enum"] or [])
            for p in entry["params"]
            if p["name"] not in taken and fields.get(p["name"]) == kinds.get(p["type"], T.NullType())
        }
        if equal is not None:
            unknown = [name for name in equal if name not in means]
            if unknown:
                raise ValueError(f"no field and free parameter of one type: {', '.join(unknown)}")
            means = {name: means[name] for name in equal}
        reader = self.spark.read.format(f"{self.name}_records").schema(_nullable(schema))
        return reader.options(**self._options(url), equal=json.dumps(means)).load()

    def read_keys(
        self, dataset: str, keys: DataFrame, column: str = "key", columns: Sequence[str] | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """The records of all ``keys``, and the ``key`` values that have none; each different key is asked for once."""
        entry = self._datasets.get((dataset, "item"))
        if entry is None:
            raise ValueError(f"no dataset {dataset} that is read by key")
        found = fetch_keys(keys, entry["endpoint"], self.transport, self.budget, column=column)
        bodies = read_object(found.filter("body IS NOT NULL").select("body"))
        return typed_rows(bodies, narrowed(self.schema(dataset), columns)), found.filter("body IS NULL").select("key")

    def empty(self, dataset: str) -> DataFrame:
        """No records, in the declared columns."""
        return self.spark.createDataFrame([], _nullable(self.schema(dataset)))

    def _is_paged(self, entry) -> bool:
        names = {*PAGING_PARAMS, self.paging.page_param, self.paging.size_param}
        return any(p["name"] in names for p in entry["params"])

    def _options(self, url: str) -> dict[str, str]:
        paging = self.paging
        options = {"pageParam": paging.page_param, "sizeParam": paging.size_param, "pageSize": str(paging.size)}
        budget = {"requestsPerSecond": str(self.budget.per_second)} if self.budget else {}
        return {"endpoint": url, **options, **budget}

    def _landed(self, fetched: DataFrame, label: str) -> DataFrame:
        # inference needs a second pass, and a second fetch might bring other records
        return write_and_reopen(fetched, new_folder(self.spark, label))

    def _request(self, dataset: str, given: dict[str, object]) -> tuple[object, str]:
        kind = "item" if "key" in given else "list"
        entry = self._datasets.get((dataset, kind))
        if entry is None:
            other = self._datasets.get((dataset, "item"))
            if kind == "list" and other is not None:
                raise ValueError(f"{dataset} is read by key; give the parameter key")
            raise ValueError(f"no dataset {dataset}" + (" that is read by key" if kind == "item" else ""))
        path = entry["endpoint"]
        if kind == "item":
            key = given.pop("key")
            if not isinstance(key, str):
                raise ValueError("the parameter key must be a string")
            path = path.replace("{key}", urllib.parse.quote(key, safe=""))
        declared = {p["name"]: p["type"] for p in entry["params"]}
        required = [p["name"] for p in entry["params"] if p["required"]]
        parameters.checked(given, declared, required)
        unsent = {*PAGING_PARAMS, self.paging.page_param, self.paging.size_param}
        sent = [(name, _text(value)) for name, value in given.items() if name not in unsent]
        return entry, path + ("?" + urllib.parse.urlencode(sent) if sent else "")


def _nullable(kind: T.DataType) -> T.DataType:
    """``required`` is for ``validate``: what a server sends may lack a field."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return kind


def _text(value: object) -> str:
    return json.dumps(value) if isinstance(value, bool) else str(value)
