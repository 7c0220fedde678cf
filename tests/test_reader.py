import json
import re
import sys

import conftest
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from conftest import page_body
from pagedframes import FunctionTransport, PagedAPI, fixtures as fx, flatten, flatten_schema

# test modules are not on the path of Python workers
cloudpickle.register_pickle_by_value(conftest)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INVOICES = [{"id": str(i), "number": i, "contact": {"id": 1, "region": {"name": "r"}}} for i in range(250)]


def server(url):
    path, _, query = url.partition("?")
    if path == "/contacts":
        return page_body([])
    if path.startswith("/regions"):
        return "[]" if query else '[{"name": "r1", "group": {"name": "g"}}, {"name": "r2"}]'
    if path == "/invoices":
        assert "from_date=2024-01-01+x" in query
        page = int(re.search(r"[?&]page=(\d+)", url).group(1))
        return page_body(INVOICES[(page - 1) * 200 : page * 200], page, len(INVOICES))
    if path == "/invoices/4%2F5":
        return json.dumps({"id": "4/5", "number": 45})
    return '["wrong shape"]'


@pytest.fixture(scope="module")
def api(spark):
    return PagedAPI(spark, fx.description().replace("@SEG@", "Sales"), FunctionTransport(server), "reader_api")


def test_paged_read(api):
    df = api.read("SalesInvoice", {"from_date": "2024-01-01 x", "page": 99, "items_per_page": 5})
    assert df.schema == T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in fx.INVOICE])
    assert sorted(r["number"] for r in df.collect()) == list(range(250))
    assert "contact_region_name" in flatten(df).columns


def _nullable(kind):
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return T.ArrayType(_nullable(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def test_columns_are_all_that_is_parsed(api):
    df = api.read("SalesInvoice", {"from_date": "2024-01-01 x"}, columns=["number"])
    assert df.columns == ["number"] and df.count() == 250
    with pytest.raises(ValueError, match="no such fields: nope"):
        api.read("SalesInvoice", {"from_date": "2024-01-01 x"}, columns=["nope"])


def test_inferred_read(api):
    df = api.read("SalesInvoice", {"from_date": "2024-01-01 x"}, infer=True)
    assert dict(df.dtypes) == {"contact": "struct<id:bigint,region:struct<name:string>>", "id": "string", "number": "bigint"}
    assert df.count() == 250


def test_read_by_key(api):
    (row,) = api.read("SalesInvoice", {"key": "4/5", "show_legacy": True}).collect()
    assert (row["id"], row["number"]) == ("4/5", 45)
    with pytest.raises(PySparkException, match="expected a body of shape object, found array"):
        api.read("SalesInvoice", {"key": "other"}).collect()


def test_array_read_and_empty_results_keep_columns(api):
    assert {r["name"] for r in api.read("Region").collect()} == {"r1", "r2"}
    empty = api.read("Region", {"show_legacy": False})
    assert empty.columns == ["name", "group"] and empty.count() == 0
    empty = api.read("Contact")
    assert empty.columns == ["id", "name", "balance", "region"] and empty.count() == 0


@pytest.mark.parametrize(
    "dataset, params, told",
    [
        ("SalesInvoice", {}, "required parameters are missing: from_date"),
        ("SalesInvoice", {"from_date": "x", "z": 1}, "unknown parameter z"),
        ("SalesInvoice", {"from_date": 1}, "is not of type string"),
        ("SalesInvoice", {"key": 5}, "key must be a string"),
        ("Contact", {"key": "1"}, "no dataset Contact that is read by key"),
        ("Nothing", {}, "no dataset Nothing"),
    ],
)
def test_errors_are_raised(api, dataset, params, told):
    with pytest.raises(ValueError, match=told):
        api.read(dataset, params)


def test_datasets(api):
    assert api.datasets() == ["Contact", "Region", "SalesInvoice"]


def test_schemas(api):
    assert api.schema("SalesInvoice") == fx.INVOICE
    assert api.schema("SalesInvoice", flat=True) == flatten_schema(fx.INVOICE)
    with pytest.raises(ValueError, match="no fields for Nothing"):
        api.schema("Nothing")
