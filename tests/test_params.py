import pytest

from pagedframes import plans
from pagedframes.operators import missing_pages, page_audit, read_by_key, read_by_keys, repeated_pages, unmatched_keys
from conftest import page_body

DECLARED = {"s": "string", "n": "integer", "b": "boolean", "d": "number"}


def rows(spark):
    return spark.createDataFrame([("x", 1, True), ("y", 1, False), ("x", 2, None)], "s STRING, n INT, b BOOLEAN")


@pytest.mark.parametrize("params, n", [({}, 3), ({"s": "x"}, 2), ({"s": "x", "n": 2}, 1), ({"b": False, "page": "?"}, 1)])
def test_filters(spark, params, n):
    assert plans.filter_rows(rows(spark), params, DECLARED).count() == n


@pytest.mark.parametrize(
    "params, told",
    [
        ({"z": 1}, "unknown parameter z"),
        ({"d": 1.5}, "type number is not supported"),
        ({"n": "1"}, "is not of type integer"),
        ({"n": True}, "is not of type integer"),
        ({"b": 1}, "is not of type boolean"),
    ],
)
def test_wrong_parameters(spark, params, told):
    with pytest.raises(ValueError, match=told):
        plans.filter_rows(rows(spark), params, DECLARED)


def test_keys(spark):
    df = rows(spark)
    keys = spark.createDataFrame([("x",), ("x",), ("q",), (None,)], "s STRING")
    assert read_by_key(df, "y", "s").count() == 1
    assert read_by_keys(df, keys, "s").count() == 2
    assert sorted(str(r["s"]) for r in unmatched_keys(df, keys, "s").collect()) == ["None", "q"]
    with pytest.raises(ValueError):
        read_by_key(df, None)


@pytest.mark.parametrize("total, n", [(0, 1), (1, 1), (200, 1), (201, 2), (4_000_001, 20_001)])
def test_page_plan(spark, total, n):
    plan = plans.page_plan(spark.createDataFrame([("d", total)], "dataset STRING, total LONG"))
    pages = sorted(r["page"] for r in plan.collect())
    assert pages == list(range(1, n + 1))
    assert plan.filter("page = 1").first()["query"] == "items_per_page=200&page=1"


def test_page_plan_spreads_one_large_dataset(spark):
    plan = plans.page_plan(spark.createDataFrame([("d", 200 * 10_000 * 64)], "dataset STRING, total LONG"))
    from pyspark.sql import functions as F

    sizes = [r["count"] for r in plan.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 640_000 and len(sizes) > 1 and max(sizes) < 400_000


def test_query_of_the_plan_is_encoded(spark):
    totals = spark.createDataFrame([("d", 1, {"q": "a b&c", "é": "1"})], "dataset STRING, total INT, params MAP<STRING,STRING>")
    assert plans.page_plan(totals).first()["query"] == "q=a+b%26c&%C3%A9=1&items_per_page=200&page=1"


def received(spark):
    def items(k):
        return [{"id": i} for i in range(k)]

    bodies = [("a", p, page_body(items(200 if p < 5 else 100), p, 900)) for p in (1, 2, 2, 4, 5)]
    bodies += [("empty", 1, page_body([], 1, 0)), ("full", 1, page_body(items(200), 1, 200))]
    return spark.createDataFrame(bodies, "dataset STRING, page INT, body STRING")


def test_audit(spark):
    found = {r["dataset"]: tuple(r)[1:] for r in page_audit(received(spark)).collect()}
    assert found == {
        "a": (900, 700, 4, 1, 0, 1, False),
        "empty": (0, 0, 1, 0, 0, 0, True),
        "full": (200, 200, 1, 0, 0, 0, True),
    }
    assert [tuple(r) for r in missing_pages(received(spark)).collect()] == [("a", 3)]
    assert [tuple(r) for r in repeated_pages(received(spark)).collect()] == [("a", 2, 2)]


def test_audit_does_not_cancel_out(spark):
    def page(dataset, number, n, total):
        body = page_body([{"id": i} for i in range(n)], number, total)
        return dataset, number, body.replace('"$total": null', '"$other": 0')

    rows = [page("gap", 1, 200, 400), page("gap", 3, 200, 400), page("huge", 1, 200, 5_000_000_000)]
    rows += [("untold", 1, '{"$items": [1, 2]}'), ("small", 1, page_body([1] * 100, 1, 150)), ("small", 2, page_body([1] * 50, 2, 150))]
    pages = spark.createDataFrame([*rows, ("broken", 1, "oops")], "dataset STRING, page INT, body STRING")
    found = {r["dataset"]: tuple(r)[1:] for r in page_audit(pages).collect()}
    assert found["gap"] == (400, 400, 2, 1, 1, 0, False)
    assert found["huge"] == (5_000_000_000, 200, 1, 24_999_999, 0, 0, False)
    assert found["untold"] == (None, 2, 1, None, None, 0, None)
    assert found["broken"] == (None, 0, 1, None, None, 0, None)
    tens = {r["dataset"]: tuple(r)[1:] for r in page_audit(pages.filter("dataset = 'small'"), page_size=100).collect()}
    assert tens == {"small": (150, 150, 2, 0, 0, 0, True)}
    gap = pages.filter("dataset in ('gap', 'small')")
    assert [tuple(r) for r in missing_pages(gap).collect()] == [("gap", 2)]


def test_requests_in_bulk(spark):
    params = "ARRAY<STRUCT<name: STRING, type: STRING, enum: ARRAY<STRING>, required: BOOLEAN>>"
    declared = [
        ("page", "integer", [], True),
        ("s", "string", ["x", "y"], True),
        ("n", "integer", [], False),
        ("b", "boolean", [], False),
        ("d", "number", [], False),
    ]
    endpoints = spark.createDataFrame(
        [(1, "/a", "get", declared), (1, "/a", "post", [])],
        f"spec_id INT, endpoint STRING, method STRING, params {params}",
    )
    asked = [
        (1, 1, "/a", {"s": "x", "n": "7", "b": "true"}),
        (2, 1, "/a", {"n": "7.5", "b": "yes", "page": "x"}),
        (3, 1, "/a", {"s": "z", "d": "1", "w": "1"}),
        (4, 1, "/b", {}),
    ]
    requests = spark.createDataFrame(
        asked, "request_id INT, spec_id INT, endpoint STRING, params MAP<STRING, STRING>"
    )
    assert [tuple(r) for r in plans.missing_params(requests, endpoints).collect()] == [(2, "s")]
    assert [tuple(r) for r in plans.enum_violations(requests, endpoints).collect()] == [(3, "s", "z")]
    assert {tuple(r) for r in plans.param_problems(requests, endpoints).collect()} == {
        (2, "n", "7.5", "value does not fit"),
        (2, "b", "yes", "value does not fit"),
        (3, "d", "1", "type not supported"),
        (3, "w", "1", "unknown"),
        (4, None, None, "unknown endpoint /b"),
    }
