import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from conftest import page_body
from pagedframes.sources import body_rejects, read_array, read_object, unnest, unnest_typed

SCHEMA = T.StructType().add("id", "string").add("n", "integer").add("c", T.StructType().add("x", "double"))


def pages(spark, *bodies):
    rows = [(i + 1, body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "page INT, body STRING")


def items(n):
    return [{"id": str(i), "n": i} for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 200, 201])
def test_item_counts(spark, n):
    df = pages(spark, page_body(items(n)))
    rows = unnest(df).collect()
    assert [r["pos"] for r in rows] == list(range(n))
    assert all(r["total"] == n for r in rows)
    assert unnest_typed(df, SCHEMA).count() == n


def test_item_text_keeps_nesting_and_key_order(spark):
    record = {"z": {"b": [1, {"k": "a,b"}]}, "a": "line\nbreak", "é": None}
    (row,) = unnest(pages(spark, page_body([record]))).collect()
    assert json.loads(row["item"]) == record
    assert list(json.loads(row["item"])) == ["z", "a", "é"]


def test_one_bad_value_leaves_its_neighbours(spark):
    body = page_body([{"id": "a", "n": "bad", "c": {"x": "n/a"}}, {"id": "b", "n": 5_000_000_000}, {"id": "c", "n": 3}])
    rows = unnest_typed(pages(spark, body), SCHEMA).collect()
    assert [(r["id"], r["n"]) for r in rows] == [("a", None), ("b", None), ("c", 3)]


BROKEN = {
    "oops": "not json",
    None: "null body",
    '{"error":"bad"}': "no $items",
    '{"$items":5}': "no $items",
    '[{"$items":[1]}]': "not an object",
    '{"$total":1,"$items":[{"id":"cut"}': "not json",
    "7": "not an object",
    '{"$total":2,"$items":[{"id":"a"}]} <html>': "not json",
    '{"$total":1,"$items":[{"id":"a"}]}] [1': "not json",
    '{"$total":1,"$items":[{"id":"a"}]}} {': "not json",
    '{"$total":1,"$items":[{"id":"a"}]},"v":{}': "not json",
}


def test_rejects(spark):
    found = body_rejects(pages(spark, page_body(items(2)), *BROKEN)).collect()
    assert {r["body"]: r["reason"] for r in found} == BROKEN


@pytest.mark.parametrize("body", BROKEN)
def test_strict_read_fails(spark, body):
    df = pages(spark, page_body(items(2)), body)
    with pytest.raises(PySparkException, match="page 2 is not a readable page body"):
        unnest(df).collect()
    with pytest.raises(PySparkException, match="page 2 is not a readable page body"):
        unnest_typed(df, SCHEMA).collect()
    assert unnest(df, strict=False).count() == 2


def test_object_and_array_bodies(spark):
    one = spark.createDataFrame([('{"id":"a"}',)], "body STRING")
    many = spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',), ("[]",)], "body STRING")
    assert [r["item"] for r in read_object(one).collect()] == ['{"id":"a"}']
    assert [r["item"] for r in read_array(many).collect()] == ['{"id":"a"}', '{"id":"b"}']
    with pytest.raises(PySparkException, match="expected a body of shape array, found object"):
        read_array(one).collect()
    with pytest.raises(PySparkException, match="expected a body of shape object, found array"):
        read_object(many).collect()
    with pytest.raises(PySparkException, match="found no JSON"):
        read_object(spark.createDataFrame([("oops",)], "body STRING")).collect()


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "id": st.text(st.characters(exclude_categories=["Cs"])),
                "n": st.none() | st.integers(-(2**31), 2**31 - 1),
                "c": st.none() | st.fixed_dictionaries({"x": st.floats(allow_nan=False, allow_infinity=False)}),
            }
        ),
        max_size=5,
    )
)
def test_decoding_gives_back_what_was_encoded(spark, records):
    rows = unnest_typed(pages(spark, page_body(records)), SCHEMA).collect()
    assert [r.asDict(recursive=True) for r in rows] == records
