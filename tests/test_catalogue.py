import json

import pytest
from pyspark.sql import types as T

from pagedframes import fixtures as fx
from pagedframes import plans
from pagedframes.plans import schemas
from pagedframes.storage import write_and_reopen

TEXT, WHOLE, REAL = {"type": "string"}, {"type": "integer"}, {"type": "number", "format": "double"}


def ref(name):
    return {"$ref": f"#/definitions/{name}"}


def obj(required=(), **properties):
    return {"type": "object", "required": list(required), "properties": properties}


def op(schema=None, parameters=(), produces=("application/json",), **responses):
    answers = responses or {"200": {"schema": schema} if schema else {}}
    return {"produces": list(produces), "parameters": list(parameters), "responses": answers}


def specs(spark, *documents):
    rows = [(i, json.dumps(d) if isinstance(d, dict) else d) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "spec_id INT, body STRING")


def described(spark, **definitions):
    return plans.field_paths(specs(spark, {"definitions": definitions}))


def struct(*fields):
    return T.StructType([T.StructField(*f) for f in fields])


def test_declared_schema_equals_the_hand_written_one(spark):
    doc = fx.description().replace("@SEG@", "Sales")
    paths = plans.field_paths(specs(spark, doc))
    assert plans.declared_schema(paths, "SalesInvoice") == fx.INVOICE


def test_types(spark):
    steps = {"type": "array", "items": obj(n=WHOLE, tags={"type": "array", "items": TEXT})}
    paths = described(
        spark,
        A=obj(["s"], s={"type": "string", "format": "date"}, i=WHOLE, d=REAL, b={"type": "boolean"}, r=ref("B")),
        B=obj(list={"type": "array", "items": ref("C")}, steps=steps, o=obj(["c"], c=ref("C"))),
        C=obj(x=TEXT),
    )
    c = struct(("x", T.StringType()))
    step = struct(("n", T.IntegerType()), ("tags", T.ArrayType(T.StringType())))
    b = struct(("list", T.ArrayType(c)), ("steps", T.ArrayType(step)), ("o", struct(("c", c, False))))
    assert plans.declared_schema(paths, "B") == b
    assert plans.declared_schema(paths, "A") == struct(
        ("s", T.StringType(), False),
        ("i", T.IntegerType()),
        ("d", T.DoubleType()),
        ("b", T.BooleanType()),
        ("r", b),
    )


def test_cycles_end_and_are_told(spark):
    paths = described(spark, A=obj(x=TEXT, b=ref("B"), self={"type": "array", "items": ref("A")}), B=obj(y=TEXT, a=ref("A")))
    told = {(r["schema_name"], ".".join(r["path"])): r["problem"] for r in paths.filter("problem is not null").collect()}
    assert told == {
        ("A", "self"): "refers back to A",
        ("A", "b.a"): "refers back to A",
        ("B", "a.b"): "refers back to B",
        ("B", "a.self"): "refers back to A",
    }
    assert plans.declared_schema(paths, "A") == struct(("x", T.StringType()), ("b", struct(("y", T.StringType()))))


@pytest.mark.parametrize(
    "field, told",
    [
        ({"type": "number", "format": "float"}, "number of format float"),
        ({"type": "number"}, "number of format none"),
        ({"type": "array", "items": WHOLE}, "array of integer"),
        ({"type": "file"}, "type file"),
        (ref("Nowhere"), "unknown reference Nowhere"),
        ({"type": "array", "items": ref("Nowhere")}, "unknown reference Nowhere"),
    ],
)
def test_fields_that_have_no_type_are_named(spark, field, told):
    paths = described(spark, A=obj(good=TEXT, bad=field))
    with pytest.raises(ValueError, match=f"A.bad: {told}"):
        plans.declared_schema(paths, "A")


def test_same_names_in_other_documents_stay_apart(spark):
    one = {"definitions": {"A": obj(r=ref("B")), "B": obj(x=TEXT)}}
    two = {"definitions": {"A": obj(r=ref("B")), "B": obj(y=WHOLE)}}
    paths = plans.field_paths(specs(spark, one, two))
    assert plans.declared_schema(paths, "A", 0) == struct(("r", struct(("x", T.StringType()))))
    assert plans.declared_schema(paths, "A", 1) == struct(("r", struct(("y", T.IntegerType()))))


def test_flat_fields_equal_flattened_schema(spark):
    from pagedframes import flatten_schema

    doc = fx.description().replace("@SEG@", "Sales")
    flat = plans.flat_fields(plans.field_paths(specs(spark, doc))).filter("schema_name = 'SalesInvoice'")
    rows = sorted(flat.collect(), key=lambda r: r["pos"])
    expected = flatten_schema(fx.INVOICE)
    assert [r["column"] for r in rows] == expected.names
    assert [r["nullable"] for r in rows] == [f.nullable for f in expected]


def test_endpoints_report_what_cannot_be_used(spark):
    paths = {
        "/a": {"get": op(ref("A")), "patch": op(ref("A")), "x-note": "hi"},
        "/b": {"get": op(ref("B"), produces=["text/html"]), "post": op(produces=[])},
        "/c": {"get": op({"type": "array"})},
    }
    rows = plans.endpoints(specs(spark, {"paths": paths})).collect()
    assert {(r["endpoint"], r["method"]): (r["schema_name"], r["schema_type"], r["problem"]) for r in rows} == {
        ("/a", "get"): ("A", "object", None),
        ("/a", "patch"): ("A", "object", "method patch is not supported"),
        ("/b", "get"): ("B", "object", "content type text/html"),
        ("/b", "post"): ("", None, "no response schema"),
        ("/c", "get"): ("", "array", None),
    }
    usable = plans.read_paths(plans.endpoints(specs(spark, {"paths": paths})))
    assert sorted(r["endpoint"] for r in usable.collect()) == ["/a", "/c"]


def test_first_written_response_wins(spark):
    answers = {"default": {"schema": ref("First")}, "200": {"schema": ref("Second")}}
    rows = plans.endpoints(specs(spark, {"paths": {"/a": {"get": op(**answers)}}})).collect()
    assert [r["schema_name"] for r in rows] == ["First"]


def test_last_written_endpoint_wins_per_kind(spark):
    listing = {"type": "array", "items": ref("A")}
    paths = {"/z": {"get": op(listing)}, "/y/{key}": {"get": op(ref("A"))}, "/a": {"get": op(listing)}}
    rows = plans.dataset_endpoint(plans.endpoints(specs(spark, {"paths": paths}))).collect()
    assert {(r["kind"], r["endpoint"]) for r in rows} == {("list", "/a"), ("item", "/y/{key}")}


def test_other_placeholders_serve_no_dataset(spark):
    paths = {path: {"get": op(ref("A"))} for path in ("/a", "/a/{key}", "/a/{id}/hist", "/b/{id}/a/{key}")}
    rows = plans.dataset_endpoint(plans.endpoints(specs(spark, {"paths": paths}))).collect()
    assert {(r["kind"], r["endpoint"]) for r in rows} == {("list", "/a"), ("item", "/a/{key}")}


def test_params(spark):
    parameters = [
        {"in": "path", "name": "key", "type": "string", "required": True},
        {"in": "query", "name": "q", "type": "string", "enum": ["a", "b"], "required": True},
        {"in": "query", "name": "n", "type": "integer"},
        {"in": "body", "name": "x", "schema": {"type": "object"}},
    ]
    doc = {"paths": {"/a": {"get": op(ref("A"), parameters)}}}
    rows = plans.query_params(plans.endpoints(specs(spark, doc))).orderBy("pos").collect()
    assert [tuple(r)[3:] for r in rows] == [(0, "q", "string", ["a", "b"], True), (1, "n", "integer", [], False)]


def test_base_url(spark):
    doc = {"host": "h.test", "basePath": "/v1", "schemes": ["https", "http"]}
    assert plans.base_url(specs(spark, doc)).first()["base_url"] == "https://h.test/v1"


def test_no_description_has_no_fields(spark):
    none = spark.createDataFrame([], "spec_id bigint, body string")
    assert plans.field_paths(none).count() == 0


def test_chains_of_references_take_logarithmic_rounds(spark, monkeypatch):
    written = []

    def counted(df, folder):
        written.append(folder.rsplit("/", 1)[-1])
        return write_and_reopen(df, folder)

    monkeypatch.setattr(schemas, "write_and_reopen", counted)
    n = 21
    links = {f"D{i}": obj(["next"], x=TEXT, next=ref(f"D{i + 1}")) for i in range(n - 1)}
    paths = described(spark, **links, **{f"D{n - 1}": obj(x=TEXT, back=ref("D3"))})
    rows = paths.collect()
    expected = {(f"D{i}", ("next",) * (j - i) + (f,)) for i in range(n) for j in range(i, n) for f in ("x", "next" if j < n - 1 else "back")}
    # from the last one, the walk goes on at D3 until it meets a definition opened before
    for i in range(4, n):
        expected |= {(f"D{i}", ("next",) * (n - 1 - i) + ("back",) + ("next",) * k + (f,)) for k in range(i - 3) for f in ("x", "next")}
    assert len(rows) == len(expected)
    assert {(r["schema_name"], tuple(r["path"])) for r in rows} == expected
    told = {(r["schema_name"], r["path"][-1]): r["problem"] for r in rows if r["problem"]}
    assert told == {
        (f"D{i}", "back" if i <= 3 else "next"): f"refers back to D{3 if i <= 3 else i}" for i in range(n)
    }
    assert [w for w in written if w.startswith("own")] == ["own0"]
    # walks of 1, 2, 4, 8, 16 and 32 references
    assert [w for w in written if w.startswith("walks")] == [f"walks{k}" for k in range(6)]


def test_several_fields_of_one_reference_are_apart(spark):
    paths = described(
        spark,
        A=obj(["m"], one=ref("B"), two={"type": "array", "items": ref("B")}, m=obj(["deep"], deep=ref("C"))),
        B=obj(["c"], c=ref("C")),
        C=obj(["x"], x=TEXT),
    )
    rows = paths.filter("schema_name = 'A'").collect()
    found = {".".join(r["path"]): (r["pos"], r["path_nullable"], r["in_array"]) for r in rows}
    assert found == {
        "one": ([0], True, False),
        "one.c": ([0, 0], True, False),
        "one.c.x": ([0, 0, 0], True, False),
        "two": ([1], True, False),
        "two.c": ([1, 0], True, True),
        "two.c.x": ([1, 0, 0], True, True),
        "m": ([2], False, False),
        "m.deep": ([2, 0], False, False),
        "m.deep.x": ([2, 0, 0], False, False),
    }
