import pytest
from pyspark.sql import types as T

from pagedframes import flatten, infer_rows, typed_rows, validate
from pagedframes.operators import field_problems

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("n", T.IntegerType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("c", T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("x", T.DoubleType())])),
        T.StructField("l", T.ArrayType(T.StructType([T.StructField("p", T.IntegerType(), False)]))),
        T.StructField("t", T.ArrayType(T.StringType())),
    ]
)


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k INT, item STRING")


def test_typed_rows_keep_other_columns(spark):
    df = typed_rows(items(spark, '{"id":"a","n":1,"c":{"x":2}}', "{}"), SCHEMA)
    assert df.columns == ["k", "id", "n", "ok", "c", "l", "t"]
    first, second = df.orderBy("k").collect()
    assert (first["id"], first["n"], first["c"]["x"]) == ("a", 1, 2.0)
    assert second["id"] is None


PROBLEMS = {
    '{"id":"a","n":1,"ok":true,"c":{"id":1,"x":2.5},"l":[{"p":1}],"t":["a",null]}': [],
    '{"id":"a","c":null,"l":[],"t":null}': [],
    "{}": [("id", "missing")],
    '{"id":null}': [("id", "missing")],
    '{"id":"a","n":5000000000}': [("n", "unreadable")],
    '{"id":"a","ok":"yes"}': [("ok", "unreadable")],
    '{"id":"a","more":1,"c":{"id":1,"deep":2}}': [("c.deep", "undeclared"), ("more", "undeclared")],
    '{"id":"a","c":{"x":"n/a"}}': [("c.id", "missing"), ("c.x", "unreadable")],
    '{"id":"a","c":5}': [("c", "unreadable")],
    '{"id":"a","l":5}': [("l", "unreadable")],
    "oops": [("$", "unreadable")],
    "[1]": [("$", "unreadable")],
    # several elements with the same problem count once
    '{"id":"a","l":[{"p":1},{"p":"x"},{"p":"y","q":1},{}]}': [
        ("l[].p", "missing"),
        ("l[].p", "unreadable"),
        ("l[].q", "undeclared"),
    ],
}


def test_each_kind_of_problem(spark):
    found = {text: [] for text in PROBLEMS}
    for row in field_problems(items(spark, *PROBLEMS), SCHEMA).collect():
        found[row["item"]].append((row["field"], row["problem"]))
    assert {text: sorted(told) for text, told in found.items()} == PROBLEMS


def test_validate_counts_records(spark):
    df = items(spark, "{}", "{}", '{"id":"a","n":"x"}', '{"id":"b"}')
    assert {tuple(r) for r in validate(df, SCHEMA).collect()} == {("id", "missing", 2), ("n", "unreadable", 1)}


MERGES = [
    ['{"a":1,"b":{"c":1}}', '{"a":2.5,"b":{"d":"x"}}', '{\n "a": null,\r\n "e": null}'],
    ['{"a":1}', '{"a":"x"}'],
    ['{"a":true}', '{"a":1}'],
    ['{"a":{"b":1}}', '{"a":5}'],
    ['{"a":{}}', '{"b":{"c":{}}}', '{"c":[{}]}', '{"d":1}'],
    ['{"a":[]}', '{"b":[1,"x"],"c":[[1],[2.5]]}'],
    ['{"b":1,"a":{"d":[{"z":1.50},{"y":null}]}}'],
    ['{"VOID":1,"VARIANT":null,"a b":1,"q`r":{"x.y":2.5},"OBJECT":{"DECIMAL":1.25}}'],
    ['{"a":123456789012345678901234}', '{"b":1e20}', '{"c":9223372036854775807}'],
    ['{"1a":1,"é":2}', "oops", '{"1a":"cut'],
    ["oops"],
    [],
]


@pytest.mark.parametrize("texts", MERGES)
def test_inference_equals_the_json_reader(spark, texts):
    df = infer_rows(items(spark, *texts))
    # one text per line, as the reader's files have it
    expected = spark.read.json(spark.sparkContext.parallelize([t.replace("\r\n", " ").replace("\n", " ") for t in texts]))
    assert df.schema.simpleString() == expected.schema.simpleString()
    if df.columns != ["_corrupt_record"]:
        assert sorted(map(str, df.collect())) == sorted(map(str, expected.collect()))


def test_inference_then_flatten(spark):
    assert flatten(infer_rows(items(spark, *MERGES[0]))).columns == ["a", "b_c", "b_d", "e"]


def test_elements_are_looked_at_if_anything_is_amiss(spark):
    schema = T.StructType().add("lines", T.ArrayType(T.StructType().add("a", T.IntegerType()).add(T.StructField("b", T.StringType(), False))))
    lines = {
        "fine": '{"a":1,"b":"x"}',
        "other": '{"a":1,"c":"x"}',  # as many fields as declared
        "twice": '{"a":1,"a":2,"b":"x"}',
        "more": '{"a":1,"b":"x","c":null}',
        "bad": '{"a":"x","b":"x"}',
        "none": "null",
    }
    rows = [(name, f'{{"lines":[{lines["fine"]},{line}]}}') for name, line in lines.items()]
    found = field_problems(spark.createDataFrame(rows, "name string, item string"), schema)
    told = sorted((r["name"], r["field"], r["problem"]) for r in found.collect())
    assert told == [
        ("bad", "lines[].a", "unreadable"),
        ("more", "lines[].c", "undeclared"),
        ("other", "lines[].b", "missing"),
        ("other", "lines[].c", "undeclared"),
    ]
