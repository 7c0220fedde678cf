import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from pagedframes.operators import url_param_values, url_params
from pagedframes.sources import csv_lines, csv_rejects, csv_rows, decode_bodies, pages_from_files, unnest

PRODUCT = T.StructType().add("id", T.IntegerType()).add("name", T.StringType())


def test_decode(spark):
    rows = [("text", "é\n".encode()), ("html", b"<p>a\xffb</p>"), ("json", b' {"a": 1}')]
    df = decode_bodies(spark.createDataFrame(rows, "kind STRING, content BINARY"))
    assert [r["text"] for r in df.collect()] == ["é\n", "<p>a�b</p>", ' {"a": 1}']
    for kind, content, told in (("json", b"oops", "body is not JSON"), ("pdf", b"", "unknown body kind pdf")):
        with pytest.raises(PySparkException, match=told):
            decode_bodies(spark.createDataFrame([(kind, content)], "kind STRING, content BINARY")).collect()


def csv(spark, *bodies):
    return spark.createDataFrame([(b.encode(),) for b in bodies], "content BINARY")


def test_csv(spark):
    df = csv(spark, 'id,name\n1,"a, b"\r\n2,é\n', "id,name\n", "id,name\n3,x")
    rows = csv_rows(df, PRODUCT).collect()
    assert sorted((r["pos"], r["id"], r["name"]) for r in rows) == [(1, 1, "a, b"), (1, 3, "x"), (2, 2, "é")]
    assert csv_lines(df).count() == 6


def test_csv_with_another_header_fails(spark):
    with pytest.raises(PySparkException, match="CSV header should be id,name, is name,id"):
        csv_rows(csv(spark, "name,id\nx,1"), PRODUCT).collect()
    # also when no column is asked for
    with pytest.raises(PySparkException, match="CSV header should be"):
        csv_rows(csv(spark, "name,id\nx,1"), PRODUCT).count()


def test_csv_lines_that_are_no_rows(spark):
    bad = csv(spark, "id,name\n1,a\n\n2\n3,b,c\nx,d\n4,\n")
    told = {r["pos"]: (r["line"], r["reason"]) for r in csv_rejects(bad, PRODUCT).collect()}
    no = "not as declared"
    assert told == {2: ("", "blank"), 3: ("2", no), 4: ("3,b,c", no), 5: ("x,d", no)}
    with pytest.raises(PySparkException, match="CSV line 3 is not as declared: 2"):
        csv_rows(csv(spark, "id,name\n1,a\n\n2\n"), PRODUCT).collect()
    rows = csv_rows(csv(spark, "id,name\n1,a\n\n4,\n"), PRODUCT).collect()
    assert [(r["pos"], r["id"], r["name"]) for r in rows] == [(1, 1, "a"), (3, 4, None)]


CASES = {
    "https://a.test/p": [],
    "https://a.test/p?k=v&k=w&flag#f": [("k", "v"), ("k", "w"), ("flag", None)],
    "https://a.test/p?a=&b==&=c": [("a", None), ("b", None), ("", "c")],
    "https://a.test/p?k=a=b&x=%C3%A9+z%26": [("k", "a=b"), ("x", "é z&")],
    "https://a.test/p?bad=%zz&n=1": [("bad", "%zz"), ("n", "1")],
    "no url at all ?a=b c": [("a", "b c")],
    "https://a.test/p#x?y=1": [],
}


@pytest.mark.parametrize("url", CASES)
def test_url_params(spark, url):
    rows = url_params(spark.createDataFrame([(1, url)], "id INT, url STRING")).orderBy("pos").collect()
    assert [(r["key"], r["value"]) for r in rows] == CASES[url]


def test_url_param_values_group_within_the_row(spark):
    df = spark.createDataFrame([(1, "https://a.test/?k=v&flag&k=w&k"), (2, None)], "id INT, url STRING")
    grouped = url_param_values(df)
    assert {r["key"]: r["values"] for r in grouped.collect()} == {"k": ["v", "w", None], "flag": [None]}
    assert "Exchange" not in grouped._jdf.queryExecution().toString()


def test_pages_from_files(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"p{page}.json").write_text(f'{{"$total": 2,\n "$items": [{{"id": {page}}}]}}')
    pages = pages_from_files(spark, str(tmp_path), "x")
    assert {r["item"] for r in unnest(pages).collect()} == {'{"id":1}', '{"id":2}'}


@pytest.mark.parametrize(
    "body, lines",
    [
        ('a,b\n1,"x\ny"\n2,z', ["a,b", '1,"x\ny"', "2,z"]),
        ('a\r\n"x\r\ny"\r\nz', ["a", '"x\r\ny"', "z"]),
        ('a\n"say ""hi\n"" to"\nz', ["a", '"say ""hi\n"" to"', "z"]),
        ('a\n"say \\"hi\n"\nz', ["a", '"say \\"hi\n"', "z"]),
        ("a\n\x01b\x01\nc", ["a", "\x01b\x01", "c"]),
        ('a\n"open\nrest', ["a", '"open\nrest']),
    ],
)
def test_line_ends_within_quotes_belong_to_values(spark, body, lines):
    frame = spark.createDataFrame([(1, bytearray(body.encode()))], "body_id INT, content BINARY")
    assert [r["line"] for r in csv_lines(frame).orderBy("pos").collect()] == lines
