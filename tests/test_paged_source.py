import json
import re
import urllib.error
from io import BytesIO

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagedframes import fixtures as fx
from pagedframes.sources import (
    FunctionTransport,
    HttpTransport,
    land_pages,
    pages_from_table,
    register_transport,
    unnest,
)
from pagedframes.replay import LandedTransport
from pagedframes.sources.paged import PagedReader, PagedStreamReader, PushdownReader
from pagedframes.sources.transport import Paging
from pagedframes.storage import new_folder
from pagedframes.streaming import drain, stream_api, stream_items


def api(total, told=True, short=(), refuse=()):
    """A function from URL to body that serves ``total`` items."""

    def fetch(url):
        page = int(re.search(r"[?&]page=(\d+)", url).group(1))
        assert "items_per_page=200" in url
        if page in refuse:
            raise LookupError(f"no page {page}")
        items = [{"id": i} for i in range((page - 1) * 200, min(page * 200, total))]
        if page in short:
            items = items[:150]
        body = {"$page": page, "$items": items}
        if told:
            body["$total"] = total if told is True else told
        return json.dumps(body)

    return FunctionTransport(fetch)


def ids(spark, transport, width=2):
    register_transport(spark, transport, "t")
    pages = spark.read.format("t").option("endpoint", "/x").option("pagesPerPartition", width).load()
    found = [json.loads(r["item"])["id"] for r in unnest(pages).select("item").collect()]
    return found


def test_other_paging_names_and_sizes(spark):
    def fetch(url):
        assert "&rows=7&" in url
        page = int(re.search(r"&p=(\d+)$", url).group(1))
        return json.dumps({"$total": 30, "$items": [{"id": i} for i in range((page - 1) * 7, min(page * 7, 30))]})

    register_transport(spark, FunctionTransport(fetch), "other")
    options = {"endpoint": "/x?q=1", "pageParam": "p", "sizeParam": "rows", "pageSize": "7", "pagesPerPartition": "2"}
    pages = spark.read.format("other").options(**options).load()
    assert sorted(json.loads(r["item"])["id"] for r in unnest(pages).collect()) == list(range(30))


@pytest.mark.parametrize("total", [0, 1, 199, 200, 201, 400, 1999])
def test_all_items_once(spark, total):
    assert sorted(ids(spark, api(total))) == list(range(total))


def test_pages_are_read_in_parallel():
    parts = PagedReader(api(2000), {"endpoint": "/x", "pagesPerPartition": "3"}).partitions()
    assert [(p.first, p.last, p.open) for p in parts] == [
        (1, 3, False),
        (4, 6, False),
        (7, 9, False),
        (10, 10, True),
    ]


def test_huge_datasets_have_no_more_tasks_than_a_cluster_can_plan():
    reader = PagedReader(FunctionTransport(lambda url: '{"$total": 20000000000, "$items": []}'), {"endpoint": "/x"})
    parts = reader.partitions()
    assert len(parts) == 20_000 and parts[-1].last == 100_000_000 and parts[-1].open


def test_without_a_total_pages_are_walked(spark):
    assert sorted(ids(spark, api(650, told=False))) == list(range(650))


def test_items_added_while_reading_are_read(spark):
    # page 1 told 380 items, but meanwhile there are 1,000
    assert sorted(ids(spark, api(1000, told=380))) == list(range(1000))


def test_short_page_fails(spark):
    with pytest.raises(PySparkException, match="page 2 holds 150 items, expected 200"):
        ids(spark, api(1000, short={2}))


def test_failing_page_fails_the_read(spark):
    with pytest.raises(PySparkException, match="no page 3"):
        ids(spark, api(1000, refuse={3}))


def test_body_without_pages_fails(spark):
    with pytest.raises(PySparkException, match="does not answer with pages"):
        ids(spark, FunctionTransport(lambda url: '{"error":"bad"}'))


def test_page_filters_narrow_the_requests(spark):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

    def ranges(*filters):
        reader = PushdownReader(api(2000), {"endpoint": "/x"})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return [(p.first, p.last, p.open) for p in reader.partitions()]

    assert ranges(EqualTo(("page",), 4)) == [(4, 4, False)]
    assert ranges(In(("page",), (7, 5))) == [(5, 7, False)]
    assert ranges(GreaterThan(("page",), 8)) == [(9, 10, True)]
    assert ranges(LessThanOrEqual(("page",), 2), EqualTo(("first",), 0)) == [(1, 2, False)]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        # page 3 must not be asked for: it would fail
        register_transport(spark, api(1000, refuse={3}), "pushed")
        pages = spark.read.format("pushed").option("endpoint", "/x").load().filter("page > 3")
        assert unnest(pages).count() == 400
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_landed_pages_replay(spark):
    # three blocks of pages
    total = 200 * 1001 + 50
    rows = spark.range(1, 1003).selectExpr("'d' dataset", "cast(id as int) page")
    item = F.expr("transform(sequence((page - 1) * 200, least(page * 200, {0}) - 1), i -> concat('{{\"id\":', i, '}}'))".format(total))
    body = F.concat(F.lit('{"$total":%d,"$items":[' % total), F.array_join(item, ","), F.lit("]}"))
    folder = new_folder(spark, "landed")
    land_pages(rows.withColumn("body", body), folder)
    assert sorted(ids(spark, LandedTransport(folder, {"/x": "d"}), width=70)) == list(range(total))
    assert pages_from_table(spark, folder, "d").count() == 1002
    gap = new_folder(spark, "landed")
    land_pages(rows.withColumn("body", body).filter("page != 3"), gap)
    with pytest.raises(PySparkException, match="expected page 3, got page 4"):
        ids(spark, LandedTransport(gap, {"/x": "d"}), width=10)


def test_stream_goes_on_where_it_ended(spark):
    def pull(total, target):
        register_transport(spark, api(total), "growing")
        stream = stream_items(stream_api(spark, "/x", "growing")).select("page", "item")
        return sorted(json.loads(r["item"])["id"] for r in drain(stream, target).collect())

    target = new_folder(spark, "grown")
    assert pull(250, target) == list(range(250))
    # page 2 was half full: the rest of it follows, nothing is read twice
    assert pull(250, target) == list(range(250))
    assert pull(700, target) == list(range(700))


def test_stream_partitions_cover_the_new_items():
    reader = PagedStreamReader(api(1000), {"endpoint": "/x", "pagesPerPartition": "2"})
    assert reader.latestOffset() == {"items": 1000}
    parts = reader.partitions({"items": 250}, {"items": 1000})
    assert [(p.first, p.last) for p in parts] == [(2, 3), (4, 5)]
    windows = [row[:3] for p in parts for row in reader._rows(p)]
    assert windows == [(2, 50, 150), (3, 0, 200), (4, 0, 200), (5, 0, 200)]
    assert reader.partitions({"items": 1000}, {"items": 1000}) == []


class Answers:
    """An opener that gives prepared answers and keeps the requests."""

    def __init__(self, *answers):
        self.answers, self.requests = list(answers), []

    def __call__(self, request, timeout):
        self.requests.append(request)
        answer = self.answers.pop(0)
        if isinstance(answer, int):
            raise urllib.error.HTTPError(request.full_url, answer, "no", {}, None)
        if isinstance(answer, Exception):
            raise answer
        return BytesIO(answer)


def test_http_retries_what_may_pass():
    answers = Answers(429, 503, urllib.error.URLError("down"), "{}é".encode())
    http = HttpTransport("https://a.test/", lambda: {"Authorization": "Bearer x"}, pause=0, opener=answers)
    assert http.get("/v?page=1") == "{}é"
    assert [r.full_url for r in answers.requests] == ["https://a.test/v?page=1"] * 4
    assert answers.requests[0].get_header("Authorization") == "Bearer x"


@pytest.mark.parametrize("code", [401, 404, 422])
def test_http_refusals_are_final(code):
    answers = Answers(code, b"{}")
    with pytest.raises(urllib.error.HTTPError):
        HttpTransport("https://a.test", pause=0, opener=answers).get("/v")
    assert len(answers.requests) == 1


def test_a_stream_does_not_go_back():
    total = [250]
    reader = PagedStreamReader(FunctionTransport(lambda url: '{"$total": %d, "$items": []}' % total[0]), {"endpoint": "/x"})
    assert reader.latestOffset() == {"items": 250}
    total[0] = 240
    with pytest.raises(ValueError, match="shrank from 250 to 240"):
        reader.latestOffset()
    with pytest.raises(ValueError, match="shrank"):
        reader.partitions({"items": 250}, {"items": 240})
    assert reader.partitions({"items": 250}, {"items": 250}) == []


def test_many_small_datasets_are_many_files(spark, tmp_path):
    pages = spark.range(2000).select(F.col("id").cast("string").alias("dataset"), F.lit(1).alias("page"), F.lit("{}").alias("body"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_pages(pages, str(tmp_path / "landed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "landed").glob("block=0/*.parquet"))
    assert len(files) == 8 and spark.read.parquet(str(tmp_path / "landed")).count() == 2000


def test_pages_of_one_dataset_are_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(fx, "RANGE", 500, raising=False)
    n = 5_000
    # keys repeat, and come in no order
    key = (F.col("id") * 7919 % n / 2).cast("bigint")
    rows = spark.range(n).select(key.alias("key"), F.struct(key.alias("id")).alias("record"), (F.col("id") % 10 == 0).alias("rare"))
    dataset = F.explode(F.array(F.lit("all"), F.when(F.col("rare"), F.lit("rare")))).alias("dataset")
    pages = fx.numbered_pages(rows.select("key", "record", dataset), F.col("dataset"))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    found = {(r["dataset"], r["page"]): json.loads(r["body"]) for r in pages.collect()}
    # windows go over ranges, not over rows
    assert "row_number" not in plan
    for name, total in (("all", n), ("rare", n // 10)):
        bodies = [found[name, page + 1] for page in range(-(-total // 200))]
        assert all(b["$total"] == total for b in bodies)
        keys = [item["id"] for b in bodies for item in b["$items"]]
        assert keys == sorted(keys) and len(keys) == total
        assert [len(b["$items"]) for b in bodies[:-1]] == [200] * (len(bodies) - 1)
    assert len(found) == 25 + 3


def test_landed_pages_are_decoded_a_few_at_a_time(spark, tmp_path):
    folder = str(tmp_path / "pages")
    body = F.expr("concat(id, ':', array_join(transform(sequence(1, 1600), k -> sha2(concat(id, ' ', k), 256)), ''))")
    pages = spark.range(1, 301).select(F.lit("d").alias("dataset"), F.col("id").alias("page"), body.alias("body"))
    land_pages(pages, folder)
    before, peak, found = pa.total_allocated_bytes(), 0, []
    for page, text in LandedTransport(folder, {"/d": "d"}).pages("/d", 101, 200, Paging()):
        peak = max(peak, pa.total_allocated_bytes() - before)
        found.append((page, int(text.split(":")[0])))
    assert found == [(page, page) for page in range(101, 201)]
    # 300 pages of 100 KB: a row group takes 10 MB and more
    assert peak < 8e6
